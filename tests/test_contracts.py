import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.operators.contracts import (
    CURRENT_CONTRACT, FORECAST_CONTRACT, Contract, Field, check_contract, contract_from_dict, row_freshness,
    split_quarantine, store_split,
)
from stratus.session import work_path


def errors_of(spark, contract, *documents):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    return [r.contract_errors for r in check_contract(df, "raw", contract).orderBy("i").collect()]


@pytest.mark.parametrize("document,spec,expected", [
    ({}, Field("name", "string", True), ["Missing required field: name"]),
    ({}, Field("name", "string"), []),
    ({"temp": "x"}, Field("temp", "number", True), ["Type mismatch at temp: expected number, got str"]),
    ({"temp": 42}, Field("temp", "number", True), []),
    ({"temp": 3.14}, Field("temp", "number", True), []),
    ('{"temp": 65.0}', Field("temp", "number", True), []),
    ('{"temp": 65.0}', Field("temp", "integer", True), ["Type mismatch at temp: expected integer, got float"]),
    ('{"temp": 1e5}', Field("temp", "integer", True), ["Type mismatch at temp: expected integer, got float"]),
    ({"temp": True}, Field("temp", "integer", True), []),
    ({"temp": True}, Field("temp", "number", True), []),
    ({"temp": 1}, Field("temp", "boolean", True), ["Type mismatch at temp: expected boolean, got int"]),
    ({"temp": None}, Field("temp", "number"), ["Type mismatch at temp: expected number, got NoneType"]),
    ({"temp": {"a": 1}}, Field("temp", "string"), ["Type mismatch at temp: expected string, got dict"]),
    ({"main": {"temp": 20.5}}, Field("main", "object", True, (Field("humidity", "integer", True),)),
     ["Missing required field: main.humidity"]),
    ({"main": 3}, Field("main", "object", True, (Field("humidity", "integer", True),)),
     ["Type mismatch at main: expected object, got int"]),
    ({"weather": [1, 2, 3]}, Field("weather", "array", True), []),
    ({"weather": {}}, Field("weather", "array", True), ["Type mismatch at weather: expected array, got dict"]),
    ({"x": 1}, Field("x", "no such type", True), []),
    ({"x": 1}, Field("x", None, True), []),
    ('{"x": "a", "x": 1}', Field("x", "integer", True), []),  # the last of two equal keys counts
])
def test_matrix(spark, document, spec, expected):
    assert errors_of(spark, Contract("t", (spec,)), document) == [expected]


def python_errors(document, fields, path=()):
    """The rules once more, on plain dictionaries."""
    kinds = {"string": (str,), "integer": (int,), "number": (int, float), "array": (list,), "object": (dict,)}
    out = []
    for f in fields:
        shown = ".".join((*path, f.name))
        if f.name not in document:
            out += [f"Missing required field: {shown}"] * f.required
            continue
        value = document[f.name]
        if not isinstance(value, kinds[f.type]):
            out.append(f"Type mismatch at {shown}: expected {f.type}, got {type(value).__name__}")
        elif f.type == "object":
            out += python_errors(value, f.fields, (*path, f.name))
    return out


scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), st.floats(-1e6, 1e6).map(lambda x: round(x, 3)), st.text(max_size=3))
inner = st.dictionaries(st.sampled_from(["temp", "humidity", "pressure", "speed", "deg", "lon", "lat", "feels_like"]), scalars, max_size=6)
documents = st.dictionaries(
    st.sampled_from(["main", "wind", "weather", "name", "dt", "coord", "sys"]),
    st.one_of(scalars, inner, st.lists(scalars, max_size=2)), max_size=7,
)


@settings(max_examples=15, deadline=None)
@given(st.lists(documents, min_size=1, max_size=40))
def test_current_contract_equals_the_rules_on_dictionaries(spark, docs):
    expected = [python_errors(d, CURRENT_CONTRACT.fields) for d in docs]
    assert errors_of(spark, CURRENT_CONTRACT, *docs) == expected


def test_sample_payloads_keep_their_contracts(spark):
    current = {
        "coord": {"lon": 2.3488, "lat": 48.8534}, "weather": [{"main": "Clear", "description": "clear sky"}],
        "main": {"temp": 15.2, "feels_like": 14.1, "humidity": 65, "pressure": 1013},
        "wind": {"speed": 3.5, "deg": 180}, "dt": 1709827200, "sys": {"country": "FR"}, "name": "Paris",
    }
    forecast = {"list": [], "city": {"name": "Paris", "coord": {}}, "cnt": 40}
    assert errors_of(spark, CURRENT_CONTRACT, current) == [[]]
    assert errors_of(spark, FORECAST_CONTRACT, forecast) == [[]]
    del forecast["city"]["coord"]
    assert errors_of(spark, FORECAST_CONTRACT, forecast) == [["Missing required field: city.coord"]]


def test_malformed_and_non_object_text(spark):
    assert errors_of(spark, Contract("t", (Field("a", "string", True),)), "{bad", "[1]", "3") == [
        None, ["Missing required field: a"], ["Missing required field: a"],
    ]


def test_quarantine_keeps_every_row_on_one_side(spark):
    df = spark.createDataFrame([('{"a": "x"}',), ('{"a": 1}',), ("{bad",), ("{}",)], "raw string")
    checked = check_contract(df, "raw", Contract("t", (Field("a", "string", True),)))
    for valid, broken in (split_quarantine(checked), store_split(checked, work_path(spark, "split"))):
        assert [r.raw for r in valid.collect()] == ['{"a": "x"}']
        assert {r.raw for r in broken.collect()} == {"{bad", '{"a": 1}', "{}"}


def test_filters_do_not_repeat_the_parsing(spark):
    df = spark.createDataFrame([("{}",)], "raw string")
    broken = check_contract(df, "raw", CURRENT_CONTRACT).where(F.size("contract_errors") > 0)
    assert broken._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_freshness(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    at = 1704110400
    df = spark.createDataFrame([(0, at - 60), (1, at - 999_999), (2, None), (3, at + 500), (4, at - 360 * 60)], "i int, dt bigint")
    fresh = [r[0] for r in df.orderBy("i").select(row_freshness("dt", CURRENT_CONTRACT, now)).collect()]
    assert fresh == [True, False, True, True, True]
    unlimited = Contract("t", ())
    assert df.select(row_freshness("dt", unlimited, now)).distinct().collect()[0][0] is True


def test_contract_documents_can_be_loaded(spark):
    document = {"contract": {"name": "t", "freshness": {"max_age_minutes": 5}, "schema": {"fields": [
        {"name": "m", "type": "object", "required": True, "fields": [{"name": "k", "type": "integer"}]}]}}}
    assert contract_from_dict(document) == Contract(
        "t", (Field("m", "object", True, (Field("k", "integer"),)),), 5
    )
