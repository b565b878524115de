"""Payloads stored as VARIANT: parsed once, typed from there, both kinds."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from stratus.plans import staging
from stratus.session import work_path
from stratus.sources import documents, landing
from stratus.sources.landing import CURRENT_PAYLOAD, FORECAST_PAYLOAD, parse_payload

CURRENT = {
    "coord": {"lon": 2.35, "lat": 48.85}, "weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"}],
    "main": {"temp": 15.2, "feels_like": 14.1, "humidity": 65, "pressure": 1013}, "wind": {"speed": 3.5, "deg": 180},
    "clouds": {"all": 20}, "visibility": 10_000, "dt": 1_709_827_200, "sys": {"country": "FR"}, "name": "Paris", "cod": 200,
}
SLOT = {"dt": 1_709_827_200, "main": {"temp": 1, "feels_like": 0.5, "humidity": 50, "pressure": 999}, "weather": [], "wind": {"speed": 2}, "pop": 0.4}
FORECAST = {"city": {"name": "Lyon", "country": "FR", "coord": {"lat": 45.7, "lon": 4.8}}, "list": [SLOT, {**SLOT, "dt": 5}], "cnt": 2}
TEXTS = [
    json.dumps(CURRENT), json.dumps(FORECAST), "{bad", "", None, "{}", "[1, 2]", "7", "null",
    json.dumps({**CURRENT, "main": 7, "weather": {}, "name": None, "dt": "x"}), json.dumps({**FORECAST, "list": []}),
    json.dumps({**FORECAST, "list": {"a": 1}}), json.dumps({"city": None, "list": [{}, 3, None]}),
]


def stored(spark, texts=TEXTS):
    rows = [(str(i), "l", "weather_current" if i % 2 == 0 else "weather_forecast", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "row_id string, load_id string, source string, raw_json string")
    return df, documents.store_documents(df, work_path(spark, "documents"))


def test_text_stays_where_it_does_not_parse(spark):
    _, docs = stored(spark)
    kept = {r.row_id: (r.raw_json, r.there) for r in docs.select("row_id", "raw_json", F.col("doc").isNotNull().alias("there")).collect()}
    assert {k for k, (_, there) in kept.items() if not there} == {"2", "3", "4"}
    assert (kept["2"][0], kept["3"][0], kept["4"][0]) == ("{bad", "", None) and kept["0"][0] is None


def test_nothing_is_parsed_again(spark):
    _, docs = stored(spark)
    for df in (documents.current_observations(docs), documents.forecast_slots(docs), documents.promoted(docs)):
        plan = df.where(F.col("city_name").isNotNull())._jdf.queryExecution().executedPlan().toString()
        assert "parse_json" not in plan and "from_json" not in plan


def test_equal_to_the_parsed_text(spark):
    """On sound payloads stored documents give what parsing into the declared shape gives, to the last column."""
    df, docs = stored(spark, [json.dumps(CURRENT), json.dumps(FORECAST)])
    current = staging.stg_weather_current(parse_payload(df.where("row_id = '0'"), "raw_json", CURRENT_PAYLOAD), datetime(2024, 2, 1))
    got = documents.current_observations(docs.where("row_id = '0'"), datetime(2024, 2, 1))
    assert got.columns == current.columns and got.collect() == current.collect() and len(got.columns) == 17
    forecast = staging.stg_forecast_from_payload(parse_payload(df.where("row_id = '1'"), "raw_json", FORECAST_PAYLOAD), datetime(2024, 2, 1))
    got = documents.forecast_slots(docs.where("row_id = '1'"), datetime(2024, 2, 1))
    assert sorted(got.columns) == sorted(forecast.columns)
    assert sorted(got.select(forecast.columns).collect()) == sorted(forecast.collect()) and got.count() == 2
    same = landing.promote_fields(df).drop("raw_json").orderBy("row_id").collect()
    assert documents.promoted(docs).drop("doc", "raw_json").orderBy("row_id").collect() == same


def test_odd_payloads_keep_their_rows(spark):
    _, docs = stored(spark)
    rows = {r.row_id: r for r in documents.current_observations(docs).collect()}
    assert set(rows) == {"0", "1", "5", "6", "7", "8", "9", "10", "11", "12"}
    assert (rows["9"].city_name, rows["9"].temperature_celsius, rows["9"].weather_condition, rows["9"].measured_at) == (None,) * 4
    assert (rows["9"].latitude, rows["9"].country_code) == (48.85, "FR")
    slots = documents.forecast_slots(docs).collect()
    assert sorted((r.city_name or "", r.temperature_celsius) for r in slots if r.temperature_celsius is not None) == [("Lyon", 1.0), ("Lyon", 1.0)]
    assert len(slots) == 5 and len({r.row_id for r in slots}) == 5
