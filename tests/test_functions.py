from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.functions import (
    elapsed_seconds, error_prefix, first_element, label_matches, log_line, matches_log_errors, object_key, pg_round,
    register_sql_functions, relabel, row_json, split_trim,
)
from stratus.functions import containers as box
from stratus.functions.metric_names import with_metric_name


def decimal_round(x, digits):
    exact = Decimal(repr(x)).quantize(Decimal(1).scaleb(-12), rounding=ROUND_HALF_UP)
    return float(exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False, width=64), min_size=1, max_size=60))
def test_rounding_is_half_away_from_zero_on_the_decimal(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(pg_round("x", 1)).collect()]
    assert got == [decimal_round(v, 1) for v in values]


def test_rounding_ties_and_values_beyond_the_decimal(spark):
    df = spark.createDataFrame([(62.849999999999994,), (-0.25,), (0.0499,), (1e30,), (None,)], "x double")
    assert [r[0] for r in df.select(pg_round("x", 1)).collect()] == [62.9, -0.3, 0.0, 1e30, None]


def test_sql_functions(spark):
    register_sql_functions(spark)
    got = spark.sql(
        "SELECT pg_round(15.26D, 1), pg_round(2.345D, 2), counter_delta(5D, 3D), counter_delta(3D, 5D),"
        " counter_delta(NULL, 5D)"
    ).first()
    assert tuple(got) == (15.3, 2.35, 3.0, 2.0, 0.0)


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [(" Paris, ,Lyon ,", "/airflow-worker", "no Module named x", "Zoë")], "csv string, name string, line string, city string"
    )
    got = df.select(
        split_trim("csv"), relabel("name"), matches_log_errors("line"), log_line("name", "line"), row_json("city"),
        object_key(F.lit("weather_current"), F.lit("Paris"), F.lit("2024-03-07 16:00:00").cast("timestamp")),
        error_prefix(F.repeat(F.lit("ab"), 400)),
    ).first()
    assert got[0] == ["Paris", "Lyon"]
    assert got[1] == "airflow-worker"
    assert got[2] is True
    assert got[3] == "[/airflow-worker] no Module named x"
    assert got[4] == '{"city":"Zoë"}'
    assert got[5] == "raw/weather_current/year=2024/month=03/day=07/weather_current_paris_1709827200.parquet"
    assert got[6] == "ab" * 250


def test_label_match_is_anchored_and_treats_missing_as_empty(spark):
    df = spark.createDataFrame([("redis",), ("redis-2",), (None,)], "l string")
    assert [r[0] for r in df.select(label_matches("l", "redis|minio")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(label_matches("l", "redis", negate=True)).collect()] == [False, True, True]


def test_elapsed_uses_now_for_open_runs_and_rounds(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 500000)), (datetime(2024, 1, 1), None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    now = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    assert [r[0] for r in df.select(elapsed_seconds("a", "b", now)).collect()] == [2, 3600]


def test_container_measures(spark):
    df = spark.createDataFrame(
        [
            ("healthy", "running", "2024-01-01T00:00:00Z", 300, 100, 2000, 1000, 4),
            ("odd", "exited", "0001-01-01T00:00:00Z", 300, 100, 1000, 1000, 4),
            (None, "running", "", 300, None, 2000, 1000, None),
            ("starting", "running", "2024-01-01T00:00:00.123456789Z", 300, 100, 2000, 1000, None),
        ],
        "health string, state string, started string, c bigint, pc bigint, s bigint, ps bigint, n int",
    )
    now = F.lit("2024-01-01 01:00:00").cast("timestamp")
    got = df.select(
        box.health_code("health"), box.cpu_percent("c", "pc", "s", "ps", "n"),
        box.start_epoch("started"), box.uptime_seconds("started", "state", now),
    ).collect()
    assert [r[0] for r in got] == [1.0, -1.0, -1.0, 0.5]
    assert [round(r[1], 6) for r in got] == [80.0, 0.0, 0.0, 20.0]
    assert [r[2] for r in got] == [1704067200, None, None, 1704067200]
    assert [r[3] for r in got] == [3600, None, None, 3600]


def test_network_totals(spark):
    df = spark.sql(
        "SELECT map('a', named_struct('rx_bytes', 1L, 'tx_bytes', 2L),"
        " 'b', named_struct('rx_bytes', 10L, 'tx_bytes', cast(null as bigint))) AS n"
        " UNION ALL SELECT map() UNION ALL SELECT null"
    )
    got = df.select(box.network_total("n", "rx_bytes"), box.network_total("n", "tx_bytes")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 0), (0, 0), (11, 2)]


def test_first_element_of_empty_array_is_null(spark):
    df = spark.sql("SELECT array(named_struct('main', 'Rain')) AS w UNION ALL SELECT filter(array(named_struct('main', 'x')), e -> false)")
    assert sorted((r[0] or "") for r in df.select(first_element("w", "main")).collect()) == ["", "Rain"]


def test_metric_names_use_first_match_and_single_segments(spark):
    names = {
        "airflow.scheduler.heartbeat": ("airflow_scheduler_heartbeat", {}),
        "airflow.ti.finish.d.t.success": ("airflow_ti_finish", {"dag_id": "d", "task_id": "t", "state": "success"}),
        "airflow.dag.d.t.duration": ("airflow_task_duration", {"dag_id": "d", "task_id": "t"}),
        "airflow.dagrun.d.first_task_scheduling_delay": ("airflow_dagrun_first_task_scheduling_delay", {"dag_id": "d"}),
        "airflow.other": ("airflow_unmapped", {"statsd_metric": "other"}),
        "airflow.two.parts": ("unmapped", {}),
        "elsewhere": ("unmapped", {}),
    }
    df = with_metric_name(spark.createDataFrame([(n,) for n in names], "dotted string"), "dotted")
    assert {r.dotted: (r.mapped.name, r.mapped.labels) for r in df.collect()} == names
