"""Streams fed file by file must end where the batch operators end."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stratus.operators.alerts import alert_throttle
from stratus.operators.contracts import Contract, Field
from stratus.operators.logs import reject_old
from stratus.operators.sustained import sustained_condition
from stratus.plans.marts import condition_parts, merge_parts
from stratus.session import work_path
from stratus.sources import landing
from stratus.streaming import holding, jobs, running
from stratus.streaming.throttling import throttled_alerts

START = datetime(2024, 1, 1)
OBS = """city_name string, weather_condition string, temperature_celsius double, feels_like_celsius double,
  humidity_percent bigint, pressure_hpa bigint, wind_speed_ms double, measured_at timestamp_ntz"""
SAMPLE = "name string, event_id bigint, ts timestamp_ntz, value double"


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def as_stream(spark, path, schema, files=1):
    return running.stream_table(spark, path, spark.createDataFrame([], schema).schema, files)


def test_each_file_is_appended_once(spark):
    path, out, cp = (work_path(spark, n) for n in ("in", "out", "cp"))
    for i in range(3):
        land(spark, path, [("a", i, START, 1.0)], SAMPLE)
        running.append_to(as_stream(spark, path, SAMPLE), out, cp)
        assert spark.read.parquet(out).count() == i + 1
    running.append_to(as_stream(spark, path, SAMPLE), out, cp)
    assert spark.read.parquet(out).count() == 3


def observations(n, offset):
    return [
        (f"c{i % 2}", "Rain" if i % 3 else "Fog", float(i % 11), float(i % 5), i % 100, 1000 + i % 7, float(i % 4),
         START + timedelta(minutes=37 * (i + offset)))
        for i in range(n)
    ]


def test_daily_parts_over_many_batches_equal_the_batch_summary(spark):
    path = work_path(spark, "obs")
    for part in range(4):
        land(spark, path, observations(60, 60 * part), OBS)
    stream = jobs.daily_parts(as_stream(spark, path, OBS))
    kept = running.finish_upsert(stream, "daily", jobs.PART_KEYS)
    batch = spark.read.parquet(path).withColumn("date_day", F.to_date("measured_at").cast("timestamp_ntz"))
    expected = merge_parts(condition_parts(batch))
    columns = sorted(expected.columns)
    got = sorted(map(tuple, merge_parts(kept).select(*columns).collect()))
    assert got == sorted(map(tuple, expected.select(*columns).collect())) and got


def test_sliding_totals(spark):
    path = work_path(spark, "samples")
    rows = [("a", i, START + timedelta(seconds=90 * i), float(i)) for i in range(8)]
    for part in (rows[:3], rows[3:]):
        land(spark, path, part, SAMPLE)
    stream = jobs.sliding_totals(as_stream(spark, path, SAMPLE), ["name"], "value")
    got = running.finish_upsert(stream, "sliding", ["name", "window_start", "window_end"])
    expected = {}
    for _, _, ts, v in rows:
        minute = (ts - START) // timedelta(minutes=1)
        for start in range(minute - 4, minute + 1):
            at = START + timedelta(minutes=start)
            expected[at] = (expected.get(at, (0, 0))[0] + v, expected.get(at, (0, 0))[1] + 1)
    assert {r.window_start: (r.total, r.samples) for r in got.collect()} == expected


def test_repeats_are_dropped_across_batches(spark):
    path = work_path(spark, "repeats")
    rows = [("a", i, START + timedelta(minutes=i), 1.0) for i in range(10)]
    for part in (rows[:6], rows[3:], rows):
        land(spark, path, part, SAMPLE)
    kept = running.finish_append(jobs.drop_repeats(as_stream(spark, path, SAMPLE), "event_id", "ts"), "dedup")
    assert sorted(r.event_id for r in kept.collect()) == list(range(10))


def test_late_rows_are_refused_by_wall_clock(spark):
    path = work_path(spark, "late")
    land(spark, path, [("a", 0, START, 1.0), ("a", 1, START - timedelta(seconds=1), 1.0)], SAMPLE)
    now = F.lit(str(START + timedelta(hours=168))).cast("timestamp_ntz")
    kept = running.finish_append(reject_old(as_stream(spark, path, SAMPLE), "ts", now), "late")
    assert [r.event_id for r in kept.collect()] == [0]


def test_contract_in_flight(spark):
    path = work_path(spark, "landing")
    spark.createDataFrame([('{"a": 1}',), ("{bad",), ("{}",)], "v string").write.text(path)
    stream = landing.stream_landing(spark, path).drop("malformed")
    checked = jobs.contract_stream(stream, "raw_json", Contract("t", (Field("a", "integer", True),)))
    rows = running.finish_append(checked, "contract").collect()
    assert {r.raw_json: r.target for r in rows} == {'{"a": 1}': "valid", "{bad": "quarantine", "{}": "quarantine"}


def test_held_alerts_keep_their_state_between_batches(spark):
    holding.use_keyed_state(spark)
    path = work_path(spark, "held")
    high = {"a": [1, 1, 1, 1, 1, 1, 0, 1, 1, 1], "b": [1, 1, 0, 1, 1, 1, 1, 0, 0, 0]}
    for part in range(5):  # two ticks a file, so every hold spans batches
        rows = [
            (name, 10 * i + k, START + timedelta(minutes=i, seconds=20 * k), float(values[i]) if k == 2 else 0.0)
            for i in (2 * part, 2 * part + 1) for name, values in high.items() for k in range(3)
        ]
        land(spark, path, rows, SAMPLE)
    land(spark, path, [("z", 999, START + timedelta(hours=5), 0.0)], SAMPLE)  # closes all ticks
    stream = holding.held_alerts(
        as_stream(spark, path, SAMPLE), ["name"], F.col("value") > 0, hold_seconds=120, tick_seconds=60, lateness="1 minute"
    )
    got = sorted((r.name, r.held_since, r.fired_at) for r in running.finish_append(stream, "hold").collect())
    minute = [START + timedelta(minutes=i) for i in range(10)]
    assert got == [("a", minute[0], minute[2]), ("a", minute[7], minute[9]), ("b", minute[3], minute[5])]

    ticks = holding.evaluated_ticks(spark.read.parquet(path), ["name"], F.col("value") > 0, 60)
    batch = sustained_condition(ticks.withColumn("seq", F.lit(0)), ["name"], F.col("truth"), 120, ts="tick", tiebreak="seq")
    assert got == sorted((r.name, r.started_at, r.fires_from) for r in batch.collect())


def test_held_ticks_do_not_depend_on_the_order_of_files(spark):
    """Five files, the newest first, one per batch: alerts are those of the batch, up to the last tick."""
    import time as clock

    path = work_path(spark, "held-late")
    high = {"a": [1, 1, 1, 1, 1, 1, 0, 1, 1, 1], "b": [1, 1, 0, 1, 1, 1, 1, 0, 0, 0]}
    for part in (4, 3, 2, 1, 0):
        land(spark, path, [
            (name, 10 * i + k, START + timedelta(minutes=i, seconds=20 * k), float(values[i]) if k == 2 else 0.0)
            for i in (2 * part, 2 * part + 1) for name, values in high.items() for k in range(3)
        ], SAMPLE)
        clock.sleep(1.1)  # files are taken in the order of their times
    ticks = holding.evaluated_ticks(as_stream(spark, path, SAMPLE), ["name"], F.col("value") > 0, 60)
    got = holding.held_ticks(running.finish_upsert(ticks, "held-late-ticks", ["name", "tick"]), ["name"], 120)
    minute = [START + timedelta(minutes=i) for i in range(10)]
    assert sorted((r.name, r.held_since, r.fired_at) for r in got.collect()) == [
        ("a", minute[0], minute[2]), ("a", minute[7], minute[9]), ("b", minute[3], minute[5])]


def test_throttle_keeps_its_state_between_batches(spark):
    holding.use_keyed_state(spark)
    path = work_path(spark, "alerts")
    schema = "alertname string, severity string, ts timestamp_ntz"
    rows = [
        ("A", severity, START + timedelta(minutes=m))
        for m in range(0, 600, 7) for severity in ("critical", "warning") for _ in range(2)
    ]
    for part in range(4):
        land(spark, path, rows[part * 90:(part + 1) * 90], schema)
    land(spark, path, [("closes all ticks", "warning", START + timedelta(days=1))], schema)
    stream = throttled_alerts(as_stream(spark, path, schema))
    got = sorted(tuple(r) for r in running.finish_append(stream, "throttle").collect())
    batch = alert_throttle(spark.read.parquet(path)).where("alertname = 'A'")
    assert got == sorted(tuple(r) for r in batch.collect()) and len(got) > 8


def test_backlog_order_does_not_matter(spark, tmp_path):
    """Four files, the newest first, one per batch: no row is refused as late."""
    import time as clock

    from stratus.streaming import jobs, running

    rows = spark.range(400).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id div 4 as int)) ts", "id % 3 k", "1D v")
    folder = str(tmp_path / "late")
    for part in (3, 2, 1, 0):
        rows.filter(f"id div 100 = {part}").coalesce(1).write.mode("append").parquet(folder)
        clock.sleep(1.1)  # files are taken in the order of their times
    landed = running.stream_table(spark, folder, rows.schema, files_per_trigger=1)
    kept = running.finish_append(jobs.drop_repeats(landed, "id", "ts"), "late-dedup")
    assert kept.count() == 400
    keys = ["k", "window_start", "window_end"]
    totals = running.finish_upsert(jobs.sliding_totals(landed, ["k"], "v", window="2 hours", step="1 hour"), "late-totals", keys)
    assert sum(r["samples"] for r in totals.collect()) == 800
