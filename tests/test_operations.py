"""Run history, alerts, series, logs and volume anomalies on small cases."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.operators import alerts, anomaly, logs, runs, series
from stratus.operators.alerts import Rule
from stratus.plans import alert_rules

NOW = datetime(2024, 1, 10, 12)
RUN = "dag_id string, run_id bigint, state string, start_date timestamp_ntz, end_date timestamp_ntz"
SAMPLE = "name string, instance string, event_id bigint, ts timestamp_ntz, value double"


def now():
    return F.lit(str(NOW)).cast("timestamp_ntz")


def history(spark, *rows):
    """Rows as (dag, state, hours before now, seconds taken or None)."""
    data = []
    for i, (dag, state, ago, took) in enumerate(rows):
        start = NOW - timedelta(hours=ago)
        data.append((dag, i, state, start, None if took is None else start + timedelta(seconds=took)))
    return spark.createDataFrame(data, RUN)


def test_stuck_is_strict(spark):
    df = history(spark, ("a", "running", 4, None), ("b", "running", 4.01, None), ("c", "success", 9, 1))
    assert [r.dag_id for r in runs.stuck_runs(df, now()).collect()] == ["b"]


def test_missed_bound_is_inclusive_and_needs_a_schedule(spark):
    dags = spark.createDataFrame(
        [("a", False, True), ("b", False, True), ("c", False, False)], "dag_id string, is_paused boolean, has_schedule boolean"
    )
    df = history(spark, ("a", "failed", 24, 1), ("b", "success", 24.01, 1))
    assert [r.dag_id for r in runs.missed_executions(dags, df, now()).collect()] == ["b"]


def test_paused_or_missing(spark):
    dags = spark.createDataFrame([("a", True), ("b", False), ("d", None)], "dag_id string, is_paused boolean")
    required = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "dag_id string")
    assert sorted(r.dag_id for r in runs.paused_or_missing(required, dags).collect()) == ["a", "c (NOT FOUND)"]


@pytest.mark.parametrize("seconds,found", [
    ((900,), False),
    ((900, 1, 1), False),  # 900 is not above three times 300.67
    ((900, 1, 1, 1), True),
    ((300, 30, 30, 40), False),  # exactly three times the mean
    ((301, 30, 30, 40), True),
])
def test_duration_anomaly(spark, seconds, found):
    df = history(spark, *[("a", "success", i, s) for i, s in enumerate(seconds)])
    assert bool(runs.duration_anomalies(df).count()) is found


def test_duration_anomaly_looks_at_the_last_twenty_successes(spark):
    old = [("a", "success", 30 + i, 100_000) for i in range(5)]
    recent = [("a", "success", i, 100 if i else 1000) for i in range(20)]
    noise = [("a", "failed", 0.5, 10**6), ("a", "running", 0.2, None)]
    row = runs.duration_anomalies(history(spark, *old, *recent, *noise)).first()
    assert (row.runs, row.latest_seconds, row.mean_seconds) == (20, 1000.0, 145.0)


def test_rates_and_durations(spark):
    df = history(spark, ("a", "success", 5, 10), ("a", "failed", 4, 20), ("a", "success", 3, 60), ("b", "running", 2, None))
    rate = {r.dag_id: (r.successes, r.failures, r.total, r.success_rate) for r in runs.success_rate(df).collect()}
    assert rate == {"a": (2, 1, 3, 66.7), "b": (0, 0, 1, 0.0)}
    stats = runs.duration_stats(df).collect()
    assert [(r.dag_id, r.runs, r.avg_seconds, r.stddev_seconds) for r in stats] == [("a", 3, 30.0, 26.5)]
    counts = runs.run_state_counts(df, ["success", "failed"], NOW - timedelta(hours=4), NOW - timedelta(hours=3)).first()
    assert tuple(counts) == (1, 1)


def test_recent_runs_and_timeline(spark):
    df = history(spark, ("a", "success", 5, 10), ("b", "running", 1, None), ("c", "queued", 2, 5), ("d", "odd", 3, 5))
    assert [(r.dag_id, r.elapsed_seconds) for r in runs.recent_runs(df, now(), 2).collect()] == [("b", 3600), ("c", 5)]
    line = runs.state_timeline(df, now()).collect()
    assert [r.value for r in line if r.metric == "b"] == [2, 0]
    assert line[-1].time == NOW and [r.time for r in line] == sorted(r.time for r in line)
    assert sorted(r.value for r in line) == [0, 0, 0, 0, 0, 1, 2, 4]


def test_report_counts_every_kind(spark):
    df = history(spark, ("a", "running", 9, None))
    one = spark.createDataFrame([("x",)], "dag_id string")
    none = one.where("false")
    row = runs.ops_report(one, none, runs.stuck_runs(df, now()), none).first()
    assert tuple(row) == (1, 0, 1, 0, 2)
    empty = runs.ops_report(none, none, none, none).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def samples(spark, *rows):
    """Rows as (name, instance, seconds before now, value)."""
    data = [(n, i, k, NOW - timedelta(seconds=ago), v) for k, (n, i, ago, v) in enumerate(rows)]
    return spark.createDataFrame(data, SAMPLE)


def test_threshold_rules_and_groups(spark):
    df = samples(
        spark, ("up", "pushgateway", 1, 0.0), ("up", "redis", 1, 1.0), ("docker_container_cpu_usage_percent", "airflow-x", 1, 90.0),
        ("docker_container_cpu_usage_percent", "minio", 1, 90.5), ("airflow_executor_open_slots", "e", 1, 2.0), ("other", "e", 1, 0.0),
    )
    fired = alerts.threshold_alerts(df)
    assert sorted((r.alertname, r.instance) for r in fired.collect()) == [
        ("AirflowExecutorSlotsExhausted", "e"), ("ContainerHighCPU", "minio"),
        ("PrometheusTargetDown", "pushgateway"), ("PushgatewayDown", "pushgateway"),
    ]
    groups = {(r.alertname, r.severity): (r.firing, r.components) for r in alerts.alert_groups(fired).collect()}
    assert groups["PushgatewayDown", "warning"] == (1, "pipeline")
    rule = Rule("Mine", "up", ">=", 1, 0, "critical", "x")
    assert [r.instance for r in alerts.threshold_alerts(df, (rule,)).collect()] == ["redis"]


def greedy(instants, gap):
    sent = []
    for t in sorted(set(instants)):
        if not sent or t - sent[-1] >= gap:
            sent.append(t)
    return sent


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1), st.integers(1, 100))
def test_throttle_positions(instants, gap):
    ordered = np.array(sorted(set(instants)))
    assert list(ordered[alerts.throttle_instants(ordered, gap)]) == greedy(instants, gap)


def test_throttle_uses_the_interval_of_the_severity(spark):
    minutes = list(range(0, 600, 7))
    rows = [("A", sev, NOW + timedelta(minutes=m)) for sev in ("critical", "warning") for m in minutes for _ in range(3)]
    df = spark.createDataFrame(rows, "alertname string, severity string, ts timestamp_ntz")
    got = alerts.alert_throttle(df).orderBy("severity", "notified_at").collect()
    for severity, gap in (("critical", 60), ("warning", 240)):
        mine = [r for r in got if r.severity == severity]
        assert [r.notified_at for r in mine] == [NOW + timedelta(minutes=m) for m in greedy(minutes, gap)]
        assert sum(r.alerts for r in mine) == 3 * sum(m <= greedy(minutes, gap)[-1] for m in minutes)


def test_series_and_or_absent(spark):
    left = samples(spark, ("a", "i1", 1, 5.0), ("a", "i2", 1, 6.0), ("a", None, 1, 7.0))
    right = samples(spark, ("b", "i2", 1, 1.0), ("b", "i3", 1, 2.0), ("b", None, 1, 3.0), ("b", "i2", 2, 9.0))
    assert sorted(r.value for r in series.series_and(left, right, ["instance"]).collect()) == [6.0, 7.0]
    assert sorted(r.value for r in series.series_or(left, right, ["instance"]).collect()) == [2.0, 5.0, 6.0, 7.0]
    expected = spark.createDataFrame([("i1",), ("i2",), ("i3",)], "instance string")
    seen = samples(spark, ("a", "i1", 300, 1.0), ("a", "i2", 299, 1.0), ("a", "i3", -5, 1.0))
    gone = series.absent_series(expected, seen, ["instance"], now(), 300)
    assert sorted(r.instance for r in gone.collect()) == ["i1", "i3"]


def test_ratio_pairs_metrics_per_step(spark):
    df = samples(
        spark, ("used", "a", 50, 10.0), ("used", "a", 40, 90.0), ("total", "a", 45, 100.0), ("used", "b", 40, 5.0),
        ("used", "c", 40, 1.0), ("total", "c", 40, 0.0),
    )
    got = {r.instance: r.percent for r in series.metric_ratio(df, ["instance"], "used", "total", 3600).collect()}
    assert got == {"a": 90.0, "c": None}
    rest = series.metric_ratio(df, ["instance"], "used", "total", 3600, complement=True)
    assert rest.where("instance = 'a'").first().percent == pytest.approx(10.0)


def test_reducers_histogram_and_freshness(spark):
    df = samples(spark, ("a", "i", 30, 0.005), ("a", "i", 20, 301.0), ("a", "i", 10, None))
    row = series.series_reducers(df, ["name"]).first()
    assert (row["max"], row.last_not_null) == (301.0, 301.0)
    buckets = {r.le: r.bucket_count for r in series.histogram_buckets(df, ["name"]).collect()}
    assert (len(buckets), buckets["0.005"], buckets["300.0"], buckets["+Inf"]) == (16, 1, 1, 2)
    assert series.freshness_gauge(df, "name", "ts", now()).first().age_seconds == 10.0
    assert series.stale_sources(df, "name", "ts", now(), 10).count() == 0
    assert series.stale_sources(df, "name", "ts", now(), 9.9).count() == 1


def test_pipeline_metrics(spark):
    df = history(spark, ("a", "failed", 5, 10), ("a", "failed", 4, 10), ("a", "success", 3, 10), ("b", "failed", 1, 10))
    got = series.pipeline_run_metrics(df, "dag_id", F.col("state") == "success", "start_date", "run_id")
    assert {(r.metric, r.label): r.value for r in got.collect()} == {
        ("pipeline_failures_total", "a"): 2.0, ("pipeline_last_run_success", "a"): 1.0,
        ("pipeline_failures_total", "b"): 1.0, ("pipeline_last_run_success", "b"): 0.0,
    }


def test_logs(spark):
    rows = [(NOW - timedelta(hours=168), "c", "ok"), (NOW - timedelta(hours=169), "c", "Traceback"), (NOW, "d", "a Warning")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, container_name string, line string")
    assert {(r.container_name, r.lines) for r in logs.log_error_counts(df, ["container_name"]).collect()} == {("c", 1), ("d", 1)}
    assert sorted(r.line for r in logs.reject_old(df, "ts", now()).collect()) == ["a Warning", "ok"]


def test_volume_anomaly_fills_empty_days(spark):
    counts = [10, 11, 10, 9, 10, 11, 10, 0, 10, 40]
    rows = [(datetime(2024, 1, 1) + timedelta(days=d, minutes=i),) for d, n in enumerate(counts) for i in range(n)]
    got = anomaly.volume_anomaly(spark.createDataFrame(rows, "ts timestamp_ntz"), "ts").orderBy("day").collect()
    assert [r.row_count for r in got] == counts
    assert [r.baseline_days for r in got] == list(range(10))
    assert [r.z_score is None for r in got] == [True] * 7 + [False] * 3
    past = np.array(counts[:9])
    assert got[9].z_score == pytest.approx((40 - past.mean()) / past.std(ddof=1))
    assert [r.is_anomaly for r in got] == [False] * 7 + [True, False, True]


def test_newest_samples_hash_and_order_by_time_then_id(spark):
    far = datetime(9000, 1, 1)
    rows = [
        ("a", 2, NOW, 1.0), ("a", -3, NOW, 2.0), ("a", 9, NOW - timedelta(microseconds=1), 3.0), ("a", None, NOW, 4.0),
        ("b", 2**63 - 1, NOW, 5.0), ("b", -(2**63), NOW + timedelta(microseconds=1), 6.0),
        ("c", 1, None, 7.0), ("c", 5, datetime(1, 1, 1), 8.0), ("d", 4, None, 9.0), ("e", 2**63 - 1, far, 10.0), ("e", 1, far, 11.0),
    ]
    df = spark.createDataFrame(rows, "k string, event_id bigint, ts timestamp_ntz, value double")
    newest = series.latest_samples(df, ["k"], tiebreak="event_id")
    assert {r.k: r.value for r in newest.collect()} == {"a": 1.0, "b": 6.0, "c": 8.0, "d": 9.0, "e": 10.0}
    for plan in (newest, series.series_reducers(df, ["k"]), series.pipeline_run_metrics(df, "k", F.col("value") > 2, "ts", "event_id")):
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_volume_anomaly_counts_chosen_rows_in_one_scan(spark, tmp_path):
    rows = [(datetime(2024, 1, 1) + timedelta(days=d, minutes=i),) for d in (0, 2, 5) for i in range(d + 1)]
    spark.createDataFrame(rows, "ts timestamp_ntz").write.parquet(str(tmp_path / "rows"))
    got = anomaly.volume_anomaly(
        spark.read.parquet(str(tmp_path / "rows")), "ts", where=F.col("ts") >= F.lit("2024-01-02").cast("timestamp_ntz"))
    assert [(r.day.day, r.row_count) for r in got.orderBy("day").collect()] == [(3, 3), (4, 0), (5, 0), (6, 6)]
    assert got._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    assert anomaly.volume_anomaly(spark.createDataFrame([], "ts timestamp_ntz"), "ts").count() == 0


def host_samples(spark, *series):
    """One sample a minute for a quarter of an hour; a series is its name, labels, first value and growth per minute."""
    start, labels = datetime(2024, 1, 1), ["instance", "device", "mode", "fstype", "cpu", "mountpoint"]
    rows = [
        (name, *[own.get(c) for c in labels], minute, start + timedelta(minutes=minute), first + growth * minute)
        for name, own, first, growth in series for minute in range(15)
    ]
    columns = ", ".join(f"{c} string" for c in ["name", *labels])
    return spark.createDataFrame(rows, f"{columns}, event_id long, ts timestamp_ntz, value double")


def test_processors_of_a_host_are_series_of_their_own(spark):
    idle = [
        ("node_cpu_seconds_total", {"instance": host, "mode": "idle", "cpu": cpu}, first, growth)
        for host, growth in (("busy", 2.0), ("calm", 50.0)) for cpu, first in (("0", 1_000.0), ("1", 100_000.0))
    ]
    found = alert_rules.held_rule_alerts(host_samples(spark, *idle)).select("alertname", "instance", "cpu").collect()
    assert [tuple(r) for r in found] == [("HostHighCPU", "busy", None)]


def test_a_full_mount_next_to_an_empty_one(spark):
    disks = [
        (f"node_filesystem_{part}_bytes", {"instance": "h", "fstype": "ext4", "mountpoint": mount}, value, 0.0)
        for mount, free in (("/", 5.0), ("/data", 90.0)) for part, value in (("avail", free), ("size", 100.0))
    ]
    found = alert_rules.held_rule_alerts(host_samples(spark, *disks)).select("alertname", "mountpoint").collect()
    assert [tuple(r) for r in found] == [("HostDiskSpaceLow", "/")]
