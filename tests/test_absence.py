"""Absence of samples: gap intervals against an evaluation grid, in batch and on a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratus.operators.absence import absence_periods, last_samples
from stratus.plans import alert_rules
from stratus.session import work_path
from stratus.streaming import holding, running
from stratus.streaming.absence import absence_stream

START = datetime(2024, 1, 1)
SAMPLE = "name string, event_id bigint, ts timestamp_ntz, value double"


def at(seconds):
    return START + timedelta(seconds=seconds)


def moment(seconds):
    return F.lit(at(seconds)).cast("timestamp_ntz")


def sampled(spark, *rows):
    return spark.createDataFrame([(n, i, None if s is None else at(s), 1.0) for i, (n, s) in enumerate(rows)], SAMPLE)


def evaluated(times, since, until, lookback, step, hold):
    """The rule at every point of the grid, written out."""
    grid = [t for t in range(-(-since // step) * step, until + 1, step)]
    out, run = [], []
    for t in [*grid, None]:
        if t is not None and not any(t - lookback < s <= t for s in times):
            run.append(t)
            continue
        if run and run[-1] - run[0] >= hold:
            out.append((at(run[0]), at(run[-1]), len(run), at(run[0] + hold)))
        run = []
    return out


@pytest.mark.parametrize("lookback,step,hold", [(300, 60, 120), (300, 60, 0), (45, 60, 0), (100, 9, 27), (60, 60, 600)])
def test_periods_equal_the_evaluated_grid(spark, lookback, step, hold):
    rng = random.Random(lookback + step)
    series = {f"s{k}": sorted(rng.sample(range(-500, 9_000), rng.choice([0, 1, 3, 15, 60]))) for k in range(12)}
    series["border"] = [0, 300, 600, 1_200, 3_600]
    series["twice"] = [40, 40, 40, 5_000, 5_000]
    rows = [(n, s) for n, times in series.items() for s in times] + [("border", None), (None, 100)]
    expected = spark.createDataFrame([(n,) for n in series] + [("s1",)], "name string")
    got = absence_periods(
        sampled(spark, *rows), ["name"], moment(30), moment(8_000), lookback, step, hold, expected=expected
    ).collect()
    series[None] = [100]
    wanted = [(n, *p) for n, times in series.items() for p in evaluated(times, 30, 8_000, lookback, step, hold)]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_only_seen_series_without_expected_ones(spark):
    got = absence_periods(sampled(spark, ("a", 0)), ["name"], moment(0), moment(600), 300, 60).collect()
    assert [tuple(r) for r in got] == [("a", at(300), at(600), 6, at(300))]
    none = absence_periods(sampled(spark), ["name"], moment(0), moment(600), 300, 60)
    assert none.collect() == []


def test_a_hot_series_has_one_row_per_cell(spark):
    hot = spark.range(20_000).selectExpr("'a' AS name", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id / 10) AS ts")
    assert last_samples(hot, ["name"], 300).count() == 7


RULE_SAMPLE = "name string, instance string, device string, mode string, fstype string, event_id bigint, ts timestamp_ntz, value double"


def rule_samples(spark, *series):
    rows = [(n, i, None, None, None, k, at(s), float(k)) for n, i, times in series for k, s in enumerate(times)]
    return spark.createDataFrame(rows, RULE_SAMPLE)


def test_a_stopped_series_fires_in_the_shipped_rules(spark):
    """The heartbeat stops for ten minutes and again at the end; another host's heartbeat would do, another metric not."""
    beats = [*range(0, 1_200, 60), *range(1_800, 3_000, 60)]
    samples = rule_samples(
        spark, ("airflow_scheduler_heartbeat", "h1", beats), ("up", "loki", range(0, 4_000, 100)), ("up", "redis", range(0, 4_000, 100)),
    )
    fired = [
        tuple(r) for r in alert_rules.held_absences(samples).select("alertname", "severity", "component", "instance", "started_at", "ended_at").collect()
    ]
    down = ("AirflowSchedulerDown", "critical", "scheduler", None)
    assert sorted(fired) == [(*down, at(1_440), at(1_740)), (*down, at(3_240), at(3_960))]
    all_alerts = alert_rules.all_rule_alerts(samples)
    assert sorted(
        (r.started_at, r.ended_at, r.samples) for r in all_alerts.where("alertname = 'AirflowSchedulerDown' AND instance IS NULL").collect()
    ) == [(at(1_440), at(1_740), 6), (at(3_240), at(3_960), 13)]


def test_rules_on_series_that_never_came(spark):
    samples = rule_samples(spark, ("airflow_scheduler_heartbeat", "h1", range(0, 600, 60)), ("up", "redis", range(0, 600, 60)))
    fired = alert_rules.held_absences(samples).collect()
    assert [(r.alertname, r.severity, r.instance, r.started_at, r.ended_at) for r in fired] == [
        ("LokiDown", "warning", "loki", at(60), at(600))]
    assert alert_rules.held_absences(samples.limit(0)).collect() == []


def test_silence_on_a_stream(spark):
    """Five files, one per batch; timers fire for keys that no longer come, and gaps within one batch are found."""
    holding.use_keyed_state(spark)
    path = work_path(spark, "silence")
    series = {
        "a": range(0, 3_600, 30), "b": range(0, 900, 30), "c": [*range(0, 900, 30), *range(2_400, 3_600, 30)],
        "d": [0, 10, 1_500, 1_510, 3_590], "hot": [t / 10 for t in range(0, 36_000, 25)],
    }
    rows = sorted(((s, n) for n, times in series.items() for s in times))
    for part in range(5):
        chosen = [(n, s) for s, n in rows if s // 720 == part]
        sampled(spark, *chosen).coalesce(1).write.mode("append").parquet(path)
    sampled(spark, ("z", 20_000)).coalesce(1).write.mode("append").parquet(path)  # time goes on
    expected = spark.createDataFrame([("never", at(600)), ("a", at(0))], "name string, watched_from timestamp_ntz")
    landed = running.stream_table(spark, path, spark.createDataFrame([], SAMPLE).schema, 1)
    stream = absence_stream(landed, ["name"], 300, 120, 60, expected=expected)
    got = sorted((r.name, r.absent_since, r.fires_from) for r in running.finish_append(stream, "silence").collect())
    batch = absence_periods(spark.read.parquet(path), ["name"], moment(0), moment(20_000), 300, 60, 120)
    wanted = [(r.name, r.started_at, r.fires_from) for r in batch.where("name <> 'z'").collect()]
    wanted.append(("never", at(600), at(720)))
    assert got == sorted(wanted) and {w[0] for w in wanted} == {"a", "b", "c", "d", "hot", "never"}
