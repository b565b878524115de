"""Run-history operators over ``(dag_id, run_id, state, start_date, end_date)``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import elapsed_seconds, error_prefix, pg_round, seconds_between

# Fixed values of the run checks.
STUCK_AFTER_SECONDS = 4 * 3_600
ANOMALY_FACTOR = 3.0
ANOMALY_RUNS = 20
MISSED_AFTER_HOURS = 24
RECENT_RUNS = 200
RECENT_ERRORS = 50
# Number shown for a run state; any other state is 0.
STATE_CODES = {"success": 1, "running": 2, "failed": 3, "queued": 4}


def _between(runs: DataFrame, start: datetime | str | None, end: datetime | str | None) -> DataFrame:
    if start is not None:
        runs = runs.where(F.col("start_date") >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        runs = runs.where(F.col("start_date") <= F.lit(str(end)).cast("timestamp_ntz"))
    return runs


def run_state_counts(runs: DataFrame, states: list[str], start=None, end=None) -> DataFrame:
    """One row: how many runs are in each asked state, from one pass."""
    return _between(runs, start, end).agg(*[F.count_if(F.col("state") == s).alias(f"n_{s}") for s in states])


def success_rate(runs: DataFrame, start=None, end=None) -> DataFrame:
    counts = _between(runs, start, end).groupBy("dag_id").agg(
        F.count_if(F.col("state") == "success").alias("successes"),
        F.count_if(F.col("state") == "failed").alias("failures"),
        F.count("*").alias("total"),
    )
    rate = F.try_divide(F.lit(100.0).cast("double") * F.col("successes"), F.col("total"))
    return counts.withColumn("success_rate", pg_round(rate, 1)).orderBy(
        F.col("failures").desc_nulls_first(), F.col("dag_id").asc_nulls_last()
    )


def duration_stats(runs: DataFrame, start=None, end=None) -> DataFrame:
    """Seconds per finished run: count, mean, extremes and sample deviation."""
    finished = _between(runs, start, end).where(F.col("end_date").isNotNull())
    timed = finished.select("dag_id", seconds_between("start_date", "end_date").alias("seconds"))
    stats = {"avg_seconds": F.avg, "min_seconds": F.min, "max_seconds": F.max, "stddev_seconds": F.stddev_samp}
    return timed.groupBy("dag_id").agg(
        F.count("*").alias("runs"), *[pg_round(f("seconds"), 1).alias(name) for name, f in stats.items()]
    ).orderBy(F.col("avg_seconds").desc_nulls_first(), F.col("dag_id").asc_nulls_last())


def recent_runs(runs: DataFrame, now: Column, limit: int = RECENT_RUNS, start=None, end=None) -> DataFrame:
    """Newest runs with their elapsed seconds; open runs are measured to ``now``."""
    return (
        _between(runs, start, end).where(F.col("start_date").isNotNull())
        .orderBy(F.col("start_date").desc_nulls_first(), F.col("run_id").desc_nulls_last())
        .limit(limit)
        .withColumn("elapsed_seconds", elapsed_seconds("start_date", "end_date", now))
    )


def recent_errors(errors: DataFrame, text: str, at: str, limit: int = RECENT_ERRORS) -> DataFrame:
    """Newest import errors with shortened text."""
    return errors.orderBy(F.col(at).desc_nulls_first()).limit(limit).withColumn(text, error_prefix(text))


def state_code(state: Column | str) -> Column:
    state = F.col(state) if isinstance(state, str) else state
    codes = F.create_map(*[F.lit(x) for pair in STATE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, state), F.lit(0))


def state_timeline(runs: DataFrame, now: Column, start=None, end=None) -> DataFrame:
    """Start events with the state code and end events with 0, from one scan, in time order."""
    begin = F.struct(F.col("start_date").alias("time"), state_code("state").alias("value"))
    finish = F.struct(
        F.coalesce(F.col("end_date"), now.cast("timestamp_ntz")).alias("time"), F.lit(0).alias("value")
    )
    events = _between(runs, start, end).select(F.col("dag_id").alias("metric"), F.inline(F.array(begin, finish)))
    return events.select("time", "metric", "value").orderBy(F.col("time").asc_nulls_last())


def missed_executions(dags: DataFrame, runs: DataFrame, now: Column, hours: float = MISSED_AFTER_HOURS) -> DataFrame:
    """Scheduled entities without a run start in the last hours (the bound itself counts as recent)."""
    since = now.cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    recent = runs.where(F.col("start_date") >= since).select("dag_id").distinct()
    return dags.where(F.col("has_schedule")).select("dag_id").join(recent, "dag_id", "left_anti")


def paused_or_missing(required: DataFrame, dags: DataFrame) -> DataFrame:
    """Required entities that are paused, or absent and then marked so."""
    known = dags.select("dag_id", F.coalesce("is_paused", F.lit(False)).alias("is_paused"))
    looked_up = required.select("dag_id").join(known, "dag_id", "left")
    label = F.when(F.col("is_paused").isNull(), F.concat("dag_id", F.lit(" (NOT FOUND)"))).otherwise(F.col("dag_id"))
    return looked_up.where(F.col("is_paused").isNull() | F.col("is_paused")).select(label.alias("dag_id"))


def stuck_runs(runs: DataFrame, now: Column, after_seconds: float = STUCK_AFTER_SECONDS) -> DataFrame:
    running = runs.where(F.col("state") == "running").select(
        "dag_id", "run_id", seconds_between(F.col("start_date"), now).alias("running_seconds")
    )
    return running.where(F.col("running_seconds") > after_seconds)


def duration_anomalies(runs: DataFrame, factor: float = ANOMALY_FACTOR, last: int = ANOMALY_RUNS) -> DataFrame:
    """Entities whose latest successful run took more than ``factor`` times the recent mean.

    The mean is over the last successful runs and includes the latest one, so
    at least four runs are needed for a factor of three to be exceeded. The
    row-number filter is applied per task before the shuffle, so an entity
    with most of the history still sends only ``last`` rows per task.
    """
    newest = Window.partitionBy("dag_id").orderBy(
        F.col("start_date").desc_nulls_first(), F.col("run_id").desc_nulls_last()
    )
    recent = (
        runs.where(F.col("state") == "success")
        .select("dag_id", "run_id", "start_date", "end_date", F.row_number().over(newest).alias("age"))
        .where(F.col("age") <= last)
        .where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
    )
    seconds = seconds_between("start_date", "end_date")
    return (
        recent.groupBy("dag_id")
        .agg(
            F.count("*").alias("runs"),
            F.min_by(seconds, "age").alias("latest_seconds"),
            F.avg(seconds).alias("mean_seconds"),
        )
        .where((F.col("runs") >= 2) & (F.col("latest_seconds") > F.col("mean_seconds") * factor))
    )


def ops_issues(paused: DataFrame, missed: DataFrame, stuck: DataFrame, anomalies: DataFrame) -> DataFrame:
    """All findings as ``(kind, dag_id)`` rows."""
    findings = {"paused": paused, "missed": missed, "stuck": stuck, "anomaly": anomalies}
    legs = [df.select(F.lit(kind).alias("kind"), "dag_id") for kind, df in findings.items()]
    issues = legs[0]
    for leg in legs[1:]:
        issues = issues.unionByName(leg)
    return issues


def ops_report(paused: DataFrame, missed: DataFrame, stuck: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row with the number of findings per kind and in total."""
    kinds = ("paused", "missed", "stuck", "anomaly")
    return ops_issues(paused, missed, stuck, anomalies).agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in kinds],
        F.count("*").alias("total_issues"),
    )
