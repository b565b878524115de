"""Operators over labelled metric samples ``(name, labels..., ts, value)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import epoch_micros, seconds_between
from stratus.operators.slices import slice_number, step_end

# Upper bounds of the duration histogram; a last bucket holds everything.
HISTOGRAM_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60, 120, 300)


def recency(ts: str, tiebreak: str | None = None) -> Column:
    """One number that orders rows by time, then by ``tiebreak``, a whole number; missing ones come first.

    Unlike a struct it has a fixed width, so an aggregate that keeps the newest row hashes instead of sorts.
    """
    if not tiebreak:
        return F.col(ts)
    micros = F.coalesce(epoch_micros(ts).cast("decimal(18,0)"), F.lit(1 - 10**18).cast("decimal(18,0)"))
    place = F.coalesce(F.col(tiebreak).cast("bigint"), F.lit(-(2**63)))
    return (micros * F.lit(str(2 * 10**19)).cast("decimal(20,0)") + place.cast("decimal(19,0)")).cast("decimal(38,0)")


def latest_samples(samples: DataFrame, keys: list[str], value: str = "value", ts: str = "ts",
                   tiebreak: str | None = None) -> DataFrame:
    """Newest sample of every series: one aggregate, combined per task."""
    return samples.groupBy(*keys).agg(
        F.max_by(value, recency(ts, tiebreak)).alias(value), F.max(ts).alias(ts)
    )


def metric_ratio(
    samples: DataFrame, labels: list[str], numerator: str, denominator: str, step: float,
    complement: bool = False, name: str = "name", value: str = "value", ts: str = "ts", tiebreak: str = "event_id",
) -> DataFrame:
    """Percentage of two metrics on equal labels, at the last sample of each step.

    The two metrics are told apart inside one aggregate, so there is no self-join
    and the input is read once. Steps in which one metric is missing give no row.
    ``complement`` yields the share that is *not* in the numerator.
    """
    chosen = samples.where(F.col(name).isin(numerator, denominator))

    def last_of(metric: str) -> Column:
        return F.max_by(value, F.when(F.col(name) == metric, recency(ts, tiebreak)))

    sides = chosen.groupBy(*labels, slice_number(ts, step).alias("_step")).agg(
        last_of(numerator).alias("numerator"), last_of(denominator).alias("denominator")
    )
    share = F.try_divide(F.col("numerator"), F.col("denominator"))
    percent = ((F.lit(1.0) - share) if complement else share) * 100
    return sides.where(F.col("numerator").isNotNull() & F.col("denominator").isNotNull()).select(
        *labels,
        step_end(F.col("_step"), step).alias("evaluated_at"),
        "numerator", "denominator", percent.alias("percent"),
    )


def _same_labels(left: DataFrame, right: DataFrame, labels: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in labels])


def series_and(left: DataFrame, right: DataFrame, labels: list[str]) -> DataFrame:
    """Left rows whose label set also occurs on the right."""
    keys = right.select(*labels)
    return left.join(keys, _same_labels(left, keys, labels), "left_semi")


def series_or(left: DataFrame, right: DataFrame, labels: list[str]) -> DataFrame:
    """All left rows, then the right rows whose label set is not on the left."""
    keys = left.select(*labels)
    return left.unionByName(right.join(keys, _same_labels(right, keys, labels), "left_anti"))


def absent_series(
    expected: DataFrame, samples: DataFrame, labels: list[str], now: Column, lookback_seconds: float, ts: str = "ts"
) -> DataFrame:
    """Expected series without a sample in ``(now - lookback, now]``."""
    since = now.cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(lookback_seconds))
    seen = samples.where((F.col(ts) > since) & (F.col(ts) <= now.cast("timestamp_ntz"))).select(*labels).distinct()
    return expected.join(seen, _same_labels(expected, seen, labels), "left_anti").withColumn("value", F.lit(1))


def sum_by_label(samples: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    return samples.groupBy(*by).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"))


def series_reducers(samples: DataFrame, keys: list[str], value: str = "value", ts: str = "ts",
                    tiebreak: str = "event_id") -> DataFrame:
    """Mean, maximum and last non-missing value per series."""
    when_known = F.when(F.col(value).isNotNull(), recency(ts, tiebreak))
    return samples.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.max(value).alias("max"), F.max_by(value, when_known).alias("last_not_null")
    )


def histogram_buckets(samples: DataFrame, keys: list[str], value: str = "value",
                      bounds: tuple[float, ...] = HISTOGRAM_BOUNDS) -> DataFrame:
    """Cumulative buckets with sum and count per label set, from one aggregate."""
    known = samples.where(F.col(value).isNotNull())
    counts = [F.count_if(F.col(value) <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(bounds)]
    agg = known.groupBy(*keys).agg(*counts, F.count("*").alias("observations"), F.sum(value).alias("total"))
    rows = [
        F.struct(F.lit(str(float(b))).alias("le"), F.col(f"_b{i}").alias("bucket_count"))
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("observations").alias("bucket_count")))
    return agg.select(*keys, "observations", "total", F.inline(F.array(*rows)))


def freshness_gauge(df: DataFrame, source: str, ts: str, now: Column) -> DataFrame:
    """Age in seconds of each source's newest row."""
    return df.groupBy(F.col(source).alias("source")).agg(F.max(ts).alias("last_seen")).withColumn(
        "age_seconds", seconds_between(F.col("last_seen"), now)
    )


def stale_sources(df: DataFrame, source: str, ts: str, now: Column, max_age_seconds: float = 86_400) -> DataFrame:
    return freshness_gauge(df, source, ts, now).where(F.col("age_seconds") > max_age_seconds)


def record_totals(loads: DataFrame, source: str, records: str) -> DataFrame:
    """``records_ingested_total`` per source."""
    return loads.groupBy(F.col(source).alias("label")).agg(
        F.sum(F.col(records).cast("double")).alias("value")
    ).select(F.lit("records_ingested_total").alias("metric"), "label", "value")


def pipeline_run_metrics(runs: DataFrame, pipeline: str, succeeded: Column, at: str, tiebreak: str) -> DataFrame:
    """Failure totals and the last run's status (1 or 0) per pipeline."""
    status = F.when(succeeded, F.lit(1.0)).otherwise(F.lit(0.0))
    per_pipeline = runs.groupBy(F.col(pipeline).alias("label")).agg(
        F.sum(F.lit(1.0) - status).alias("failures"), F.max_by(status, recency(at, tiebreak)).alias("last")
    )
    rows = F.array(
        F.struct(F.lit("pipeline_failures_total").alias("metric"), F.col("failures").alias("value")),
        F.struct(F.lit("pipeline_last_run_success").alias("metric"), F.col("last").alias("value")),
    )
    return per_pipeline.select("label", F.inline(rows)).select("metric", "label", "value")
