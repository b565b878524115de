"""Counter and change operators over metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.operators.slices import over_windows, pairwise_steps

HOUR = 3_600


def counter_delta(previous: Column, current: Column) -> Column:
    """Growth between two counter samples; a drop is a reset and counts the new value."""
    return F.when(current < previous, current).otherwise(current - previous)


def value_changed(previous: Column, current: Column) -> Column:
    return F.when(current != previous, F.lit(1)).otherwise(F.lit(0))


def counter_increase(
    samples: DataFrame, keys: list[str], value: str,
    ts: str = "ts", tiebreak: str = "event_id", window: float = HOUR, step: float = 60,
) -> DataFrame:
    """Counter growth within the trailing window at every step a series reported."""
    steps = pairwise_steps(samples, keys, ts, value, tiebreak, counter_delta, step)
    return over_windows(steps, keys, step, {"increase": window}).withColumnRenamed("increase_samples", "samples")


def counter_rate(
    samples: DataFrame, keys: list[str], value: str,
    ts: str = "ts", tiebreak: str = "event_id", window: float = 300, step: float = 60, per: float = 1,
) -> DataFrame:
    """Counter growth per ``per`` seconds, averaged over the trailing window."""
    grown = counter_increase(samples, keys, value, ts, tiebreak, window, step)
    return grown.withColumn("rate", F.col("increase") / F.lit(float(window)) * F.lit(float(per))).drop("increase")


def value_changes(
    samples: DataFrame, keys: list[str], value: str,
    ts: str = "ts", tiebreak: str = "event_id", window: float = 900, step: float = 60,
) -> DataFrame:
    """Number of value changes within the trailing window."""
    steps = pairwise_steps(samples, keys, ts, value, tiebreak, value_changed, step)
    return over_windows(steps, keys, step, {"changes": window}).withColumnRenamed("changes_samples", "samples")


def increase_over_range(
    samples: DataFrame, keys: list[str], value: str,
    ts: str = "ts", tiebreak: str = "event_id", step: float = HOUR,
) -> DataFrame:
    """Counter growth per series over everything given."""
    steps = pairwise_steps(samples, keys, ts, value, tiebreak, counter_delta, step)
    return steps.groupBy(*keys).agg(
        F.sum(F.col("inside") + F.col("border")).alias("increase"), F.sum("samples").alias("samples")
    )


def idle_to_busy_percent(rates: DataFrame, keys: list[str], rate: str = "rate") -> DataFrame:
    """CPU use in percent from idle-time rates, averaged over the other labels."""
    return rates.groupBy(*keys).agg((F.lit(100.0) - F.avg(rate) * 100).alias("busy_percent"))
