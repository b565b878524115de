"""Reasoning about samples that are not there: periods in which a series is absent.

A rule looks for a sample in ``(t - lookback, t]`` at every multiple ``t`` of its step. Between two samples a series is
absent from ``lookback`` after the first until the second comes; before the first and after the last it is absent
towards the ends of the evaluation. So the grid is never written out: a gap gives its first and last evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import epoch_micros
from stratus.operators.slices import MICROS, instant_of


def _first_tick(micros: Column, step: int) -> Column:
    """The first multiple of the step at or after a time."""
    return F.ceil(micros / F.lit(step)).cast("bigint")


def last_samples(
    samples: DataFrame, keys: list[str], lookback_seconds: float, ts: str = "ts", step_seconds: float | None = None
) -> DataFrame:
    """First and last sample of every cell of the lookback's width, per series.

    With a step longer than the lookback some samples are seen by no evaluation; they are left out.

    Two neighbours within a cell are closer than the lookback, so no absence lies between them. Extremes are combined
    per task: a hot series meets as at most one row per task and cell, and has one row per cell after that.
    """
    at = epoch_micros(ts)
    cell = F.floor(at / F.lit(int(lookback_seconds * MICROS)))
    timed = samples.where(F.col(ts).isNotNull()).select(*keys, cell.alias("_cell"), at.alias("_at"))
    if step_seconds is not None and step_seconds > lookback_seconds:
        step, lookback = int(step_seconds * MICROS), int(lookback_seconds * MICROS)
        timed = timed.where(_first_tick(F.col("_at"), step) < _first_tick(F.col("_at") + lookback, step))
    return timed.groupBy(*keys, "_cell").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))


def absence_periods(
    samples: DataFrame, keys: list[str], since: Column, until: Column, lookback_seconds: float, step_seconds: float,
    hold_seconds: float = 0, ts: str = "ts", expected: DataFrame | None = None,
) -> DataFrame:
    """Maximal periods in which a series had no sample, held for at least ``hold_seconds``.

    Returns keys, ``started_at`` and ``ended_at`` (first and last evaluation without a sample), ``evaluations`` and
    ``fires_from``. Evaluations are the multiples of the step from ``since`` to ``until``, both included. Series are
    those with a sample, and those of ``expected``, which may never have had one. Rows without a time are no samples;
    null keys are a series like any other. Samples after ``until`` end no period.
    """
    step, lookback = int(step_seconds * MICROS), int(lookback_seconds * MICROS)
    low, high = _first_tick(epoch_micros(since), step), F.floor(epoch_micros(until) / F.lit(step)).cast("bigint")
    seen = last_samples(samples, keys, lookback_seconds, ts, step_seconds)
    if expected is not None:
        nothing = [F.lit(None).cast("bigint").alias(c) for c in ("_cell", "_first", "_last")]
        seen = seen.unionByName(expected.select(*keys).distinct().select(*keys, *nothing))
    series = Window.partitionBy(*keys).orderBy(F.col("_cell").asc_nulls_first())
    # The end of the gap before a cell's first sample, and of the gap after the last one of all.
    after = F.struct(F.col("_last").alias("_a"), F.lit(None).cast("bigint").alias("_b"))
    before = F.struct(F.lag("_last").over(series).alias("_a"), F.col("_first").alias("_b"))
    ends = seen.select(
        *keys,
        F.when(F.col("_cell").isNotNull(), before).alias("_before"),
        F.when(F.lead(F.lit(1)).over(series).isNull(), after).alias("_after"),
    )
    gaps = ends.select(*keys, F.inline(F.filter(F.array("_before", "_after"), lambda g: g.isNotNull())))
    first = F.greatest(low, _first_tick(F.col("_a") + lookback, step))
    last = F.least(high, _first_tick(F.col("_b"), step) - 1)
    periods = gaps.select(*keys, first.alias("_from"), last.alias("_to"))
    held = (F.col("_to") - F.col("_from")) * F.lit(step) >= F.lit(int(hold_seconds * MICROS))
    return periods.where((F.col("_from") <= F.col("_to")) & held).select(
        *keys,
        instant_of(F.col("_from") * step).alias("started_at"), instant_of(F.col("_to") * step).alias("ended_at"),
        (F.col("_to") - F.col("_from") + 1).alias("evaluations"),
        instant_of(F.col("_from") * step + int(hold_seconds * MICROS)).alias("fires_from"),
    )
