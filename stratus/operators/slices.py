"""Time slicing: order-dependent work on series that may hold most of the rows.

A window partitioned by series alone would bring a hot series into one task.
These helpers cut every series into slices, work within slices in parallel,
and then connect neighbouring slices through their edges. Slices are of fixed
time or of about equally many rows; per series only the edges meet, and their
number is bounded by the calendar or by the number of slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import epoch_micros

MICROS = 1_000_000


def slice_number(ts: Column | str, seconds: float) -> Column:
    """Index of the half-open time slice ``[i, i + 1) * seconds`` a time falls in."""
    return F.floor(epoch_micros(ts) / F.lit(int(seconds * MICROS))).cast("bigint")


def instant_of(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def row_slices(rows: DataFrame, order: list[str], slices: int | None = None) -> DataFrame:
    """Adds ``_slice``: the whole relation in ``order``, cut into slices of about equally many rows.

    Borders are quantiles of the order, from Spark's own sample of the rows, so a series with a third of all rows is cut
    into a third of the slices. Slices of one series follow each other by number. Only rows that are equal in the whole
    order cannot be cut apart. There are as many slices as shuffle partitions unless stated.
    """
    dealt = rows.repartitionByRange(slices, *order) if slices else rows.repartitionByRange(*order)
    return dealt.withColumn("_slice", F.spark_partition_id())


def run_lengths(
    df: DataFrame,
    keys: list[str],
    ts: str,
    state: Column,
    tiebreak: str,
    slice_seconds: float | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Maximal runs of consecutive rows with one state, per key.

    Returns keys, ``state``, ``started_at``, ``ended_at`` (first and last row
    of the run) and ``samples``; rows without a time are left out. Exact over slice borders: runs inside a slice
    are final; the first and last run of each slice are joined with their
    neighbours by a second, small pass.

    Slices hold about equally many rows (``row_slices``), so no group grows
    with the volume of a series. Where a series is known to have few rows in
    any stretch of time, as after it was reduced to one row per step,
    ``slice_seconds`` cuts by time and saves a shuffle.
    """
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("_ts"), F.col(tiebreak).alias("_tie"), state.alias("state")
    )
    if slice_seconds is None:
        rows = row_slices(rows, [*keys, "_ts", "_tie"], slices)
    else:
        rows = rows.withColumn("_slice", slice_number("_ts", slice_seconds))
    in_slice = Window.partitionBy(*keys, "_slice").orderBy("_ts", "_tie")
    previous = F.lag(F.struct("state")).over(in_slice)
    changed = previous.isNull() | ~previous["state"].eqNullSafe(F.col("state"))
    runs = (
        rows.withColumn("_change", changed.cast("int"))
        .withColumn("_run", F.sum("_change").over(in_slice.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_slice", "_run", "state")
        .agg(
            F.min("_ts").alias("started_at"),
            F.max("_ts").alias("ended_at"),
            F.count("*").alias("samples"),
        )
    )
    whole_slice = Window.partitionBy(*keys, "_slice")
    runs = (
        runs.withColumn("_head", F.col("_run") == 1)
        .withColumn("_tail", F.col("_run") == F.max("_run").over(whole_slice))
        # Edge runs of a series meet in one group; inner runs stay with their slice.
        .withColumn("_group", F.when(~(F.col("_head") | F.col("_tail")), F.col("_slice")))
    )
    sequence = Window.partitionBy(*keys, "_group").orderBy("_slice", "_run")
    before = F.lag(F.struct("state", "_tail")).over(sequence)
    joins = F.col("_head") & F.coalesce(before["_tail"] & before["state"].eqNullSafe(F.col("state")), F.lit(False))
    return (
        runs.withColumn("_start", (~joins).cast("int"))
        .withColumn("_merged", F.sum("_start").over(sequence.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_group", "_merged", "state")
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("ended_at").alias("ended_at"),
            F.sum("samples").alias("samples"),
        )
        .drop("_group", "_merged")
    )


def pairwise_steps(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    tiebreak: str,
    contribution,
    step_seconds: float,
) -> DataFrame:
    """Fold the contributions of neighbouring sample pairs into one row per key and step.

    ``contribution(previous, current)`` gives a pair's share. Per step:
    ``inside`` sums the pairs within the step, ``border`` is the pair that
    links it to the step before (0 for the first), ``samples`` counts rows.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("_ts"), F.col(tiebreak).alias("_tie"), F.col(value).alias("_value"),
        slice_number(ts, step_seconds).alias("step"),
    )
    in_step = Window.partitionBy(*keys, "step").orderBy("_ts", "_tie")
    previous = F.lag("_value").over(in_step)
    place = F.row_number().over(in_step)
    paired = rows.withColumns({
        "_share": F.when(previous.isNotNull(), contribution(previous, F.col("_value"))).otherwise(F.lit(0)),
        "_first": F.when(place == 1, F.col("_value")),
        "_last": F.when(F.lead("_ts").over(in_step).isNull(), F.col("_value")),
    })
    steps = paired.groupBy(*keys, "step").agg(
        F.sum("_share").alias("inside"),
        F.max("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.count("*").alias("samples"),
    )
    series = Window.partitionBy(*keys).orderBy("step")
    carried = F.lag("_last").over(series)
    border = F.when(carried.isNotNull(), contribution(carried, F.col("_first"))).otherwise(F.lit(0))
    return steps.withColumn("border", border).drop("_first", "_last")


def over_windows(
    steps: DataFrame, keys: list[str], step_seconds: float, windows: dict[str, float]
) -> DataFrame:
    """Sums of pair contributions within trailing windows ``[t - window, t)``, one column per window.

    ``t`` runs over the ends of the steps in which a series reported. Only
    pairs with both samples inside the window count, and two samples are
    needed; otherwise the value is NULL. A window must be a whole number of
    steps, and a frame holds at most that many rows. ``<name>_samples`` counts
    the samples in each window.
    """
    columns = []
    for name, seconds in windows.items():
        reach = round(seconds / step_seconds)
        if reach < 1 or abs(reach * step_seconds - seconds) > 1e-9:
            raise ValueError("the window must be a whole number of steps")
        frame = Window.partitionBy(*keys).orderBy("step").rangeBetween(-(reach - 1), 0)
        total = F.sum(F.col("inside") + F.col("border")).over(frame) - F.first("border").over(frame)
        samples = F.sum("samples").over(frame)
        columns += [F.when(samples >= 2, total).alias(name), samples.alias(f"{name}_samples")]
    return steps.select(*keys, step_end(F.col("step"), step_seconds).alias("evaluated_at"), *columns)


def step_end(step: Column, step_seconds: float) -> Column:
    return instant_of((step + 1) * int(step_seconds * MICROS))
