"""Streaming jobs: daily parts, sliding sums, duplicates, contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.operators.contracts import Contract, check_contract, with_target
from stratus.operators.slices import slice_number, step_end
from stratus.plans.marts import condition_parts

PART_KEYS = ["city_name", "date_day", "weather_condition"]


def event_time(rows: DataFrame, ts: str, lateness: str | None) -> DataFrame:
    """Rows with a zoned time, local times read in the session zone; watermarked if a lateness is given.

    With a lateness the state is bounded and later rows are refused. Without one no row is late, whatever order
    the files of a backlog come in.
    """
    zoned = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    return zoned if lateness is None else zoned.withWatermark(ts, lateness)


def daily_parts(observations: DataFrame, ts: str = "measured_at", lateness: str | None = None) -> DataFrame:
    """Daily parts per city and condition, kept up to date (update mode).

    ``plans.marts.merge_parts`` turns the stored parts into the daily summary.
    Without a lateness the state is one row per city, condition and day; with one, the days that may still change.
    """
    day = F.window(ts, "1 day")
    parts = condition_parts(event_time(observations, ts, lateness), day)
    return parts.withColumn("date_day", F.col("window.start").cast("timestamp_ntz")).drop("window")


def sliding_totals(
    samples: DataFrame, keys: list[str], value: str, ts: str = "ts",
    window: str = "5 minutes", step: str = "1 minute", lateness: str | None = None,
) -> DataFrame:
    """Sum and count per series over sliding windows (update mode).

    Every row takes part in ``window / step`` windows; the copies are combined
    per task before the shuffle. ``panes`` need neither copies nor state.
    """
    windows = event_time(samples, ts, lateness).groupBy(*keys, F.window(ts, window, step))
    totals = windows.agg(F.sum(value).alias("total"), F.count(value).alias("samples"))
    bounds = {f"window_{side}": F.col(f"window.{side}").cast("timestamp_ntz") for side in ("start", "end")}
    return totals.withColumns(bounds).drop("window")


def panes(samples: DataFrame, keys: list[str], value: str, ts: str = "ts", step_seconds: int = 60) -> DataFrame:
    """Sum and count per series and pane, a tumbling window of the step's width; ``merged_panes`` joins those of several batches.

    Every row takes part in one pane, and each task sends one row per series and pane.
    """
    pane = slice_number(ts, step_seconds).alias("pane")
    rows = samples.where(F.col(ts).isNotNull())
    return rows.groupBy(*keys, pane).agg(F.sum(value).alias("total"), F.count(value).alias("samples"))


def merged_panes(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, "pane").agg(F.sum("total").alias("total"), F.sum("samples").alias("samples"))

    return merge


def sliding_from_panes(rows: DataFrame, keys: list[str], window_seconds: int = 300, step_seconds: int = 60) -> DataFrame:
    """All sliding windows that hold a pane, from the panes: keys, ``window_start``, ``window_end``, ``total``, ``samples``.

    A window belongs to its first pane, and begins at most ``window / step - 1`` steps before it and after the pane
    before that. So each pane gives the windows it is the first of, all from sums over frames of the same order: panes
    are moved and sorted once and never copied. One row per series and step is ordered together.
    """
    count = window_seconds // step_seconds
    if count * step_seconds != window_seconds or count < 1:
        raise ValueError("the window must be a whole number of steps")
    order = Window.partitionBy(*keys).orderBy("pane")

    def window(back: int) -> Column:
        """The window that begins ``back`` steps before its first pane."""
        frame = order.rangeBetween(0, count - 1 - back)
        start = F.col("pane") - back
        own = F.coalesce(F.lag("pane").over(order) < start, F.lit(True))
        return F.when(own, F.struct(
            start.alias("start"), F.sum("total").over(frame).alias("total"), F.sum("samples").over(frame).alias("samples")
        ))

    summed = rows.select(*keys, F.array(*[window(k) for k in range(count)]).alias("_windows"))
    windows = summed.select(*keys, F.inline(F.filter("_windows", lambda w: w.isNotNull())))
    return windows.select(
        *keys, step_end(F.col("start") - 1, step_seconds).alias("window_start"),
        step_end(F.col("start") + count - 1, step_seconds).alias("window_end"), "total", "samples",
    )


def per_second(totals: DataFrame, window_seconds: float) -> DataFrame:
    return totals.withColumn("rate", F.col("total") / F.lit(float(window_seconds)))


def drop_repeats(rows: DataFrame, row_id: str, ts: str, lateness: str | None = None) -> DataFrame:
    """First arrival of every row id. With a lateness, ids are forgotten once the watermark has passed them.

    Without one every id stays in the state; ``running.append_new_to`` keeps none.
    """
    timed = event_time(rows, ts, lateness)
    return timed.dropDuplicates([row_id]) if lateness is None else timed.dropDuplicatesWithinWatermark([row_id])


def contract_stream(rows: DataFrame, raw: str, contract: Contract) -> DataFrame:
    """Contract errors in flight, with the sink folder each row belongs to."""
    return with_target(check_contract(rows, raw, contract))
