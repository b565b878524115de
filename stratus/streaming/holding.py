"""Sustained-condition alerts on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stratus.functions import seconds_between
from stratus.operators.series import recency
from stratus.streaming.jobs import event_time

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def evaluated_ticks(
    samples: DataFrame, keys: list[str], condition: Column, tick_seconds: int,
    ts: str = "ts", tiebreak: str = "event_id", lateness: str | None = None,
) -> DataFrame:
    """The condition at the last sample of every tick, one row per series and tick.

    Works on batch and stream. This is what a rule evaluated once per interval
    sees, and it leaves a hot series with one row per tick before any ordered work.
    """
    rows = samples.withColumn("_truth", F.coalesce(condition, F.lit(False)))
    if lateness is not None:
        rows = event_time(rows, ts, lateness)
    ticks = rows.groupBy(*keys, F.window(ts, f"{tick_seconds} seconds")).agg(
        F.max_by("_truth", recency(ts, tiebreak)).alias("truth")
    )
    return ticks.select(*keys, F.col("window.start").alias("tick"), "truth")


def tick_parts(
    samples: DataFrame, keys: list[str], condition: Column, tick_seconds: int, ts: str = "ts", tiebreak: str = "event_id"
) -> DataFrame:
    """``evaluated_ticks`` of a batch with ``newest``, by which ticks of several batches merge: ``parts.newest_by``."""
    rows = samples.select(
        *keys, F.window(ts, f"{tick_seconds} seconds").alias("_window"), F.coalesce(condition, F.lit(False)).alias("_truth"),
        recency(ts, tiebreak).alias("_at"),
    )
    ticks = rows.groupBy(*keys, F.col("_window.start").alias("tick"))
    return ticks.agg(F.max_by("_truth", "_at").alias("truth"), F.max("_at").alias("newest"))


class HoldProcessor(StatefulProcessor):
    """Keeps, per series, since when the condition holds and whether that was reported."""

    def __init__(self, keys: list[str], hold_seconds: float):
        self.keys = keys
        self.hold = pd.Timedelta(seconds=hold_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.since = handle.getValueState("since", "since timestamp, reported boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # One row per tick arrives here, so a key's part of a micro-batch is small.
        ticks = pd.concat(list(rows)).sort_values("tick", kind="stable")
        since, reported = self.since.get() if self.since.exists() else (None, False)
        since = pd.Timestamp(since) if since is not None else None
        fired = []
        for tick, truth in zip(ticks["tick"], ticks["truth"]):
            if not truth:
                since, reported = None, False
                continue
            since = tick if since is None else since
            if not reported and tick - since >= self.hold:
                fired.append((*key, since, tick))
                reported = True
        if since is None:
            self.since.clear()
        else:
            self.since.update((since.to_pydatetime(), reported))
        if fired:
            yield pd.DataFrame(fired, columns=[*self.keys, "held_since", "fired_at"])

    def close(self) -> None:
        pass


def held_alerts(
    samples: DataFrame, keys: list[str], condition: Column, hold_seconds: float, tick_seconds: int,
    ts: str = "ts", tiebreak: str = "event_id", lateness: str = "1 hour",
) -> DataFrame:
    """One row per series whenever its condition has held for ``hold_seconds`` (append mode).

    Ticks are closed by the watermark and then reach the per-series state in
    order: for endless streams. The last ticks of one that ends stay open; for a
    backlog keep ``evaluated_ticks`` up to date and use ``held_ticks``. Set the session's state provider with ``use_keyed_state`` first.
    """
    ticks = evaluated_ticks(samples, keys, condition, tick_seconds, ts, tiebreak, lateness)
    types = dict(ticks.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", held_since timestamp, fired_at timestamp"
    return ticks.groupBy(*keys).transformWithStateInPandas(
        HoldProcessor(keys, hold_seconds), schema, "append", "None"
    )


def held_ticks(ticks: DataFrame, keys: list[str], hold_seconds: float) -> DataFrame:
    """What ``held_alerts`` reports, from stored ticks: complete for any order of arrival, and up to the last tick.

    A series is ordered as a whole; after ``evaluated_ticks`` it has one small row per tick, whatever its rate.
    """
    in_order = Window.partitionBy(*keys).orderBy("tick")
    begins = F.col("truth") & ~F.coalesce(F.lag("truth").over(in_order), F.lit(False))
    runs = ticks.withColumn("held_since", F.last(F.when(begins, F.col("tick")), ignorenulls=True).over(in_order))
    runs = runs.withColumn("_held", F.col("truth") & (seconds_between("held_since", "tick") >= hold_seconds))
    first = F.col("_held") & ~F.coalesce(F.lag("_held").over(in_order), F.lit(False))
    return runs.withColumn("_first", first).where("_first").select(*keys, "held_since", F.col("tick").alias("fired_at"))


def use_keyed_state(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
