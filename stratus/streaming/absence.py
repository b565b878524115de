"""Alerts for series that fall silent on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stratus.functions import epoch_micros
from stratus.operators.slices import MICROS
from stratus.streaming.jobs import event_time


class AbsenceProcessor(StatefulProcessor):
    """Keeps, per series, its newest sample; an event-time timer stands where its silence will have lasted too long.

    All times are microseconds. A timer waits for the end of the step it falls in: what came in that step has been
    handed on by then, and new samples are looked at before timers that are due.
    """

    def __init__(self, keys: list[str], lookback: int, step: int, hold: int):
        self.keys, self.lookback, self.step, self.hold = keys, lookback, step, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "at bigint, reported boolean")

    def _absent_from(self, sample: int) -> int:
        """The first evaluation that finds no sample."""
        return -(-(sample + self.lookback) // self.step) * self.step

    def _watch(self, sample: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.newest.update((sample, False))
        due = self._absent_from(sample) + self.hold
        self.handle.registerTimer((due // self.step + 1) * self.step // 1_000)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        """A series that has to be there counts as seen one lookback before it is watched for."""
        self._watch(int(initialState["watched_from"].iloc[0]) - self.lookback)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # One row per step arrives here, so a key's part of a micro-batch is small.
        cells = pd.concat(list(rows)).sort_values("first", kind="stable")
        last, reported = self.newest.get() if self.newest.exists() else (None, False)
        missed = []
        for first, end in zip(cells["first"].tolist(), cells["last"].tolist(), strict=True):
            # Silences that began and ended within what has been waiting.
            if last is not None and not reported:
                gone = self._absent_from(last)
                if gone + self.hold <= (-(-first // self.step) - 1) * self.step:
                    missed.append((*key, gone, gone + self.hold))
            if last is None or end > last:
                last, reported = end, False
        self._watch(last)
        if missed:
            yield pd.DataFrame(missed, columns=[*self.keys, "absent_since", "fires_from"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        last, reported = self.newest.get()
        if not reported:
            self.newest.update((last, True))
            gone = self._absent_from(last)
            yield pd.DataFrame([(*key, gone, gone + self.hold)], columns=[*self.keys, "absent_since", "fires_from"])

    def close(self) -> None:
        pass


def absence_stream(
    samples: DataFrame, keys: list[str], lookback_seconds: int, hold_seconds: int, step_seconds: int, ts: str = "ts",
    lateness: str = "1 minute", expected: DataFrame | None = None,
) -> DataFrame:
    """One row per silence of a series, as soon as it has lasted for its lookback and hold (append mode).

    The streaming form of ``operators.absence.absence_periods``: ``absent_since`` is its ``started_at``. Samples are
    reduced to their first and last per series and step, so a hot series reaches its state with one row per step. The
    state is one time and one timer per series, whatever the number of samples. ``expected`` names series that have to
    be there: keys and ``watched_from``; they are reported though they never had a sample. Silence is seen by the
    watermark of all series: while nothing at all arrives, no time passes. Needs ``holding.use_keyed_state``.
    """
    if step_seconds > lookback_seconds:
        raise ValueError("a step must not be longer than the lookback")
    timed = event_time(samples, ts, lateness)
    cells = timed.groupBy(*keys, F.window(ts, f"{step_seconds} seconds")).agg(
        F.min(epoch_micros(ts)).alias("first"), F.max(epoch_micros(ts)).alias("last")
    )
    types = dict(samples.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", absent_since bigint, fires_from bigint"
    processor = AbsenceProcessor(keys, *(int(s * MICROS) for s in (lookback_seconds, step_seconds, hold_seconds)))
    first = None
    if expected is not None:
        first = expected.select(*keys, epoch_micros("watched_from").alias("watched_from")).groupBy(*keys)
    fired = cells.select(*keys, "window", "first", "last").groupBy(*keys).transformWithStateInPandas(
        processor, schema, "append", "EventTime", initialState=first
    )
    return fired.select(*keys, *[F.timestamp_micros(c).alias(c) for c in ("absent_since", "fires_from")])
