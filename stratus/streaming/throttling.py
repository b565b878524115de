"""Notification throttling on a stream of alerts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stratus.operators.alerts import repeat_seconds
from stratus.streaming.jobs import event_time

SCHEMA = "alertname string, severity string, notified_at timestamp, alerts bigint"


class ThrottleProcessor(StatefulProcessor):
    """Keeps, per group, when it last notified and how many alerts came since."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getValueState("sent", "last timestamp, waiting bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # One row per tick arrives here, so a group's part of a micro-batch is small.
        ticks = pd.concat(list(rows)).sort_values("tick", kind="stable")
        last, waiting = self.sent.get() if self.sent.exists() else (None, 0)
        last = None if last is None else pd.Timestamp(last)
        notified = []
        for tick, alerts, interval in zip(ticks["tick"], ticks["alerts"], ticks["interval"]):
            waiting += int(alerts)
            if last is None or tick - last >= pd.Timedelta(seconds=interval):
                notified.append((*key, tick, waiting))
                last, waiting = tick, 0
        self.sent.update((last.to_pydatetime(), waiting))
        if notified:
            yield pd.DataFrame(notified, columns=["alertname", "severity", "notified_at", "alerts"])

    def close(self) -> None:
        pass


def throttled_alerts(
    alerts: DataFrame, ts: str = "ts", tick_seconds: int = 15, lateness: str = "1 minute"
) -> DataFrame:
    """Notifications per (alertname, severity), at most one per repeat interval (append mode).

    The streaming form of ``operators.alerts.alert_throttle``: alerts are
    counted per tick first, and ticks closed by the watermark reach the
    group's state in order. Needs ``holding.use_keyed_state``.
    """
    ticks = event_time(alerts, ts, lateness).groupBy(
        "alertname", "severity", F.window(ts, f"{tick_seconds} seconds")
    ).agg(F.count("*").alias("alerts"))
    timed = ticks.select(
        "alertname", "severity", F.col("window.start").alias("tick"), "alerts", repeat_seconds("severity").alias("interval")
    )
    return timed.groupBy("alertname", "severity").transformWithStateInPandas(
        ThrottleProcessor(), SCHEMA, "append", "None"
    )
