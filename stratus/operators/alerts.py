"""Threshold rules, alert grouping and notification throttling."""

from __future__ import annotations

import operator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import epoch_micros, label_matches
from stratus.operators.slices import MICROS, instant_of, slice_number

COMPARISONS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "==": operator.eq}

# Seconds between notifications of one group, by severity.
REPEAT_SECONDS = {"critical": 3_600, "warning": 4 * 3_600}
DEFAULT_REPEAT_SECONDS = 4 * 3_600


@dataclass(frozen=True)
class Rule:
    """``metric{labels} comparison threshold`` held for ``hold`` seconds."""

    alert: str
    metric: str
    comparison: str
    threshold: float
    hold: int
    severity: str
    component: str
    labels: dict[str, str] = field(default_factory=dict)

    def broken(self, name: str = "name", value: str = "value") -> Column:
        hit = (F.col(name) == self.metric) & COMPARISONS[self.comparison](F.col(value), F.lit(float(self.threshold)))
        for label, pattern in self.labels.items():
            hit = hit & label_matches(label, pattern)
        return hit


_AIRFLOW_SERVICES = "airflow-api-server|airflow-scheduler|airflow-worker|airflow-triggerer|airflow-dag-processor"
_STACK = "airflow.*|redis|minio|postgres"

# The rules that compare a single metric with a bound.
THRESHOLD_RULES = (
    Rule("AirflowDAGImportErrors", "airflow_dag_processing_import_errors", ">", 0, 300, "warning", "scheduler"),
    Rule("AirflowExecutorSlotsExhausted", "airflow_executor_open_slots", "<=", 2, 300, "warning", "executor"),
    Rule("AirflowContainerDown", "docker_container_running", "==", 0, 60, "critical", "container",
         {"instance": _AIRFLOW_SERVICES}),
    Rule("ContainerHighCPU", "docker_container_cpu_usage_percent", ">", 90, 300, "warning", "container",
         {"instance": _STACK}),
    Rule("InfrastructureServiceDown", "docker_container_running", "==", 0, 60, "critical", "infrastructure",
         {"instance": "redis|postgres|minio"}),
    Rule("ContainerUnhealthy", "docker_container_health_status", "==", 0, 120, "warning", "container",
         {"instance": _STACK}),
    Rule("PushgatewayDown", "up", "==", 0, 120, "warning", "pipeline", {"instance": "pushgateway"}),
    Rule("HostDown", "up", "==", 0, 60, "critical", "host", {"instance": "node-exporter"}),
    Rule("PrometheusTargetDown", "up", "==", 0, 120, "warning", "monitoring"),
    Rule("LokiDown", "up", "==", 0, 120, "warning", "monitoring", {"instance": "loki"}),
)


def threshold_alerts(
    samples: DataFrame, rules: tuple[Rule, ...] = THRESHOLD_RULES, name: str = "name", value: str = "value"
) -> DataFrame:
    """One row per sample and rule it breaks; all rules are tested in one pass over the samples."""
    def fired(rule: Rule) -> Column:
        row = F.struct(
            F.lit(rule.alert).alias("alertname"),
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.component).alias("component"),
            F.lit(float(rule.threshold)).alias("threshold"),
            F.lit(rule.hold).alias("hold_seconds"),
        )
        return F.when(rule.broken(name, value), row)

    relevant = samples.where(F.col(name).isin(sorted({r.metric for r in rules})))
    hits = F.filter(F.array(*[fired(r) for r in rules]), lambda r: r.isNotNull())
    return relevant.select(*samples.columns, F.inline(hits))


def alert_groups(alerts: DataFrame) -> DataFrame:
    """Firing alerts per (alertname, severity) with the components concerned.

    Components come from the rule list, so a group's set is as small as that list.
    """
    return alerts.groupBy("alertname", "severity").agg(
        F.count("*").alias("firing"),
        F.array_join(F.array_sort(F.collect_set("component")), ",").alias("components"),
    )


def repeat_seconds(severity: Column | str) -> Column:
    severity = F.col(severity) if isinstance(severity, str) else severity
    known = F.create_map(*[F.lit(x) for pair in REPEAT_SECONDS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, severity), F.lit(DEFAULT_REPEAT_SECONDS))


def throttle_instants(instants: np.ndarray, interval: int) -> np.ndarray:
    """Positions that notify: the first, then each first one at least ``interval`` after the last."""
    chosen = []
    at = 0
    while at < len(instants):
        chosen.append(at)
        at = int(np.searchsorted(instants, instants[at] + interval, side="left"))
    return np.array(chosen, dtype=np.int64)


def alert_throttle(alerts: DataFrame, ts: str = "ts", tick_seconds: float = 15) -> DataFrame:
    """Notifications per (alertname, severity), at most one per repeat interval.

    Rules are evaluated on a grid of ticks, so all alerts of one group in one
    tick are one event: they are counted per tick first, combined per task.
    What is left per group is at most one small row per tick (two million a
    year at 15 s), whatever the number of alerts; only that meets in a task.
    Each notification carries the alerts since the previous one.
    """
    ticks = alerts.groupBy(
        "alertname", "severity", (slice_number(ts, tick_seconds) * int(tick_seconds * MICROS)).alias("tick")
    ).agg(F.count("*").alias("alerts"))
    timed = ticks.withColumn("interval", repeat_seconds("severity").cast("bigint") * MICROS)

    def notify(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("tick", kind="stable")
        instants = group["tick"].to_numpy()
        chosen = throttle_instants(instants, int(group["interval"].iloc[0]))
        running = np.concatenate([[0], np.cumsum(group["alerts"].to_numpy())])
        covered = running[chosen + 1] - running[np.concatenate([[0], chosen[:-1] + 1])]
        return pd.DataFrame({
            "alertname": group["alertname"].iloc[0],
            "severity": group["severity"].iloc[0],
            "tick": instants[chosen],
            "alerts": covered,
        })

    sent = timed.groupBy("alertname", "severity").applyInPandas(
        notify, "alertname string, severity string, tick bigint, alerts bigint"
    )
    return sent.select("alertname", "severity", instant_of(F.col("tick")).alias("notified_at"), "alerts")


def sample_age_seconds(ts: str, now: Column) -> Column:
    return (epoch_micros(now) - epoch_micros(ts)) / F.lit(1e6)
