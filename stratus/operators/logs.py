"""Log-line filters and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import log_line, matches_log_errors

# Fixed value: samples older than this are refused.
MAX_AGE_HOURS = 168


def error_lines(logs: DataFrame, line: str = "line") -> DataFrame:
    return logs.where(matches_log_errors(line))


def log_error_counts(logs: DataFrame, labels: list[str], line: str = "line") -> DataFrame:
    return error_lines(logs, line).groupBy(*labels).agg(F.count("*").alias("lines"))


def formatted_lines(logs: DataFrame, container: str = "container_name", line: str = "line") -> DataFrame:
    return logs.withColumn("formatted", log_line(container, line))


def reject_old(df: DataFrame, ts: str, now: Column, hours: float = MAX_AGE_HOURS) -> DataFrame:
    """Keep rows no older than the limit at ``now``. Stateless, so equal on batch and stream."""
    return df.where(F.col(ts) >= now.cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours)))
