"""File exports, report sink and ad-hoc SQL over named relations."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Keeps microseconds, which the default CSV formats cut.
CSV_OPTIONS = {
    "header": True,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def export_parquet(df: DataFrame, path: str, compression: str = "zstd") -> str:
    df.write.mode("errorifexists").option("compression", compression).parquet(path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)
    return path


def read_csv_export(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a CSV export with the schema of the frame it came from."""
    return spark.read.schema(like.schema).options(**CSV_OPTIONS).csv(path)


def write_report(results: DataFrame, path: str, name: str, run_at: datetime | str) -> None:
    """Append check results as JSON under ``report=/run_ts=``."""
    stamp = run_at if isinstance(run_at, str) else run_at.strftime("%Y%m%dT%H%M%S")
    (
        results.withColumns({"report": F.lit(name), "run_ts": F.lit(stamp)})
        .write.mode("append")
        .partitionBy("report", "run_ts")
        .json(path)
    )


def run_sql(
    spark: SparkSession, sql: str, relations: dict[str, DataFrame] | None = None, **args: Any
) -> DataFrame:
    """Lazy result of SQL text over named relations; values enter only as bound parameters."""
    for name, df in (relations or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or None)
