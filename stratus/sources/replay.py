"""Re-run of a date range from the raw zone."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.sources.bronze import PARTITIONS, file_inventory, in_date_range, read_bronze

SUMMARY = "status string, date_start date, date_end date, files_found bigint, records_loaded bigint, transformed boolean"


def replay_range(
    spark: SparkSession,
    bronze_path: str,
    target_path: str,
    start: date,
    end: date,
    transforms: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Reload an inclusive date range and report what was found.

    The reload replaces exactly the partitions it read, so a repeated or
    interrupted replay ends in the same state. ``transforms`` gets the reloaded
    rows; pass None to skip that step.
    """
    wanted = in_date_range(read_bronze(spark, bronze_path), start, end)
    totals = file_inventory(wanted).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).first()
    if totals.files == 0:
        return spark.createDataFrame([("no_data", start, end, 0, 0, False)], SUMMARY)
    (
        wanted.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(target_path)
    )
    if transforms is not None:
        transforms(in_date_range(read_bronze(spark, target_path), start, end))
    row = ("success", start, end, totals.files, totals.rows, transforms is not None)
    return spark.createDataFrame([row], SUMMARY)
