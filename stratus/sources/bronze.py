"""Immutable raw zone: date-partitioned Parquet that is only ever appended to."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ("source", "year", "month", "day")


def date_parts(at: Column | str) -> dict[str, Column]:
    """Partition values, zero-padded as in the folder names."""
    return {
        "year": F.date_format(at, "yyyy"),
        "month": F.date_format(at, "MM"),
        "day": F.date_format(at, "dd"),
    }


def write_bronze(
    df: DataFrame, path: str, at: str = "extracted_at", compression: str = "snappy"
) -> None:
    """Append payload rows under ``source=/year=/month=/day=``.

    The rebalance hint lets the adaptive planner gather a day's rows into few
    files and still split a day that is too big for one task.
    """
    (
        df.withColumns(date_parts(at))
        .hint("rebalance", *PARTITIONS)
        .write.mode("append")
        .option("compression", compression)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_bronze(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def partition_date() -> Column:
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


def in_date_range(df: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Rows of the inclusive date range; only partition columns are tested, so files are pruned."""
    first, last = (F.lit(str(d)[:10]).cast("date") for d in (start, end))
    return df.where(partition_date().between(first, last))


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a read with their row counts.

    Asks for no data column, so Parquet answers from the footers, and the
    count is combined per task before the shuffle.
    """
    return df.select(F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(
        F.count("*").alias("rows")
    )


def read_payload(df: DataFrame, source: str, city: str, extracted_at: datetime | str) -> DataFrame:
    """The raw text of one payload, addressed as it was stored."""
    at = F.lit(str(extracted_at)).cast("timestamp_ntz")
    return df.where(
        (F.col("source") == source)
        & (partition_date() == F.to_date(at))
        & (F.col("city") == city)
        & (F.col("extracted_at").cast("timestamp_ntz") == at)
    ).select("raw_json")


def with_load_ids(df: DataFrame, load_id: str, *natural_key: str) -> DataFrame:
    """Stamp the load and a row id that a retried task reproduces."""
    stamped = df.withColumn("load_id", F.lit(load_id))
    identity = F.to_json(F.struct("load_id", *natural_key), {"ignoreNullFields": "false"})
    return stamped.withColumn("row_id", F.sha2(identity, 256))


def append_load(df: DataFrame, path: str, load_id: str, *natural_key: str) -> None:
    with_load_ids(df, load_id, *natural_key).write.mode("append").parquet(path)
