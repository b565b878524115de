"""Reading the given tables and storing intermediate results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratus.session import materialise

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a finished query are deleted at once."""
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back; its shuffles are dropped."""
    with shuffles_freed(df.sparkSession):
        return materialise(df, name)


def pieces(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``max_bytes`` of text (one row at least).

    No row is cut; this only bounds the size of the temporary arrays.
    """
    for batch in batches:
        size = batch.column(text).nbytes
        if not batch.num_rows:
            continue
        rows = max(1, int(batch.num_rows * max_bytes / max(size, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
