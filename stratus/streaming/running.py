"""Running a stream to the end of what has landed, into re-readable tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from stratus.session import work_path
from stratus.streaming.parts import Merge, PartTable, newest_by


def stream_table(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = 1_000
) -> DataFrame:
    """Parquet files as a stream, oldest first, a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # As a pattern the path may be a single file as well as a folder of part files.
    return reader.parquet(path if any(c in path for c in "*?[") else f"{path[:-1]}[{path[-1]}]")


def append_to(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append every finished row to a Parquet table, each input file exactly once."""
    writer = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], object], mode: str = "append") -> None:
    """Hand every micro-batch and its number to ``write``, which may get one again after a restart."""
    (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start().awaitTermination()
    )


def upsert_table(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> PartTable:
    """The table of an updating stream: per key the row of the newest batch."""
    with_batch = StructType([*schema.fields, StructField("batch_id", LongType())])
    return PartTable(spark, path, with_batch, newest_by(keys, "batch_id"))


def upsert_to(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> None:
    """Keep the newest row of every key; a repeated batch counts once."""
    table = upsert_table(stream.sparkSession, path, stream.schema, keys)
    each_batch(stream, checkpoint, lambda batch, n: table.commit(n, batch.withColumn("batch_id", F.lit(n).cast("long"))), "update")


def latest_rows(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Current rows of an ``upsert_to`` table."""
    return upsert_table(spark, path, schema, keys).rows().drop("batch_id")


def merge_to(stream: DataFrame, path: str, checkpoint: str, partial: Merge, merge: Merge) -> PartTable:
    """Reduce every micro-batch by itself to mergeable rows and keep these, merged level by level.

    The stream has no state, so nothing grows but the table, no row is late whatever order files come in, and rows may
    come for any time. Use it where batches can be merged: sums, counts, extremes, newest values.
    """
    spark = stream.sparkSession
    table = PartTable(spark, path, partial(spark.createDataFrame([], stream.schema)).schema, merge)
    each_batch(stream, checkpoint, lambda batch, n: table.commit(n, partial(batch)))
    return table


def append_new_to(stream: DataFrame, path: str, checkpoint: str, row_id: str, ts: str) -> PartTable:
    """Append rows whose id has not come before on the day of their time.

    Each batch is compared with the stored rows of the days it touches only, so neither the state of a stream nor a
    comparison grows with the length of the history. A row that comes again has the time it had; equal ids on different
    days are different rows. Of repeats within a batch any one stays. Rows without a time are a day of their own.
    """
    spark = stream.sparkSession
    schema = StructType([*stream.schema.fields, StructField("day", DateType())])
    table = PartTable(spark, path, schema, lambda rows: rows, ("day",))

    def write(batch: DataFrame, number: int) -> None:
        if table.manifest().has(number):
            return
        rows = batch.withColumn("day", F.to_date(ts))
        days = [r["day"] for r in rows.select("day").distinct().collect()]  # one row per day
        known = [d for d in days if d is not None]
        touched = F.col("day").isin(known) if known else F.lit(False)
        if None in days:
            touched = touched | F.col("day").isNull()
        stored = table.parts().where(touched).select(F.col(row_id).alias("_id"), F.col("day").alias("_day"))
        same = F.col(row_id).eqNullSafe(F.col("_id")) & F.col("day").eqNullSafe(F.col("_day"))
        table.commit(number, rows.dropDuplicates([row_id, "day"]).join(stored, same, "left_anti"))

    each_batch(stream, checkpoint, write)
    return table


def finish_append(stream: DataFrame, name: str) -> DataFrame:
    """Run to the end into a new table of the shared folder and read it."""
    spark = stream.sparkSession
    path = work_path(spark, name)
    append_to(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def finish_upsert(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    spark = stream.sparkSession
    path = work_path(spark, name)
    upsert_to(stream, f"{path}/table", f"{path}/checkpoint", keys)
    return latest_rows(spark, f"{path}/table", stream.schema, keys)


def finish_merge(stream: DataFrame, name: str, partial: Merge, merge: Merge) -> DataFrame:
    """Run to the end into a new table of merged parts and read it."""
    path = work_path(stream.sparkSession, name)
    return merge_to(stream, f"{path}/table", f"{path}/checkpoint", partial, merge).rows()


def finish_new(stream: DataFrame, name: str, row_id: str, ts: str) -> DataFrame:
    """Run to the end into a new table without repeats and read it."""
    path = work_path(stream.sparkSession, name)
    return append_new_to(stream, f"{path}/table", f"{path}/checkpoint", row_id, ts).rows().drop("day")
