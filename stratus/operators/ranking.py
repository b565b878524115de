"""Ranks over a whole relation without bringing it into one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.session import materialise


@dataclass(frozen=True)
class Rank:
    name: str
    column: str
    descending: bool = True


def _running_total(partition: list[str], order: str, value: str) -> Column:
    """Sum of ``value`` over all earlier rows of the partition."""
    frame = (
        Window.partitionBy(*partition)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(frame), F.lit(0).cast("bigint"))


def value_positions(long: DataFrame, buckets: int | None = None) -> DataFrame:
    """How many rows lie below, at and above each distinct (measure, value).

    A global ``rank() over (order by value)`` puts every row into one task.
    Here equal values are counted first (combined per task), so each occurs
    once, however often it does. The distinct values are cut into buckets at
    quantiles of themselves, which Spark takes from a sample of them: an
    outlier or a crowd of close values makes no bucket larger than another.
    Bucket totals give each bucket its offset, and only distinct values of one
    bucket are ordered together. What is done in one place is one row per
    bucket and measure. ``buckets`` is the session's number of shuffle
    partitions unless given. The cut is stored, so offsets and values follow
    the same one. NULL counts as larger than every value.
    """
    counts = long.groupBy("measure", "value").agg(F.count("*").alias("n"))
    order = [F.col("measure").asc(), F.col("value").asc_nulls_last()]
    dealt = counts.repartitionByRange(buckets, *order) if buckets else counts.repartitionByRange(*order)
    bucketed = materialise(dealt.withColumn("bucket", F.spark_partition_id()), "value_buckets")
    whole = Window.partitionBy("measure")
    offsets = (
        bucketed.groupBy("measure", "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .withColumn("offset", _running_total(["measure"], "bucket", "bucket_n"))
        .withColumn("total", F.sum("bucket_n").over(whole))
        .drop("bucket_n")
    )
    below = F.col("offset") + _running_total(["measure", "bucket"], "value", "n")
    # One row per bucket, and one more for each measure that begins within one.
    return (
        bucketed.join(F.broadcast(offsets), ["measure", "bucket"])
        .withColumn("below", below)
        .select("measure", "value", "below", (F.col("total") - F.col("below") - F.col("n")).alias("above"))
    )


def global_ranks(df: DataFrame, key: str, ranks: tuple[Rank, ...]) -> DataFrame:
    """Add one ``rank()`` column per entry of ``ranks`` over all rows of ``df``.

    ``key`` identifies a row. NULLs rank first in descending and last in
    ascending order. All measures are handled in one pass over a long form.
    ``df`` is read by several branches, so pass a stored relation.
    """
    measures = list(dict.fromkeys(r.column for r in ranks))
    entries = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
    long = df.select(F.col(key).alias("_key"), F.inline(F.array(*entries)))
    same = F.col("l.measure").eqNullSafe(F.col("p.measure")) & F.col("l.value").eqNullSafe(F.col("p.value"))
    placed = long.alias("l").join(value_positions(long).alias("p"), same)

    def rank_of(rank: Rank) -> Column:
        ahead = "above" if rank.descending else "below"
        hit = F.when(F.col("l.measure") == rank.column, F.col(ahead) + 1)
        return F.max(hit).cast("bigint").alias(rank.name)

    wide = placed.groupBy("_key").agg(*[rank_of(r) for r in ranks])
    return df.join(wide, df[key].eqNullSafe(wide["_key"])).drop("_key")


def row_positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add the row's number from 1 in the order of the whole relation.

    ``row_number() over (order by …)`` would put every row into one task. Here rows are dealt to partitions by ranges of
    the order (borders from Spark's own sample of the rows), numbered within each sorted partition, and lifted by the
    number of rows in the partitions before; only one number per partition is added up in one place. The numbered rows
    are stored, so the counts and the rows read the same numbering. Rows that are equal in the whole order share a
    partition and are numbered in any order; order by columns that tell rows apart if there may be many of them.
    ``df`` is read twice, so pass a stored relation.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id's upper bits are the partition, the lower 33 the place in it.
    numbered = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()), "positions")
    split = numbered.withColumns({"_part": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND((1 << 33) - 1)})
    sizes = split.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # One row per partition of the stored relation.
    lifted = split.join(F.broadcast(offsets), "_part")
    return lifted.withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_at", "_part", "_place", "_before")
