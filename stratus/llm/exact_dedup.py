"""Exact duplicates: grouped by a 128-bit content hash, confirmed byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.tables import store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: str | Column) -> Column:
    """Only A-Z are lower-cased; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _classes(
    docs: DataFrame, doc_id: str, text: str, keep: str, hash_of: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame | None]:
    """One row per content hash (the id that stays, the group's size), and the hashes that several texts share."""
    body = docs.select(F.col(doc_id).alias("_id"), normalised(text).alias("_text"))
    stays = F.max("_id") if keep == "largest" else F.min("_id")
    # Hash and bytes are the key together: equal texts are combined in each task, before the shuffle,
    # so a group of any size reaches the next step as one row per task.
    texts = body.groupBy(hash_of(F.col("_text")).alias("_hash"), "_text").agg(
        stays.alias("_keep"), F.count("*").alias("_size")
    )
    by_hash = store(
        texts.groupBy("_hash").agg(
            F.max("_keep").alias("_keep"), F.max("_size").alias("_size"), F.count("*").alias("_texts")
        ),
        "dedup-classes",
    )
    shared = by_hash.filter("_texts > 1").select("_hash")
    if shared.isEmpty():
        return by_hash.drop("_texts"), None
    return by_hash.filter("_texts = 1").drop("_texts"), store(texts.join(shared, "_hash"), "dedup-collisions")


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after lower-casing A-Z; a null text equals an empty one. Of equal texts the row
    with the smallest id stays (``keep="largest"``: the largest). A null id ranks behind all others, so it stays only
    where no row of the group has an id. Rows that repeat an id with the same text each count, and share one verdict;
    ``drop_duplicates`` leaves one of them. Columns of ``docs`` other than the two are not looked at. No rows in, no
    rows out. Two texts with one hash are told apart by their bytes.
    """
    classes, collisions = _classes(docs, doc_id, text, keep, hash_of)
    body = docs.select(F.col(doc_id).alias("_id"), normalised(text).alias("_text"))
    rows = body.select("_id", hash_of(F.col("_text")).alias("_hash"), F.sha2("_text", 256).alias("_sha"))
    found = rows.join(classes, "_hash")
    if collisions is not None:
        apart = body.withColumn("_hash", hash_of(F.col("_text"))).join(collisions, ["_hash", "_text"])
        found = found.unionByName(apart.select("_hash", "_id", F.sha2("_text", 256).alias("_sha"), "_keep", "_size"))
    return found.select(
        F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def drop_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; of repeated rows one."""
    classes, collisions = _classes(docs, doc_id, text, keep, hash_of)
    # The whole row travels as one struct, so its column names cannot clash with the ones used here.
    body = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), normalised(text).alias("text"))
    body = body.select("row", hash_of(F.col("text")).alias("hash"), _who("id").alias("who"), "text")
    kept = body.join(classes.select(F.col("_hash").alias("hash"), _who("_keep").alias("who")), ["hash", "who"], "left_semi")
    if collisions is not None:
        apart = collisions.select(F.col("_hash").alias("hash"), _who("_keep").alias("who"), F.col("_text").alias("text"))
        kept = kept.unionByName(body.join(apart, ["hash", "who", "text"], "left_semi"))
    again = Window.partitionBy("hash", "who", F.sha2("text", 256)).orderBy(F.lit(0))
    return kept.withColumn("nth", F.row_number().over(again)).filter("nth = 1").select("row.*")


def _who(doc_id: str) -> Column:
    """The id as a key that also equals itself where it is null."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
