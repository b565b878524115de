"""A corpus pipeline of five operators, each stage working on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import exact_dedup, importance, ngram_join, packing, pii
from stratus.llm.queries import PSEUDONYM_KEY, vocabulary
from stratus.llm.tables import read_table, store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the sample resembling the labelled good ones does not take go.

    Each row is judged by its own text, with or without an id: rows are found again by id and text.
    """
    text_hash = F.md5(F.coalesce(F.col("text"), F.lit("")))
    scores = importance.resample(docs, read_table(spark, sf_dir, "labels"), mark=text_hash)
    rejected = scores.filter(~F.col("kept")).select(F.col("doc_id").alias("id"), F.col("mark").alias("hash")).distinct()
    # The whole row travels as one struct, so its column names cannot clash with the ones used here.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_hash.alias("hash"))
    same = rows["id"].eqNullSafe(rejected["id"]) & (rows["hash"] == rejected["hash"])
    return rows.join(rejected, same, "left_anti").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the smallest id stays."""
    return ngram_join.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become pseudonyms; the number of characters follows the new text."""
    changed = pii.pseudonymise_documents(docs, PSEUDONYM_KEY)
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the token sequences."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("pii", personal_data),
    ("packing", best_fit_packing),
]

#: The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
