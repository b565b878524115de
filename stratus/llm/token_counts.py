"""Token totals by source, language and tokenizer version, kept up to date by signed changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.folders import delete_folder, list_folder, write_text
from stratus.llm.tables import shuffles_freed

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string"
#: The tokenizer versions counted with built-in functions. A token is a match of the pattern.
VERSIONS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "kinds-1": r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]+",
}


def count_tokens(text: Column, version: str) -> Column:
    """Tokens of a text under one of ``VERSIONS``; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def counts(docs: DataFrame, version: str, text: Column, source: str = "source", lang: str = "lang") -> DataFrame:
    """One row per document: its keys and its count. Any other tokenizer may deliver rows of this form."""
    return docs.select(
        F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"),
        F.lit(version).alias("tokenizer"), count_tokens(text, version).alias("tokens"),
    )


def inserts(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.col("tokens").cast("long").alias("n_tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("tokens")).cast("long").alias("n_tokens"))


def revisions(rows: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """Documents that stay under their keys with another count; equal counts change nothing."""
    change = F.col(after) - F.col(before)
    return rows.filter(change != 0).select(*KEYS, F.lit(0).cast("long").alias("n_docs"), change.cast("long").alias("n_tokens"))


class TokenRollup:
    """A table of signed changes at ``path``, one partition per batch, each already summed by key.

    A batch replaces its own partition as one commit, so a batch that is sent again, whole or after a failure, counts
    once. Totals are plain sums, so batches may come in any order. ``compact`` folds batches into a snapshot that
    remembers their ids; a folded batch that is sent again is ignored, by whatever object opens the table. Null keys are
    keys of their own. Keys whose totals are all zero are left out. One writer at a time.

    Which snapshot counts is stored beside it: a small file per generation, moved into its place once the snapshot is
    whole. Whatever stops before that leaves the generation before in force, with all its batches; what stops after it
    leaves folders that nothing reads, which the next compaction removes.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._empty = spark.createDataFrame([], SCHEMA)

    @property
    def generation(self) -> int:
        """The newest generation on storage."""
        return max(map(int, list_folder(self.spark, f"{self.path}/generations")), default=0)

    def _batches(self) -> DataFrame:
        return self._read(f"{self.path}/changes-{self.generation}")

    def _read(self, path: str) -> DataFrame:
        there = list_folder(self.spark, path)
        return self.spark.read.schema(SCHEMA).parquet(path).select(self._empty.columns) if there else self._empty

    def _snapshot(self) -> DataFrame:
        return self._read(f"{self.path}/snapshot-{self.generation}")

    def folded(self, batch: str) -> bool:
        return not self._snapshot().filter((F.col("batch") == batch) & F.col("n_docs").isNull()).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Store a batch; ``changes`` has the keys and the signed ``n_docs, n_tokens``. May be empty."""
        if self.folded(batch):
            return
        # Summed per task before the shuffle: a key with a third of all rows arrives as one row per task.
        summed = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        # A row without effect, so an empty batch replaces its partition too.
        mark = self.spark.range(1).select(
            *[F.lit(None).cast("string").alias(k) for k in KEYS],
            F.lit(0).cast("long").alias("n_docs"), F.lit(0).cast("long").alias("n_tokens"),
        )
        rows = summed.unionByName(mark).withColumn("batch", F.lit(batch))
        with shuffles_freed(self.spark):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(
                f"{self.path}/changes-{self.generation}"
            )

    def totals(self) -> DataFrame:
        rows = self._batches().unionByName(self._snapshot().filter("n_docs IS NOT NULL"))
        summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold all batches into the next snapshot: the totals, and a row without counts per batch id."""
        nothing = [F.lit(None).cast(t).alias(c) for c, t in self.totals().dtypes]
        ids = self._batches().select("batch").union(self._snapshot().filter("n_docs IS NULL").select("batch")).distinct()
        rows = self.totals().withColumn("batch", F.lit(None).cast("string")).unionByName(ids.select(*nothing, "batch"))
        now = self.generation
        rows.write.mode("overwrite").parquet(f"{self.path}/snapshot-{now + 1}")
        write_text(self.spark, f"{self.path}/generations/{now + 1}", "")
        for name in list_folder(self.spark, self.path):
            kind, _, number = name.partition("-")
            if kind in ("changes", "snapshot") and int(number) <= now:
                delete_folder(self.spark, f"{self.path}/{name}")
