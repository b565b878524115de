"""Stored tables that grow by one part per batch and stay cheap to read.

A table is a folder of parts and a folder of manifests. A part is a Parquet folder that is written once. A manifest names
the parts that make up the table and which batches are in them; the newest one counts. It is moved into its place as one
file and last, so whatever stops before leaves the table as it was.

Parts of one level are merged into one of the next as soon as there are FANOUT of them. A table of n batches has at most
FANOUT - 1 parts on each of log(n) levels, and each row is rewritten once per level.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratus.folders import delete_folder, list_folder, read_text, write_text

FANOUT = 8

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Part:
    folder: str
    level: int


@dataclass(frozen=True)
class Manifest:
    """``through`` is the last numbered batch, ``named`` the batches with names of their own."""

    version: int = 0
    parts: tuple[Part, ...] = ()
    through: int = -1
    named: frozenset[str] = field(default_factory=frozenset)

    def has(self, batch: int | str) -> bool:
        return batch <= self.through if isinstance(batch, int) else batch in self.named

    def text(self) -> str:
        parts = [[p.folder, p.level] for p in self.parts]
        return json.dumps({"parts": parts, "through": self.through, "named": sorted(self.named)})

    @classmethod
    def parse(cls, version: int, text: str) -> Manifest:
        read = json.loads(text)
        return cls(version, tuple(Part(*p) for p in read["parts"]), read["through"], frozenset(read["named"]))


class PartTable:
    """A table at ``path`` whose parts ``merge`` makes one: it must give the same whether applied to parts or to merged ones.

    Batches are numbers that only grow (of a stream) or names. A batch that is sent again, by this object or by another
    one that opens the table later, counts once. One writer at a time; readers see the table of one manifest, and its
    folders stay until the next but one commit.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, merge: Merge, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.merge, self.partition_by = spark, path, schema, merge, partition_by

    # -- reading

    def manifest(self) -> Manifest:
        versions = [int(n.removesuffix(".json")) for n in list_folder(self.spark, f"{self.path}/manifests") if n.endswith(".json")]
        if not versions:
            return Manifest()
        newest = max(versions)
        return Manifest.parse(newest, read_text(self.spark, f"{self.path}/manifests/{newest:012d}.json"))

    def parts(self, manifest: Manifest | None = None, level: int | None = None) -> DataFrame:
        """The rows of all parts, or those of one level, as they are stored."""
        chosen = [p for p in (manifest or self.manifest()).parts if level is None or p.level == level]
        return self._read([p.folder for p in chosen])

    def rows(self) -> DataFrame:
        """The table: its parts merged."""
        return self.merge(self.parts())

    def _read(self, folders: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        paths = [f"{self.path}/parts/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        if not self.partition_by:
            return reader.parquet(*paths)
        # Parts with folders per value have roots of their own.
        return reduce(DataFrame.unionByName, [reader.parquet(p) for p in paths])

    # -- writing

    def commit(self, batch: int | str, rows: DataFrame) -> bool:
        """Add a batch, already merged within itself, and merge parts where there are enough. False if it was there."""
        now = self.manifest()
        if now.has(batch):
            return False
        part = self._write(rows, 0)
        named = now.named if isinstance(batch, int) else now.named | {batch}
        through = batch if isinstance(batch, int) else now.through
        self._publish(Manifest(now.version + 1, (*now.parts, part), through, named))
        self.compact()
        return True

    def compact(self) -> None:
        """Merge every level that has FANOUT parts, from the lowest on. A stop at any point leaves a whole table."""
        now = self.manifest()
        level = 0
        while level <= max((p.level for p in now.parts), default=-1):
            if sum(p.level == level for p in now.parts) >= FANOUT:
                merged = self._write(self.merge(self.parts(now, level)), level + 1)
                kept = tuple(p for p in now.parts if p.level != level)
                now = Manifest(now.version + 1, (*kept, merged), now.through, now.named)
                self._publish(now)
            level += 1
        self._sweep(now)

    def _write(self, rows: DataFrame, level: int) -> Part:
        part = Part(f"level-{level}-{uuid.uuid4().hex}", level)
        rows = rows.select(*self.schema.names)
        if self.partition_by:
            # Few files per value; values with many rows are split by size.
            rows = rows.hint("rebalance", *self.partition_by)
        writer = rows.write.mode("errorifexists").partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/parts/{part.folder}")
        return part

    def _publish(self, manifest: Manifest) -> None:
        write_text(self.spark, f"{self.path}/manifests/{manifest.version:012d}.json", manifest.text())

    def _sweep(self, now: Manifest) -> None:
        """Delete old manifests, and parts that neither the newest manifest nor the one before names.

        Parts of a commit that stopped are such parts, too.
        """
        names = sorted(n for n in list_folder(self.spark, f"{self.path}/manifests") if n.endswith(".json"))
        kept = {p.folder for p in now.parts}
        for name in names[-2:-1]:
            kept |= {p.folder for p in Manifest.parse(0, read_text(self.spark, f"{self.path}/manifests/{name}")).parts}
        for folder in list_folder(self.spark, f"{self.path}/parts"):
            if folder not in kept:
                delete_folder(self.spark, f"{self.path}/parts/{folder}")
        for name in names[:-2]:
            delete_folder(self.spark, f"{self.path}/manifests/{name}")


def newest_by(keys: list[str], order: str) -> Merge:
    """A merge that keeps, per key, the values with the largest ``order``; rows of one key and order must be equal."""

    def merge(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*keys, order)]
        # Column by column, so that fixed-width values hash instead of sort.
        return rows.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in values], F.max(order).alias(order))

    return merge
