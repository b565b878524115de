"""Near copies among vectors, found by the order in which reference points lie around them.

Vectors that point the same way have the same nearest reference points (pivots). Each vector is described by its NEAREST
pivots, nearest first. Inverted lists hold the vectors that have a pair of pivots in common; within a list the pivots
two vectors share are counted, and vectors that share enough are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.components import connected_components
from stratus.llm.tables import store

#: Pivots, how many of them describe a vector, and how many two vectors must share to be compared. The share of linked
#: pairs (cosine 0.98) that this finds is measured in the tests.
PIVOTS = 1024
NEAREST = 8
SHARED = 4
#: The bounded sample in which pivots are chosen; all vectors are indexed by them.
FIT_ROWS = 8192
#: The largest cosine of two pivots that are taken from the sample.
APART = 0.5
#: Rows of a list that are compared as one block; longer lists are cut into blocks, and each pair of blocks is a unit of work.
BLOCK = 1024
#: Two sets with SHARED of NEAREST pivots in common have two in common among the so many rarest of each.
RAREST = NEAREST - SHARED + 2


@dataclass
class Pivots:
    """Unit vectors by dimension, the rarest first: those that are near to few vectors of the sample."""

    by_size: dict[int, np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, count: int = PIVOTS) -> Pivots:
        """Points of the sample that lie far from each other, one after another, then seeded random ones.

        Were the members of a crowd pivots themselves, chance would order them, for each of its vectors in another way.
        """
        unit = np.unique(_units(sample).astype(np.float32), axis=0)
        chosen = np.zeros((0, sample.shape[1]), np.float32)
        if len(unit):
            picked, nearest = [0], unit @ unit[0]
            while len(picked) < count and nearest.min() < APART:
                picked.append(int(nearest.argmin()))
                nearest = np.maximum(nearest, unit @ unit[picked[-1]])
            chosen = unit[picked]
        chosen = np.concatenate([chosen, random_units(count - len(chosen), sample.shape[1])])
        pivots = cls({sample.shape[1]: chosen})
        if len(unit):
            used = np.bincount(pivots.nearest(unit).ravel(), minlength=count)
            pivots.by_size[sample.shape[1]] = chosen[np.argsort(used, kind="stable")]
        return pivots

    def nearest(self, unit: np.ndarray) -> np.ndarray:
        """Numbers of the nearest pivots of each vector, nearest first, ties to the smaller number."""
        size = unit.shape[1]
        if size not in self.by_size:
            self.by_size[size] = random_units(PIVOTS, size)
        near = -(unit.astype(np.float32) @ self.by_size[size].T)
        return np.argsort(near, axis=1, kind="stable")[:, :NEAREST] if len(near) < 8 else _smallest(near)


def _smallest(near: np.ndarray) -> np.ndarray:
    some = np.sort(np.argpartition(near, NEAREST, axis=1)[:, :NEAREST], axis=1)
    order = np.argsort(np.take_along_axis(near, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


def random_units(count: int, size: int) -> np.ndarray:
    return _units(np.random.default_rng(size).normal(size=(count, size))).astype(np.float32)


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision; the largest component goes first, so that no square is lost."""
    if not vectors.size:
        return vectors.astype(np.float64)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each dimension that is in the column."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = column.offsets.to_numpy()[:-1]
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, values[starts[rows][:, None] + np.arange(size)]


def fit_pivots(vectors: DataFrame, vector: str) -> Pivots:
    """Pivots from the FIT_ROWS vectors with the smallest hashes, of their most common dimension.

    Only vectors below a hash that leaves about twice as many are sorted, so that all partitions together send no more.
    """
    share = min(1.0, 2 * FIT_ROWS / max(1, vectors.count()))
    place = F.xxhash64(vector)
    few = vectors.select(vector).filter(place <= int(-(2**63) + share * (2**64 - 1025)))
    rows = few.orderBy(place, vector).limit(FIT_ROWS).toArrow()  # bounded by FIT_ROWS
    found = max(_by_size(rows.column(0).combine_chunks()), key=lambda x: len(x[0]), default=None) if rows.num_rows else None
    return Pivots({}) if found is None else Pivots.fit(found[1])


def described(vectors: DataFrame, pivots: Pivots, vector: str) -> DataFrame:
    """Adds ``pivots``: the nearest pivots of each vector, nearest first."""
    known = vectors.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros((batch.num_rows, NEAREST), np.int16)
            for rows, found in _by_size(batch.column(vector)):
                near[rows] = known.value.nearest(_units(found))
            flat = pa.array(near.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, NEAREST, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "pivots"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(describe, f"{kinds}, pivots array<smallint>")


def inverted_lists(index: DataFrame) -> DataFrame:
    """``node, list``: each vector in the lists of all pairs of its RAREST rarest pivots, of its label and dimension.

    The rarest are those with the smallest numbers. Two vectors that share SHARED pivots meet in at least one list: of
    their shared pivots at most NEAREST - RAREST are beyond the rarest of either.
    """
    few = F.slice(F.array_sort("pivots"), 1, RAREST)
    pairs = F.array(*[
        F.get(few, F.lit(a)).cast("int") * PIVOTS + F.get(few, F.lit(b)) for a, b in combinations(range(RAREST), 2)
    ])
    return index.select("node", "class", F.explode(pairs).alias("list"))


def _units_of_work(index: DataFrame) -> DataFrame:
    """Rows of ``index`` once for each unit of work they belong to: ``class, list, left, right`` and their ``block``.

    A list of many rows is cut into blocks by a hash; each block meets itself and each other one. Lists are counted
    first, and lists of one vector go before any vector is moved.
    """
    entries = inverted_lists(index)
    crowded = entries.groupBy("class", "list").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = entries.join(crowded, ["class", "list"]).select(
        "node", "class", "list", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "list"), blocks).cast("int").alias("block")
    )
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = met.select(
        "node", "class", "list", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    return unit.join(index.select("node", "copies", "vector", "pivots"), "node")


@dataclass
class _Side:
    node: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    pivots: np.ndarray

    def take(self, rows: np.ndarray) -> _Side:
        return _Side(self.node[rows], self.copies[rows], self.unit[rows], self.pivots[rows])


def links_between(a: _Side, b: _Side, number: int, least: float) -> np.ndarray:
    """Which vectors of ``a`` and ``b`` link by this list: they share enough pivots, it is their first list, cosine is enough."""
    first, second = divmod(number, PIVOTS)
    few = np.sort(b.pivots, axis=1)[:, :RAREST]
    has = np.zeros((len(a.node), PIVOTS), np.uint8)
    np.put_along_axis(has, a.pivots, 1, axis=1)
    shared = has[:, b.pivots[:, 0]]
    for k in range(1, NEAREST):
        shared = shared + has[:, b.pivots[:, k]]
    has[:] = 0
    np.put_along_axis(has, np.sort(a.pivots, axis=1)[:, :RAREST], 1, axis=1)
    # Of the rare pivots both have, this list's are the two smallest: pairs that meet in several lists count in one.
    has[:, first] = has[:, second] = has[:, second + 1 :] = 0
    before = has[:, few[:, 0]]
    for k in range(1, RAREST):
        before = before + has[:, few[:, k]]
    near = (shared >= SHARED) & (before == 0)
    return near & (a.unit @ b.unit.T >= least) if near.any() else near


def _labelled(links: np.ndarray) -> np.ndarray:
    """The smallest row each row reaches by links of a symmetric table."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verified(units: DataFrame, least: float) -> DataFrame:
    """``node, links, other``: how many vectors (with copies) a node links with in a unit, and one node to be joined to.

    No pair leaves a unit: a node gets one row, and the joins of a unit are a spanning forest of its links.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            cuts = _cuts(kept)
            # The last unit may go on in the next batch.
            for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
                yield from _compared(kept.slice(a, b - a), least)
            kept = kept.slice(cuts[-2])
        if kept is not None and kept.num_rows:
            yield from _compared(kept, least)

    keys = ["class", "list", "left", "right"]
    dealt = units.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "block", "node", "copies", "vector", "pivots").mapInArrow(compare, "node long, links long, other long")


def _cuts(table: pa.Table) -> list[int]:
    """Where units begin, and the end."""
    n = table.num_rows
    new = np.zeros(max(0, n - 1), bool)
    for name in ("class", "list", "left", "right"):
        values = table.column(name).to_numpy()
        new |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist(), n]


def _compared(table: pa.Table, least: float) -> Iterator[pa.RecordBatch]:
    if table.num_rows < 2:
        return
    block, left, right = (table.column(c).to_numpy() for c in ("block", "left", "right"))
    vectors = table.column("vector").combine_chunks()
    size = len(vectors[0])
    unit = _units(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))
    pivots = table.column("pivots").combine_chunks().flatten().to_numpy().reshape(-1, NEAREST).astype(np.int64)
    all_ = _Side(table.column("node").to_numpy(), table.column("copies").to_numpy(), unit, pivots)
    number, n = table.column("list")[0].as_py(), len(all_.node)
    if left[0] == right[0]:
        links = links_between(all_, all_, number, least)
        links = links & links.T
        np.fill_diagonal(links, False)
    else:
        one, two = np.flatnonzero(block == left[0]), np.flatnonzero(block == right[0])
        links = np.zeros((n, n), bool)
        links[np.ix_(one, two)] = links_between(all_.take(one), all_.take(two), number, least)
        links |= links.T
    degree = links @ all_.copies
    linked = np.flatnonzero(degree)
    if len(linked):
        label = _labelled(links)
        columns = (all_.node[linked], degree[linked], all_.node[label[linked]])
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["node", "links", "other"])


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Rows that can link at all, equal vectors together: ``label, vector, copies, least_id``."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.col("label").isNotNull() & whole & F.exists("vector", lambda x: x != 0)
    return rows.filter(fit).groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))


def near_vectors(
    rows: DataFrame, cosine: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, label, n_links, component_id, kept`` of every row: near copies of one label, by an index of pivots.

    ``n_links`` counts the other rows found whose vector has at least that cosine, in double precision; no link below it
    is made. ``component_id`` is the smallest id reachable by links, its own included, and ``kept`` says whether the row
    has it. Rows link with nothing if label or vector is null, or the vector is empty, zero or has a component that is
    null or not finite; vectors of different lengths never link. Equal vectors (0 and -0 are equal) are one node that
    counts as often as it has rows, so groups of copies are never expanded. Rows may repeat ids: each is a row of its
    own, all with the smallest id of a component are kept. A null id is larger than any other; if a component has only
    null ids, so is its ``component_id``, and its rows are kept. Other columns are left behind, so their names do not matter.

    All vectors are indexed; what is fitted on a bounded sample is the pivots alone. A list longer than BLOCK is
    compared in pairs of blocks, each a unit of work of its own; the number of comparisons in a crowd of n vectors that
    are all near one another still grows with its square, as the number of links does, but what leaves a unit does not.
    """
    spark: SparkSession = rows.sparkSession
    rows = rows.select(F.col(id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    distinct = store(distinct_vectors(rows).withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    pivots = fit_pivots(distinct, "vector")
    classed = distinct.withColumn("class", F.xxhash64("label", F.size("vector")))
    index = store(described(classed.select("node", "class", "copies", "vector"), pivots, "vector"), "pivot-index")
    found = store(_verified(_units_of_work(index), cosine), "vector-links")
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.join(degrees, "node", "left").join(joined, "node", "left").select(
        "label", "vector", "copies", "least_id", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "node").alias("component"),
    )
    nodes = store(nodes, "vector-nodes")
    least = nodes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = nodes.join(least, "component").select(
        "label", "vector", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("fit")
    )
    placed = rows.join(named, ["label", "vector"], "left")
    own = F.when(F.col("fit"), F.col("component_id")).otherwise(F.col("vec_id"))
    return placed.select(
        "vec_id", "label", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"),
    )
