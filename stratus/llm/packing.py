"""Packing of documents into token sequences of one length by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.encoding import byte_bpe
from stratus.llm.tables import pieces, store

LENGTH = 2048
SEPARATOR = 0
#: Pieces that one task packs. The number of groups grows with the input, a group does not.
GROUP = 20_000
#: Sequences with more free places than this after the first round are opened and packed again, across groups.
SPARE = 16

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: one if they fit, else full ones after a first remainder."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def token_pieces(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text",
    length: int = LENGTH, separator: int = SEPARATOR,
) -> DataFrame:
    """One row per piece of every document: ``doc_id, piece, start, length, ids_crc32``.

    A document is the ids of its whole text and ``separator``; a null text is empty. ``tokenizer`` is a file of the
    tokenizers library that every executor has, ``ranks`` the same vocabulary as ranks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer, ranks)
        for batch in pieces(batches, "text"):
            rows = []
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(t or ""), np.uint32(separator)).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), length)):
                    rows.append((i, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            names, types = zip(*(c.split() for c in PIECES.split(", ")), strict=True)
            kinds = [pa.int32() if t == "int" else pa.int64() for t in types]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, placed in the given order.

    ``open[g]`` is the number of started bins with ``g`` places left. An item goes where the sum of the squares of these
    counts becomes smallest: into a bin whose gap is common, leaving a gap that is rare. Equal sums: the smallest gap.
    """
    open_, stacks = np.zeros(length + 1, np.int64), [[] for _ in range(length + 1)]
    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    far = np.int64(1) << 40
    for i, n in enumerate(lengths.tolist()):
        before, after = open_[n:], open_[: length + 1 - n]
        change = 2 * (after - before) + 2
        change[0] -= 2 * after[0] + 1  # a full bin has no gap to count
        change[before == 0] = far
        change[-1] = 2 * after[-1] + 1 if n < length else 0  # a new bin
        gap = n + int(np.argmin(change))
        if gap == length:
            b, used = used, used + 1
        else:
            b = stacks[gap].pop()
            open_[gap] -= 1
        bins[i], offsets[i] = b, length - gap
        if gap > n:
            stacks[gap - n].append(b)
            open_[gap - n] += 1
    return bins, offsets


def _packed(rows: DataFrame, length: int, group: int, round_: int) -> DataFrame:
    """Adds ``bin``, ``offset`` and ``free`` (places left in the bin) within groups of about ``group`` rows."""
    groups = max(1, -(-rows.count() // group))

    def pack(table: pa.Table) -> pa.Table:
        # Longest first; equal lengths in the order of their row numbers, so a repeated task gives the same.
        order = np.lexsort((table.column("row").to_numpy(), -table.column("length").to_numpy()))
        table = table.take(pa.array(order))
        n = table.column("length").to_numpy()
        bins, offsets = sum_of_squares(n, length)
        free = length - np.bincount(bins, weights=n).astype(np.int64)
        # Ids are unique over groups: the bin's number within the group, then the group's.
        ids = bins * groups + table.column("group")[0].as_py()
        return table.append_column("bin", pa.array(ids)).append_column("offset", pa.array(offsets)).append_column(
            "free", pa.array(free[bins])
        )

    placed = rows.withColumn("group", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(groups)))
    schema = f"{PIECES}, row long, group long, bin long, offset long, free long"
    return placed.groupBy("group").applyInArrow(pack, schema)


def pack_pieces(rows: DataFrame, length: int = LENGTH, group: int = GROUP, spare: int = SPARE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of ``token_pieces``.

    Pieces of full length are sequences by themselves. The others are dealt at random into groups of bounded size, each
    packed by ``sum_of_squares``; what is left in sequences with more than ``spare`` free places is packed once more,
    so the number of poorly filled sequences does not grow with the number of groups.
    """
    numbered = store(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = numbered.filter(F.col("length") >= length).withColumn("offset", F.lit(0).cast("long"))
    first = store(_packed(numbered.filter(F.col("length") < length), length, group, 0), "packed")
    again = first.filter(F.col("free") > spare).select(*numbered.columns)
    second = store(_packed(again, length, group, 1), "packed")
    done = [(full, F.col("row")), (first.filter(F.col("free") <= spare), F.col("bin")), (second, F.col("bin"))]
    # Three ranges of ids that cannot meet.
    parts = [
        rows.select("doc_id", "piece", "start", "length", "ids_crc32", (number * 3 + k).alias("sequence_id"), "offset")
        for k, (rows, number) in enumerate(done)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def pack_documents(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text",
    length: int = LENGTH, separator: int = SEPARATOR, group: int = GROUP,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Within a sequence the offsets are gapless from 0. A null or empty text is its separator alone; rows that repeat an
    id are documents of their own; a null id stays null. Other columns of ``docs`` are not looked at. No rows in, no
    rows out.
    """
    return pack_pieces(token_pieces(docs, tokenizer, ranks, doc_id, text, length, separator), length, group)
