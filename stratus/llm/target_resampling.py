"""Importance resampling towards a target distribution of hashed word n-grams.

A document's weight says how much likelier its n-grams are among the target's than among all documents. The draw adds
Gumbel noise to the weights and keeps the largest: a sample without replacement, each document by its weight.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import pieces, store
from stratus.llm.words import Words, mix, signed, words_of
from stratus.operators.ranking import row_positions

BUCKETS = 10_000
#: Places for frequent words and word pairs in the tables every task is given: 3.2 MB together, whatever the corpus. They
#: affect time only: whatever is not in them is hashed directly, to the same value.
WORD_PLACES = 1 << 16
PAIR_PLACES = 1 << 17
#: The longest word in these tables, in bytes: two 64-bit numbers then name a word exactly.
HEAD_BYTES = 16
#: So many words and pairs a task keeps while it counts them for the head.
COUNTED = 1 << 17
#: Longer texts are taken in stretches of about so many bytes, each with the last two words of the one before.
STRETCH = 1 << 20
#: Up to this length words are hashed byte by byte for all words of a batch together.
SHORT = 64

#: A word is a run of digits, letters and characters beyond ASCII.
CLASSES = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)], np.uint8)
#: The remainders a CRC takes for each byte, from its (reflected) polynomial, and what n more zero bytes do to a state.
BYTE = np.array([0] * 256, np.uint32)
for _c in range(256):
    _r = _c
    for _ in range(8):
        _r = (_r >> 1) ^ (0xEDB88320 if _r & 1 else 0)
    BYTE[_c] = _r
ZEROS = np.zeros((SHORT + 2, 4, 256), np.uint32)
for _k in range(4):
    ZEROS[0, _k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * _k)
for _n in range(1, SHORT + 2):
    ZEROS[_n] = BYTE[ZEROS[_n - 1] & 255] ^ (ZEROS[_n - 1] >> np.uint32(8))
ONES = np.uint32(0xFFFFFFFF)
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def lengthened(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC states with ``n`` zero bytes more, before what these bytes really are is added."""
    out = ZEROS[n, 0, state & 255]
    for k in range(1, 4):
        out ^= ZEROS[n, k, (state >> np.uint32(8 * k)) & 255]
    return out


def go_on(state: np.ndarray, word: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of what ``state`` is of, a space and a word of at most SHORT bytes with CRC ``word``."""
    space = np.full(len(state), crc32(b" "), np.uint32)
    return lengthened(state, length + 1) ^ lengthened(space, length) ^ word


def named(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The first eight and the next eight bytes of each word as numbers; they name words of at most 16 bytes exactly."""
    padded = np.concatenate([words.data, np.zeros(16, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), np.uint64, padded, strides=(1,))
    length = words.end - words.start
    return eight[words.start] & KEEP[np.minimum(length, 8)], eight[words.start + 8] & KEEP[np.clip(length - 8, 0, 8)]


def word_place(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (mix(low ^ mix(high, 1)) & np.uint64(WORD_PLACES - 1)).astype(np.int64)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names a pair of words by their places, never as 0."""
    return (a.astype(np.uint64) << np.uint64(32)) | (b.astype(np.uint64) + np.uint64(1))


def pair_place(key: np.ndarray) -> np.ndarray:
    return (mix(key) & np.uint64(PAIR_PLACES - 1)).astype(np.int64)


@dataclass
class Head:
    """Exact CRC states of frequent words, and states and buckets of frequent pairs, at the places their names give."""

    low: np.ndarray
    high: np.ndarray
    state: np.ndarray
    pair: np.ndarray
    pair_state: np.ndarray
    pair_bucket: np.ndarray

    @classmethod
    def of(cls, words: list[tuple[int, int]], pairs: list[tuple[int, int, int, int]], buckets: int) -> Head:
        """The most frequent first: of those with one place, the first stays."""
        head = cls(
            np.zeros(WORD_PLACES, np.uint64), np.zeros(WORD_PLACES, np.uint64), np.zeros(WORD_PLACES, np.uint32),
            np.zeros(PAIR_PLACES, np.uint64), np.zeros(PAIR_PLACES, np.uint32), np.zeros(PAIR_PLACES, np.uint32),
        )

        def body(low: int, high: int) -> bytes:
            return (low | high << 64).to_bytes(16, "little").rstrip(b"\0")

        names = np.array(words, np.uint64).reshape(-1, 2)
        for (low, high), at in zip(words, word_place(names[:, 0], names[:, 1]), strict=True):
            if not head.low[at]:
                head.low[at], head.high[at], head.state[at] = low, high, crc32(body(low, high))
        names = np.array(pairs, np.uint64).reshape(-1, 4)
        left, right = word_place(names[:, 0], names[:, 1]), word_place(names[:, 2], names[:, 3])
        known = [(head.low[p] == names[:, c]) & (head.high[p] == names[:, c + 1]) for p, c in ((left, 0), (right, 2))]
        keys = pair_key(left, right)
        for k in np.flatnonzero(known[0] & known[1]):
            at = pair_place(keys[k : k + 1])[0]
            if not head.pair[at]:
                state = crc32(b" " + body(*pairs[k][2:]), int(head.state[left[k]]))
                head.pair[at], head.pair_state[at], head.pair_bucket[at] = keys[k], state, state % buckets
        return head

    def words(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The CRC of every word, and its place; -1 for words of the tail, which are hashed here."""
        low, high = named(words)
        length = words.end - words.start
        at = word_place(low, high)
        known = (self.low[at] == low) & (self.high[at] == high) & (length <= HEAD_BYTES)
        state = np.where(known, self.state[at], np.uint32(0))
        tail = np.flatnonzero(~known)
        state[tail] = direct(words, tail)
        return state, np.where(known, at, -1)

    def pairs(self, state: np.ndarray, at: np.ndarray, length: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The CRC and bucket of every word with the next one; pairs beyond the head go on from the first word's state."""
        key = pair_key(at[:-1], at[1:])
        place = pair_place(key)
        known = (at[:-1] >= 0) & (at[1:] >= 0) & (self.pair[place] == key)
        out, bucket = self.pair_state[place], self.pair_bucket[place]
        tail = np.flatnonzero(~known)
        out[tail] = go_on(state[tail], state[tail + 1], length[tail + 1])
        bucket[tail] = out[tail] % np.uint32(buckets)
        return out, bucket


def direct(words: Words, which: np.ndarray) -> np.ndarray:
    """CRCs from the bytes of words."""
    start, length = words.start[which], (words.end - words.start)[which]
    state = np.full(len(which), ONES, np.uint32)
    short = np.flatnonzero(length <= SHORT)
    order = short[np.argsort(-length[short], kind="stable")]
    sizes = -length[order]
    for k in range(int(length[order[0]]) if len(order) else 0):
        now = order[: np.searchsorted(sizes, -k, side="left")]
        state[now] = BYTE[(state[now] ^ words.data[start[now] + k]) & 255] ^ (state[now] >> np.uint32(8))
    state ^= ONES
    for i in np.flatnonzero(length > SHORT):
        state[i] = crc32(words.data[start[i] : start[i] + length[i]])
    return state


def features(words: Words, repeated: np.ndarray, head: Head, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every run of one to three words of a row.

    ``repeated`` says how many of a row's first words were there before: runs within them are left out. A CRC goes on
    from the state its beginning left, so a run's CRC is that of its first words and of its last word.
    """
    n = len(words.row)
    state, at = head.words(words)
    length = np.minimum(words.end - words.start, SHORT)
    # No run begins or ends within words that were there before, beyond its own first ones.
    counts = words.counts()
    old = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts) < repeated[words.row]
    ones = np.flatnonzero(~old)
    two, two_bucket = head.pairs(state, at, length, buckets) if n > 1 else (state[:0], state[:0])
    pair = np.flatnonzero((words.row[1:] == words.row[:-1]) & ~old[1:]) if n > 1 else np.empty(0, np.int64)
    triple = np.flatnonzero((words.row[2:] == words.row[:-2]) & ~old[2:]) if n > 2 else np.empty(0, np.int64)
    three = go_on(two[triple], state[triple + 2], length[triple + 2])
    long = np.flatnonzero(words.end - words.start > SHORT)
    if len(long):
        # The tables end at SHORT: runs with a longer word, but for the first, are hashed from their bytes.
        def text(k: int) -> bytes:
            return words.data[words.start[k] : words.end[k]].tobytes()

        for k in long[long > 0]:
            two[k - 1] = crc32(b" " + text(k), int(state[k - 1]))
            two_bucket[k - 1] = two[k - 1] % np.uint32(buckets)
        over = np.isin(triple + 2, long) | np.isin(triple + 1, long)
        for i in np.flatnonzero(over):
            three[i] = crc32(b" " + text(triple[i] + 2), int(two[triple[i]]))
    size = np.uint32(buckets)
    rows = np.concatenate([words.row[ones], words.row[pair], words.row[triple]])
    return rows, np.concatenate([state[ones] % size, two_bucket[pair], three % size]).astype(np.int64)


def stretches(texts: pa.Array, size: int = STRETCH) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """The words of some texts: words, the text each row of them is of, and how many of a row's words were there before.

    Texts longer than ``size`` are cut between words; each stretch begins with the last two words of the one before.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    size_of = pc.binary_length(texts.cast(pa.large_binary())).to_numpy(zero_copy_only=False)
    short = np.flatnonzero(size_of <= size)
    yield _split(texts.take(pa.array(short))), short, np.zeros(len(short), np.int64)
    for i in np.flatnonzero(size_of > size).tolist():
        data = np.frombuffer(texts[i].as_buffer(), np.uint8)
        begin = end = repeated = 0
        while end < len(data):
            end = min(len(data), end + size)
            while end < len(data) and CLASSES[data[end]]:
                # On to where the word ends, a block at a time.
                gap = np.flatnonzero(CLASSES[data[end : end + size]] == 0)
                end = end + int(gap[0]) if len(gap) else min(len(data), end + size)
            words = _split(pa.array([data[begin:end].tobytes()], pa.large_binary()))
            yield words, np.array([i]), np.array([repeated])
            repeated = min(2, len(words.row))
            begin += int(words.start[-repeated]) if repeated else end - begin


def _split(texts: pa.Array) -> Words:
    return words_of(texts, CLASSES, lower=True)


def _counted(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal names together; they are compared by a 64-bit mix, which is enough for a table that only saves time."""
    mixed = np.zeros(len(names), np.uint64)
    for k in range(4):
        mixed = mix(mixed ^ names[:, k], k)
    order = np.argsort(mixed)
    new = np.flatnonzero(np.concatenate([[True], mixed[order][1:] != mixed[order][:-1]])[: len(order)])
    return names[order[new]], np.add.reduceat(n[order], new) if len(new) else n[:0]


class Frequent:
    """Counts of names (rows of 64-bit numbers), of which the most frequent are kept when there are too many."""

    def __init__(self, most: int = COUNTED):
        self.most, self.waiting, self.size = most, [(np.empty((0, 4), np.uint64), np.empty(0, np.int64))], 0

    def add(self, names: np.ndarray) -> None:
        """Names of one batch; what is there only once is not frequent."""
        names, n = _counted(names, np.ones(len(names), np.int64))
        self.waiting.append((names[n > 1], n[n > 1]))
        self.size += len(self.waiting[-1][1])
        if self.size > 8 * self.most:
            self.keep(self.most)

    def keep(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        names, n = _counted(*(np.concatenate(x) for x in zip(*self.waiting, strict=True)))
        if len(n) > most:
            best = np.argpartition(-n, most)[:most]
            names, n = names[best], n[best]
        self.waiting, self.size = [(names, n)], len(n)
        return names, n

    def batch(self, most: int) -> pa.RecordBatch:
        names, n = self.keep(most)
        columns = [pa.array(signed(np.ascontiguousarray(names[:, k]))) for k in range(4)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n)], ["a", "b", "c", "d", "n"])


def frequent_head(docs: DataFrame, buckets: int = BUCKETS, text: str = "text") -> Head:
    """The most frequent words and pairs of all texts, at most as many as the tables have places.

    Each task counts what it reads and gives on its most frequent ones only, so neither a task nor the driver holds the
    whole vocabulary. What a task leaves out may be missing in the head, which costs time and changes no result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, twos = Frequent(), Frequent()
        for batch in pieces(batches, "text"):
            for words, _, _ in stretches(batch.column("text")):
                names = np.stack([*named(words), np.zeros(len(words.row), np.uint64), np.zeros(len(words.row), np.uint64)], 1)
                fit = words.end - words.start <= HEAD_BYTES
                ones.add(names[fit])
                pair = np.flatnonzero(fit[1:] & fit[:-1] & (words.row[1:] == words.row[:-1]))
                twos.add(np.concatenate([names[pair, :2], names[pair + 1, :2]], 1))
        yield ones.batch(WORD_PLACES)
        yield twos.batch(PAIR_PLACES)

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "a long, b long, c long, d long, n long")
    totals = store(counted.groupBy("a", "b", "c", "d").agg(F.sum("n").alias("n")), "frequent-words")

    def best(rows: DataFrame, most: int) -> list[tuple[int, ...]]:
        # By place in the order: a limit would have every partition send its own best to the driver.
        placed = row_positions(rows, F.desc("n"), "a", "b", "c", "d", name="place").filter(F.col("place") <= most)
        found = sorted(placed.select("place", "a", "b", "c", "d").collect())
        return [tuple(x % (1 << 64) for x in r[1:]) for r in found]

    frequent = totals.filter("n > 1")
    words = [w[:2] for w in best(frequent.filter("c = 0"), WORD_PLACES)]
    return Head.of(words, best(frequent.filter("c <> 0"), PAIR_PLACES), buckets)


def bucket_totals(rows: DataFrame, head: Callable[[], Head], buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket; each task sums its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches, "text"):
            for words, _, repeated in stretches(batch.column("text")):
                total += np.bincount(features(words, repeated, head(), buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    counted = rows.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row for each bucket
        total[r["bucket"]] = r["n"]
    return total


def gains(raw: np.ndarray, target: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the logarithm of target to raw share, each bucket with one feature added."""
    s_all, t_all = float(raw.sum()), float(target.sum())
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in pairs], np.int64
    )


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row of ``docs``.

    Texts are read three times and never shuffled: for the head, the totals and the weights. Between these passes only
    the head and one number for each bucket are held by the driver and sent out, whatever the number of documents.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(frequent_head(docs, buckets, text))  # as large as WORD_PLACES and PAIR_PLACES say

    def head() -> Head:
        return sent.value

    gain = gains(bucket_totals(docs, head, buckets, text), bucket_totals(target, head, buckets, text), buckets)

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            n_words, n_features, weight = np.zeros((3, batch.num_rows), np.int64)
            for words, text_of, repeated in stretches(batch.column("_text")):
                n_words[text_of] += words.counts() - repeated
                row, bucket = features(words, repeated, head(), buckets)
                n_features[text_of] += np.bincount(row, minlength=words.rows)
                # Each addend is a whole number far below 2**53, and so is each sum of a stretch: doubles are exact here.
                weight[text_of] += np.bincount(row, weights=gain[bucket], minlength=words.rows).astype(np.int64)
            counted = [pa.array(x) for x in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counted], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(weights, f"doc_id {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: the weight and the draw of every document.

    Of the documents with at least ``min_words`` words, ``percent`` of a hundred (rounded down) are drawn: those with
    the largest score, which is weight plus Gumbel noise from a hash of seed and id, ties to the smaller id. They are
    numbered from 1; ``rank`` is null for all others. A null text has no words, no features and weight 0, as an empty one; a null
    id is hashed as an empty string and comes last among ties; rows that repeat an id are drawn on their own, in any
    order where their scores are the same. Without documents nothing is returned; without a target all buckets count
    as empty there. Other columns are left behind, so their names do not matter.
    """
    scored = weigh(docs, target, buckets, id, text)
    key = F.sha2(F.concat_ws("", F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = store(
        scored.withColumn("score", F.col("weight") + noise).withColumn("_fit", F.col("n_words") >= min_words), "weighted"
    )
    drawn = scored.agg(F.count_if("_fit")).first()[0] * percent // 100
    placed = row_positions(scored, F.desc("_fit"), F.desc("score"), F.asc_nulls_last("doc_id"), name="rank")
    rank = F.when(F.col("_fit") & (F.col("rank") <= drawn), F.col("rank"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
