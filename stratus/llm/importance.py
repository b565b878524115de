"""Importance resampling towards labelled good text, with hashed n-gram models of target and raw text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import pieces, store
from stratus.llm.words import BY_KIND, mix, words_of

#: Hashed n-gram counts per model: a fixed size whatever the corpus. Words have buckets of their own, before the pairs'.
WORD_BITS, PAIR_BITS = 18, 18
WORDS = 1 << WORD_BITS
BUCKETS = WORDS + (1 << PAIR_BITS)
#: Most labelled rows that the target model and the calibration read, by hash of their id.
MAX_LABELLED = 20_000
#: Counts added to both models, in tokens of the target, so that a rare n-gram says little of either.
SMOOTHING = 5.0
#: A word speaks against a text by what its log ratio lies below minus this, and that part counts so many times more.
TOLERANCE = 1.0
ADVERSE = 6.0
#: The weights are tempered so that the median held-out row lies so far above the border of the held-out rows, in nats.
SPREAD = 6.0
SEED = 20240229


def bucket_places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Text index and bucket of every word and every pair of neighbouring words; letters and punctuation are apart."""
    w = words_of(texts, BY_KIND, lower=True)
    first, pairs = w.windows(2)
    rows = np.concatenate([w.row, w.row[first]])
    of_words = (mix(w.hash, 1) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    of_pairs = (mix(pairs, 2) >> np.uint64(64 - PAIR_BITS)).astype(np.int64) + WORDS
    return rows, np.concatenate([of_words, of_pairs]), w.rows


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    """Standard Gumbel noise fixed by id and seed, so a repeated run or task draws the same."""
    u = (mix(mix(ids.astype(np.int64).view(np.uint64), seed), 7) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2.0**53))


def labelled_ids(labels: DataFrame, good: str, doc_id: str = "doc_id", limit: int = MAX_LABELLED) -> np.ndarray:
    """Ids of the rows for which ``good`` holds, at most ``limit`` of them, chosen by hash."""
    rows = labels.filter(good).select(F.col(doc_id).cast("long").alias("i")).filter("i IS NOT NULL").distinct()
    chosen = rows.orderBy(F.xxhash64("i"), "i").limit(limit).collect()
    return np.sort(np.array([r["i"] for r in chosen], np.int64))


def fit_models(docs: DataFrame, target: np.ndarray, doc_id: str, text: str) -> np.ndarray:
    """Log ratio of the two models per bucket, words and pairs apart. The raw model counts every document, whole.

    Raw counts are scaled to the size of the target before both are smoothed by the same count: an n-gram that is rare
    everywhere has a ratio near 1, and one that is common but not in the target a small one.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in pieces(batches, "text"):
            rows, buckets, n = bucket_places(batch.column("text"))
            raw += np.bincount(buckets, minlength=BUCKETS)
            ids = batch.column("id").fill_null(-1).to_numpy(zero_copy_only=False)
            known = np.isin(ids, target) & batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            good += np.bincount(buckets[known[rows]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(good[used])], ["bucket", "raw", "good"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(count, "bucket long, raw long, good long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good")
    ).toArrow()  # BUCKETS rows at most
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"].to_numpy()], good[counts["bucket"].to_numpy()] = counts["raw"].to_numpy(), counts["good"].to_numpy()
    for part in (slice(0, WORDS), slice(WORDS, BUCKETS)):
        raw[part] *= good[part].sum() / max(raw[part].sum(), 1)
    return np.log((good + SMOOTHING) / (raw + SMOOTHING))


def log_ratios(
    docs: DataFrame, ratio: np.ndarray, held_out: np.ndarray, doc_id: str, text: str, seed: int = SEED, mark: Column | None = None
) -> DataFrame:
    """Per input row ``doc_id, n_ngrams, per_ngram, against, log_ratio, noise, held_out`` and, if one is given, ``mark``.

    ``per_ngram`` is the mean over the text's n-grams, so that long texts weigh no more than short ones; ``against`` is
    what single words say against the text, over the number of words and at most 0. ``log_ratio`` is the first with
    the second counted ``ADVERSE`` times more: the good rest of a long text does not outweigh it.
    """
    adverse = np.minimum(ratio[:WORDS] + TOLERANCE, 0)
    marks = [] if mark is None else ["mark"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows, buckets, n = bucket_places(batch.column("text"))
            total, n_ngrams = np.bincount(rows, weights=ratio[buckets], minlength=n), np.bincount(rows, minlength=n)
            word = buckets < WORDS
            against = np.bincount(rows[word], weights=adverse[buckets[word]], minlength=n)
            n_words = np.bincount(rows[word], minlength=n)
            per_ngram, against = total / np.maximum(n_ngrams, 1), against / np.maximum(n_words, 1)
            ids = batch.column("id")
            plain = ids.fill_null(-1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_ngrams), pa.array(per_ngram), pa.array(against), pa.array(per_ngram + ADVERSE * against),
                 pa.array(gumbel(plain, seed)), pa.array(np.isin(plain, held_out) & ids.is_valid().to_numpy(zero_copy_only=False)),
                 *[batch.column(m) for m in marks]],
                ["doc_id", "n_ngrams", "per_ngram", "against", "log_ratio", "noise", "held_out", *marks],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), *[mark.cast("string").alias(m) for m in marks])
    return rows.mapInArrow(
        score,
        "doc_id long, n_ngrams long, per_ngram double, against double, log_ratio double, noise double, held_out boolean"
        + "".join(f", {m} string" for m in marks),
    )


def keys(ratios: DataFrame, temper: float) -> DataFrame:
    """Adds ``log_weight``, the tempered ratio, ``key``, with its Gumbel noise, and ``place``, a whole number that sorts as the key does."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = batch.column("log_ratio").to_numpy(zero_copy_only=False) * temper
            key = weight + batch.column("noise").to_numpy(zero_copy_only=False)
            bits = key.view(np.int64)
            placed = np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)
            columns = {"log_weight": pa.array(weight), "key": pa.array(key), "place": pa.array(placed)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])

    fields = ", ".join(f"{name} {kind}" for name, kind in ratios.dtypes)
    return ratios.mapInArrow(place, f"{fields}, log_weight double, key double, place long")


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """Adds ``kept`` for the ``k`` rows with the largest ``place``; equal places: the smaller ids.

    The border is found by four counts of ranges of ``place``: at most 65,536 rows each reach the driver, whatever
    ``k`` is. Rows that repeat the id at the border are kept together.
    """
    if k <= 0:
        return scores.withColumn("kept", F.lit(False))
    border, left = None, k
    for bits in (48, 32, 16, 0):
        part = scores if border is None else scores.filter(F.shiftright("place", bits + 16) == border)
        counts = dict(part.groupBy(F.shiftright("place", bits).alias("p")).count().collect())
        for value in sorted(counts, reverse=True):
            if counts[value] >= left:
                border = value
                break
            left -= counts[value]
        else:
            return scores.withColumn("kept", F.lit(True))
    ties = scores.filter(F.col("place") == border)
    last = ties.select("doc_id").orderBy("doc_id").limit(left).agg(F.max("doc_id")).first()[0]
    at_border = (F.col("place") == border) & (F.col("doc_id").isNull() if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(True)))
    return scores.withColumn("kept", (F.col("place") > border) | at_border)


def resample(
    docs: DataFrame, labels: DataFrame, good: str = "quality = 1 AND toxic = 0", k: int | None = None,
    recall: float = 0.998, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, mark: Column | None = None,
) -> DataFrame:
    """Per input row ``doc_id, n_ngrams, log_weight, key, kept``: a sample of ``docs`` that resembles the target.

    The target is the labelled rows for which ``good`` holds, at most ``MAX_LABELLED`` of them; a quarter is held out of
    the target model. The weight of a document is the probability of its n-grams in the target model over that in the
    model of all documents, per n-gram (``log_ratios``) and tempered. Kept are the rows with the ``k`` largest weights
    after Gumbel noise: a draw without replacement in proportion to the weights. Unless the caller gives ``k``, it is the
    number of rows that reach two borders, of the ratio per n-gram and of what single words say against the text, each
    placed so that it turns away half of the share ``1 - recall`` of the held-out rows. The tempering puts the median of
    the held-out rows' ratios ``SPREAD`` nats above what the share ``recall`` of them reaches: rows well above that are
    drawn for nearly certain, rows well below nearly never, and near it chance decides. A null or empty
    text has weight 1 (log 0), like a null id it draws noise as any other; rows that repeat an id and text get the same
    key. Without held-out rows nothing tells how many rows resemble the target and all stay. ``mark``, a text of each
    row, is returned with its verdict: by it and the id a caller finds the row again where ids are null or repeated.
    """
    target = labelled_ids(labels, good, doc_id)
    held = (mix(target.view(np.uint64), seed) % np.uint64(4)) == 0
    ratio = fit_models(docs, target[~held], doc_id, text) if len(target) else np.zeros(BUCKETS)
    ratios = store(log_ratios(docs, ratio, target[held], doc_id, text, seed, mark), "ratios")
    measures, share = ("per_ngram", "against"), (1 - recall) / 2
    quantiles = [F.percentile_approx(m, share, 100_000) for m in measures] + [F.percentile_approx("log_ratio", [1 - recall, 0.5], 100_000)]
    *borders, spread = ratios.filter("held_out").agg(*quantiles).first()
    # Held-out rows that all weigh the same leave the tempering open; it only has to be finite then.
    temper = SPREAD / max(spread[1] - spread[0], 1e-3) if spread else 1.0
    scores = store(keys(ratios, temper), "weights")
    if k is None and spread:
        k = scores.filter((F.col(measures[0]) >= borders[0]) & (F.col(measures[1]) >= borders[1])).count()
    drawn = scores.withColumn("kept", F.lit(True)) if k is None else top_k(scores, k)
    return drawn.drop(*measures, "log_ratio", "noise", "held_out", "place")
