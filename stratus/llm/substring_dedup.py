"""Removal of long word sequences that occur more than once, found level by level."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import pieces, store
from stratus.llm.words import signed, words_of

WINDOW = 35
#: The shortest level is at least so long.
SHORTEST = 8


def levels(window: int) -> list[int]:
    """Lengths of the levels, each at most twice the one before, the last ``window``."""
    found = [window]
    while -(-found[0] // 2) >= SHORTEST:
        found.insert(0, -(-found[0] // 2))
    return found


def sliding_argmin(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the first smallest value among the ``span`` values from each place on."""
    n = len(values) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, reach = np.arange(len(values)), 1
    while reach < span:
        step = min(reach, span - reach)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        reach += step
    return best[:n]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, text, and a mark that tells rows with one id apart where ids repeat or are null.

    Rows with the same id and text share all findings; their windows still count twice.
    """
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = docs.select(F.col(doc_id).alias("i")).groupBy("i").count().filter("i IS NULL OR count > 1").isEmpty()
    mark = F.lit(0) if plain else F.hash("text")
    return body.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), mark.alias("mark"), "text")


def _entries(rows: DataFrame, window: int, level: int, before: int | None) -> DataFrame:
    """Hash and place of what stands for the windows at a level, for windows that survived the level ``before``.

    At the last level that is every window itself, with a longer hash. At a shorter one it is, of the sequences of that
    length inside a window, the one with the smallest hash: equal windows choose the same one, and windows beside each
    other mostly share it, so few need to be counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            w = words_of(batch.column("text"))
            first, start = w.firsts(), w.starts(window)
            if before is not None and len(start):
                alive = np.zeros(len(w.row) + 1, bool)
                lists = batch.column("places")
                alive[np.repeat(first, lists.value_lengths().to_numpy()) + lists.flatten().to_numpy()] = True
                start = start[alive[sliding_argmin(w.rolling(before), window - before + 1)[start]]]
            hashed = w.rolling(level)
            if level < window:
                start = np.unique(sliding_argmin(hashed, window - level + 1)[start]) if len(start) else start
                more = np.zeros(len(start), np.int32)
            else:
                more = (w.rolling(level, 5)[start] >> np.uint64(33)).astype(np.int32)
            row = pa.array(w.row[start])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(hashed[start])), pa.array(more), batch.column("id").take(row),
                 batch.column("mark").take(row), pa.array((start - first[w.row[start]]).astype(np.int32))],
                ["h", "g", "id", "mark", "place"],
            )

    return rows.mapInArrow(run, "h long, g int, id long, mark int, place int")


def _survivors(found: DataFrame, again: DataFrame, name: str) -> DataFrame:
    """Per document the places whose hash occurs twice or more; ``again`` is ``found`` once more."""
    # Counted per task first. Stored, so that the join below may split a hash that very many places share.
    twice = store(found.groupBy("h", "g").count().filter("count > 1").select("h", "g"), f"{name}-twice")
    places = again.join(twice, ["h", "g"]).groupBy("id", "mark").agg(F.collect_set("place").alias("places"))
    return store(places, f"{name}-places")


def repeated_windows(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, mark, places``: the first words of windows that occur anywhere else, per document that has any."""
    return _repeated(_rows(docs, doc_id, text), window)


def _repeated(rows: DataFrame, window: int) -> DataFrame:
    texts, alive, before = rows.select("id", "mark", "text"), None, None
    for level in levels(window):
        source = texts if alive is None else texts.join(alive, ["id", "mark"])
        found = _entries(source, window, level, before)
        # The last level has the most entries by far; making them twice takes less space than storing them.
        if level < window:
            found = store(found, f"level-{level}")
        alive, before = _survivors(found, found, f"level-{level}"), level
    return alive


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row ``doc_id, n_words, n_removed, kept_text``.

    Words are runs without white space. Every word is removed that lies in a window of ``window`` words whose sequence
    also starts anywhere else, in another document or at another place of this one; the kept words are joined by one
    space. Windows are judged on the input. Sequences are compared by a 95-bit hash. A null text is empty; texts
    shorter than the window keep all words; of rows that repeat an id and text, all words in windows go. No rows in, no
    rows out.
    """
    rows = _rows(docs, doc_id, text)
    found = rows.join(_repeated(rows, window), ["id", "mark"], "left").select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            total, removed, kept = [], [], []
            lists = batch.column("places")
            for i, t in enumerate(batch.column("text").to_pylist()):
                ws = t.encode().split()
                total.append(len(ws))
                if lists[i].is_valid:
                    edge = np.zeros(len(ws) + 1, np.int64)
                    start = lists[i].values.to_numpy()
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + window, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    ws = list(compress(ws, stays.tolist()))
                removed.append(total[-1] - len(ws))
                kept.append(b" ".join(ws).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return found.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")
