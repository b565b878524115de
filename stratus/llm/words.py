"""Words of a column of texts as arrays: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (9, 10, 11, 12, 13, 32)
#: Byte classes of the two ways to cut: at white space only, or also between letters and punctuation.
BY_SPACE = np.ones(256, np.uint8)
BY_SPACE[list(SPACES)] = 0
BY_KIND = BY_SPACE.copy()
BY_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)
#: The inverse of BASE modulo 2**64; both are odd.
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
MAX_POWERS = 1 << 22
STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """``row`` is the index of the text; ``start`` and ``end`` are byte places in ``data``."""

    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def firsts(self) -> np.ndarray:
        """Index of every text's first word."""
        counts = self.counts()
        return np.cumsum(counts) - counts

    def starts(self, width: int) -> np.ndarray:
        """First words of all windows of ``width`` words within one text."""
        n = len(self.row) - width + 1
        return np.flatnonzero(self.row[:n] == self.row[width - 1 :]) if n > 0 else np.empty(0, np.int64)

    def rolling(self, width: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``width`` words from each word on, whatever texts they are of."""
        n = max(0, len(self.row) - width + 1)
        words = mix(self.hash, salt) if salt else self.hash
        total, scale = words[:n].copy(), STEP
        for i in range(1, width):
            total += words[i : i + n] * scale
            scale = np.uint64(int(scale) * int(STEP) % 2**64)
        return mix(total, width)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        first = self.starts(width)
        return first, self.rolling(width)[first]


_powers = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of BASE, from the first on, and of its inverse, from the zeroth on.

    Up to MAX_POWERS are kept for the next call; a longer text makes its own.
    """
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    size = 1 << max(16, (n - 1).bit_length())
    up = np.multiply.accumulate(np.full(size, BASE))
    down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, INVERSE)]))
    if size <= MAX_POWERS:
        _powers = (up, down)
    return up, down


def words_of(texts: pa.Array, classes: np.ndarray = BY_SPACE, lower: bool = False) -> Words:
    """Maximal runs of bytes of one class; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    rows = len(texts)
    _, offsets, buffer = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + rows + 1] if rows else np.zeros(1, np.int64)
    data = np.frombuffer(buffer, np.uint8)[places[0] : places[-1]] if buffer is not None else np.empty(0, np.uint8)
    places = places - places[0]
    if lower:
        data = LOWER[data]
    kind = classes[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[places] = True
    cuts = np.flatnonzero(edge)
    start, end = cuts[:-1], cuts[1:]
    word = kind[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[word], end[word]
    row = np.searchsorted(places, start, side="right") - 1
    if not len(start):
        return Words(data, row, start, end, np.empty(0, np.uint64), rows)
    # Every byte counts with a power of its place in the word: the sums up to the word's ends, less the power of its start.
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return Words(data, row, start, end, mix((sums[end] - sums[start]) * down[start]), rows)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's ``long``."""
    return x.view(np.int64)
