"""BPE encoding and decoding in content-defined chunks; chunks that many documents share are encoded once."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.encoding import remembered, word_bpe
from stratus.llm.tables import pieces, store
from stratus.llm.words import words_of

#: A chunk ends before a word if the hash of the words before it says so: every AVERAGE-th word.
WINDOW, AVERAGE = 4, 64
#: The shared table: so many chunks and bytes of text at most, those that save most. All others are encoded where met.
SHARED, SHARED_BYTES, LONGEST = 20_000, 8 << 20, 1 << 16

Encoded = tuple[bytes, bytes]


def chunk_places(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bytes of all texts, and per text the places where a chunk begins, with the text's end.

    A place depends on the ``WINDOW`` words before it only, so equal passages are cut alike wherever they stand.
    """
    w = words_of(texts)
    first, hashed = w.windows(WINDOW)
    after = first + WINDOW
    last = after < len(w.row)
    after, hashed = after[last], hashed[last]
    chosen = after[(w.row[after] == w.row[after - 1]) & (hashed % np.uint64(AVERAGE) == 0)]
    sizes = np.array([len(t.encode()) if t else 0 for t in texts.to_pylist()], np.int64)
    ends = np.cumsum(sizes)
    cuts = np.split(w.start[chosen], np.searchsorted(w.row[chosen], np.arange(1, w.rows)))
    return w.data, [
        np.concatenate([[end - size], inner, [end]]) for size, end, inner in zip(sizes, ends, cuts, strict=True)
    ]


def chunks(texts: pa.Array) -> Iterator[list[bytes]]:
    data, places = chunk_places(texts)
    whole = data.tobytes()
    for at in places:
        yield [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) if a < b]


class ChunkEncoder:
    """Encodes parts of a text and joins them; knows the words it met, and the chunks it is given."""

    def __init__(self, path: str, shared: dict[bytes, Encoded]):
        self.encode, self.vocabulary = word_bpe(path)
        self.words: dict[bytes, Encoded] = remembered(path)
        self.agreed: dict[tuple[bytes, bytes], bool] = remembered(f"{path} joins")
        self.shared = shared

    def exact(self, part: bytes) -> Encoded:
        """Ids, and their decoded form within a text: each token after a space."""
        ids = self.encode(part.decode())
        tokens = " ".join([self.vocabulary[i] for i in ids])
        return array("I", ids).tobytes(), (" " + tokens).encode() if ids else b""

    def chunk(self, part: bytes) -> Encoded:
        found = self.shared.get(part)
        if found is not None:
            return found
        ws = part.split()
        for w in set(ws).difference(self.words):
            self.words[w] = self.exact(w)
        each = [self.words[w] for w in ws]
        return b"".join([e[0] for e in each]), b"".join([e[1] for e in each])

    def text(self, parts: list[bytes]) -> Encoded:
        if not parts:
            return b"", b""
        parts, out = list(parts), [self.chunk(p) for p in parts]
        for k in range(1, len(parts)):
            if not self.agrees(parts[k - 1], parts[k], out[k - 1], out[k]):
                # From here on the two are one part, for the next join too.
                parts[k] = parts[k - 1] + parts[k]
                out[k - 1], out[k] = (b"", b""), self.exact(parts[k])
        return b"".join([o[0] for o in out]), b"".join([o[1] for o in out])

    def agrees(self, left: bytes, right: bytes, a: Encoded, b: Encoded) -> bool:
        """Whether encoding across the join of two neighbours gives what they have.

        The last words of one and the first words of the other are encoded together, twice as many each time, until that
        agrees; if it never does, up to the whole of both, the two have to be encoded as one.
        """
        lw, rw = left.split()[-1:], right.split(None, 1)[:1]
        if left[-1:].isspace() and lw and rw:
            key = (lw[0], rw[0])
            if key not in self.agreed:
                self.agreed[key] = self.exact(b" ".join(key))[0] == self.exact(key[0])[0] + self.exact(key[1])[0]
            if self.agreed[key]:
                return True
        n, ls, rs = 1, left.split(), right.split()
        while n < 2 * max(len(ls), len(rs)):
            tail, head = left[_place(left, len(ls) - n) :], right[: _place(right, n)]
            ta, hb = self.exact(tail)[0], self.exact(head)[0]
            if a[0].endswith(ta) and b[0].startswith(hb) and self.exact(tail + head)[0] == ta + hb:
                return True
            n *= 2
        return False


def _place(part: bytes, word: int) -> int:
    """Where the word of that number begins; the end beyond the last."""
    if word <= 0:
        return 0
    starts = words_of(pa.array([part.decode()])).start
    return int(starts[word]) if word < len(starts) else len(part)


def shared_chunks(docs: DataFrame, path: str, text: str) -> dict[bytes, Encoded]:
    """The chunks whose reuse saves most, each encoded once by one task."""
    rows = docs.select(F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            first, second, size = [], [], []
            for parts in chunks(batch.column("text")):
                for p in parts:
                    if len(p) <= LONGEST:
                        digest = hashlib.md5(p).digest()
                        first.append(int.from_bytes(digest[:8], "little", signed=True))
                        second.append(int.from_bytes(digest[8:], "little", signed=True))
                        size.append(len(p))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (first, second, size)], ["h1", "h2", "size"])

    seen = rows.mapInArrow(count, "h1 long, h2 long, size long").groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.max("size").alias("size")
    ).filter("n > 1")
    best = seen.orderBy(F.desc(F.expr("(n - 1) * size")), "h1", "h2").limit(SHARED).collect()
    chosen, total = set(), 0
    for r in best:
        total += r["size"]
        if total > SHARED_BYTES:
            break
        chosen.add((r["h1"], r["h2"]))
    if not chosen:
        return {}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in pieces(batches, "text"):
            new = []
            for parts in chunks(batch.column("text")):
                for p in parts:
                    digest = hashlib.md5(p).digest()
                    h = tuple(int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))
                    if h in chosen and h not in met:
                        met.add(h)
                        new.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary())], ["chunk"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path, {})
        for batch in batches:
            parts = batch.column("chunk").to_pylist()
            done = [encoder.exact(p) for p in parts]
            columns = [parts, [d[0] for d in done], [d[1] for d in done]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["chunk", "ids", "tokens"])

    once = rows.mapInArrow(find, "chunk binary").distinct()
    table = store(once.mapInArrow(encode, "chunk binary, ids binary, tokens binary"), "shared-chunks")
    return {bytes(r["chunk"]): (bytes(r["ids"]), bytes(r["tokens"])) for r in table.collect()}


def encode_documents(
    docs: DataFrame, path: str, columns: dict[str, tuple[str, Callable[[bytes, bytes], object]]],
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per input row ``doc_id`` and the given columns: Spark type, and a function of the ids (little-endian unsigned
    32-bit) and the decoded text (UTF-8).

    The ids are those of the tokenizers library for the file ``path`` without special tokens added, the decoded text is
    its decode of them, special tokens shown. It holds for vocabularies that drop white space and never join what it
    parts, without a decoder of their own. Each chunk of the shared table is encoded once for the whole corpus, every
    other chunk from its words, and every join of chunks is checked by encoding across it. A null text is empty; rows
    that repeat an id or a text each give a row.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(shared_chunks(docs, path, text))  # at most SHARED chunks, SHARED_BYTES of text
    names, types = list(columns), {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path, shared.value)
        for batch in pieces(batches, "text"):
            done = [encoder.text(parts) for parts in chunks(batch.column("text"))]
            made = [
                pa.array([columns[c][1](ids, tokens[1:]) for ids, tokens in done], types[columns[c][0]]) for c in names
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], ["doc_id", *names])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"{c} {columns[c][0]}" for c in names)]))


#: What the digests of a document's code are made of.
DIGESTS = {
    "n_tokens": ("long", lambda ids, decoded: len(ids) // 4),
    "ids_sha256": ("string", lambda ids, decoded: hashlib.sha256(ids).hexdigest()),
    "decoded_sha256": ("string", lambda ids, decoded: hashlib.sha256(decoded).hexdigest()),
}
