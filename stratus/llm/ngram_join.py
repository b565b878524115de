"""Exact Jaccard self-join of documents on their word n-grams, by partitions of the universe of n-grams.

Sets are put into bands by size. A band has a number of segments; a hash puts every n-gram into one of them. Two sets
above the threshold differ in at most H n-grams, so if the segments of one may differ by less than ``a`` n-grams each and
the ``a`` sum up to H + 1, at least one segment of the two differs by less than its ``a``: it is equal where ``a`` is 1,
and equal up to one n-gram where it is 2. Segments that hold next to nothing would meet by chance in very many documents;
they get 0, and full ones make up for them with 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.components import connected_components
from stratus.llm.tables import pieces, store
from stratus.llm.words import mix, signed, words_of

N, PERCENT = 4, 85
#: Segments with at most LIGHT n-grams are left out if others with at least HEAVY can make up for them.
LIGHT, HEAVY = 1, 10
#: Members of a bucket that are compared in one piece; larger buckets are compared block against block.
BLOCK = 1_000
#: Bits of the filter that keeps texts which no pair needs out of the shuffle: a fixed 2 MB at any size of the corpus.
FILTER_BITS = 1 << 24
INDEX, PROBE = 1, 2


class Bands:
    """Sizes of the bands and their numbers of segments: two linked sets are in the same band or in neighbours."""

    def __init__(self, percent: int):
        self.percent = percent
        low, self.high = 1, [0]
        while self.high[-1] < 1 << 40:
            self.high.append(low * 100 // percent)
            low = self.high[-1] + 1
        self.high = np.array(self.high, np.int64)
        self.segments = self.apart(self.high, self.high * 100 // percent) + 1

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The most n-grams in which linked sets of these sizes differ."""
        return (100 - self.percent) * (x + y) // (100 + self.percent)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.high, size)


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of the distinct n-grams of each text, ordered by both, and their number per row.

    A text with fewer words than ``n`` has its whole sequence as one.
    """
    w = words_of(texts, lower=True)
    counts, begin = w.counts(), w.firsts()
    held = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    place = np.cumsum(held) - held
    row = np.repeat(np.arange(w.rows), held)
    hashed = np.empty(len(row), np.uint64)
    hashed[(counts >= n)[row]] = w.windows(n)[1]
    for short in range(1, n):
        own = np.flatnonzero(counts == short)
        if len(own):
            hashed[place[own]] = w.rolling(short)[begin[own]]
    for a, b in zip(place.tolist(), (place + held).tolist(), strict=True):
        hashed[a:b].sort()
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    row, hashed = row[new], hashed[new]
    return row, hashed, np.bincount(row, minlength=w.rows)


def _sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.uint64)
    np.add.at(total, groups, values)
    return total


def set_ids(row: np.ndarray, hashed: np.ndarray, rows: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, whatever the order of its members."""
    return _sums(mix(hashed, 100 + salt), row, rows), _sums(mix(hashed, 200 + salt), row, rows)


def sketch_bits(size: int) -> int:
    return max(64, 1 << int(4 * size - 1).bit_length())


def sketch(hashed: np.ndarray) -> bytes:
    """One bit per n-gram, each n-gram turning its bit over: two sketches differ in no more bits than the sets in
    n-grams."""
    bits = sketch_bits(len(hashed))
    odd = np.bincount((mix(hashed, 300) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def folded(sketch_: bytes, size: int) -> np.ndarray:
    """The sketch in ``size`` bytes; both sizes are powers of two."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch_, np.uint8).reshape(-1, size)) if len(sketch_) > size else (
        np.frombuffer(sketch_, np.uint8))


def segment_keys(
    row: np.ndarray, hashed: np.ndarray, sizes: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and role of all entries of the sets in a batch."""
    own = bands.of(sizes)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lower = (sizes > 0) & (own > 1) & (bands.percent * sizes <= 100 * bands.high[np.maximum(own - 1, 0)])
    for band, taken, index in ((own, sizes > 0, True), (own - 1, lower, False)):
        docs = np.flatnonzero(taken)
        if not len(docs):
            continue
        member = taken[row]
        r, h = row[member], hashed[member]
        m = bands.segments[band[docs]]
        base = np.zeros(len(sizes), np.int64)
        base[docs] = np.cumsum(m) - m
        total = int(m.sum())
        seg = base[r] + (mix(h, 11) % bands.segments[band[r]].astype(np.uint64)).astype(np.int64)
        of = np.repeat(docs, m)
        place = np.arange(total) - base[of]
        held = np.bincount(seg, minlength=total)
        value = mix(h, 12)
        sums = _sums(value, seg, total)
        where = [mix(((band[of] << 40) + (place << 1) + kind).astype(np.uint64), 14) for kind in (0, 1)]

        # How much each segment of a probing set may differ: 0 for the lightest, 2 for as many full ones as needed.
        partner = sizes if index else bands.high[np.maximum(band, 0)]
        spare = m - (bands.apart(sizes, partner)[docs] + 1)
        at = base[docs]
        light = np.add.reduceat((held <= LIGHT).astype(np.int64), at)
        heavy = np.add.reduceat((held >= HEAVY).astype(np.int64), at)
        double = np.minimum(np.maximum(light - spare, 0), heavy)
        rank = np.empty(total, np.int64)
        rank[np.lexsort((held, of))] = np.arange(total)
        rank -= base[of]
        allowed = np.ones(total, np.int64)
        allowed[rank < np.repeat(spare + double, m)] = 0
        from_ = np.repeat(m - heavy, m)
        allowed[(rank >= from_) & (rank < from_ + np.repeat(double, m))] = 2

        exact = mix(sums + where[0], 15)
        if index:
            out.append((of, exact, np.where(allowed > 0, INDEX | PROBE, INDEX)))
            big = held[seg] > HEAVY
            out.append((r[big], mix(sums[seg[big]] - value[big] + where[1][seg[big]], 15), np.full(int(big.sum()), INDEX)))
        else:
            some = allowed > 0
            out.append((of[some], exact[some], np.full(int(some.sum()), PROBE)))
        both = allowed == 2
        out.append((of[both], mix(sums[both] + where[1][both], 15), np.full(int(both.sum()), PROBE)))
        less = both[seg]
        out.append((r[less], mix(sums[seg[less]] - value[less] + where[0][seg[less]], 15), np.full(int(less.sum()), PROBE)))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class NgramJoin:
    """The join of one table of documents; ``salt`` changes every hash."""

    def __init__(self, docs: DataFrame, n: int, percent: int, doc_id: str, text: str, salt: int = 0):
        self.rows = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("body")
        )
        self.n, self.bands, self.salt = n, Bands(percent), salt
        self.sets = store(self._sets(), "ngram-sets")
        self.sketches = store(
            self.sets.filter("n_shingles > 0").select("id", "n_shingles", "sketch", "body").dropDuplicates(["id"]), "ngram-sketches"
        )

    def _sets(self) -> DataFrame:
        """Per input row its id, the hashes of its set, and the set's sketch."""
        n, salt = self.n, self.salt

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                row, hashed, sizes = shingles(batch.column("text"), n)
                first, second = set_ids(row, hashed, len(sizes), salt)
                parts = np.split(hashed, np.cumsum(sizes)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes), pa.array(signed(first)), pa.array(signed(second)),
                     pa.array([sketch(p) for p in parts], pa.binary()), batch.column("body")],
                    ["doc_id", "n_shingles", "id", "check", "sketch", "body"],
                )

        return self.rows.mapInArrow(run, "doc_id long, n_shingles long, id long, check long, sketch binary, body long")

    def collided(self) -> bool:
        """Whether two different sets share their 64-bit id; the second hash and the size tell."""
        same = self.sets.groupBy("id").agg(
            F.min("check").alias("a"), F.max("check").alias("b"), F.min("n_shingles").alias("c"), F.max("n_shingles").alias("d")
        )
        return not same.filter("a <> b OR c <> d").isEmpty()

    def entries(self) -> DataFrame:
        n, salt, bands = self.n, self.salt, self.bands

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                row, hashed, sizes = shingles(batch.column("text"), n)
                first, _ = set_ids(row, hashed, len(sizes), salt)
                of, key, role = segment_keys(row, hashed, sizes, bands)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key)), pa.array(signed(first)[of]), pa.array(role.astype(np.int8))], ["key", "id", "role"]
                )

        return self.rows.select("text").mapInArrow(run, "key long, id long, role tinyint")

    def buckets(self) -> DataFrame:
        """``key, id, role, leader``: entries whose key several different sets have, once per set."""
        # Copies of one set are one member: smallest and largest id tell whether a key has two, without a list.
        keys = store(
            self.entries().groupBy("key").agg(
                F.min("id").alias("leader"), F.max("id").alias("last"), F.bit_or("role").alias("roles")
            ).filter(f"leader <> last AND roles = {INDEX | PROBE}").select("key", "leader"),
            "ngram-keys",
        )
        met = self.entries().join(keys, "key").groupBy("key", "id", "leader").agg(F.bit_or("role").alias("role"))
        return store(met, "ngram-buckets")

    def close(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of ids that sizes and sketches do not rule out."""
        bands = self.bands
        plain = self.sketches.drop("body")
        a, b = plain.toDF("a", "size_a", "sketch_a"), plain.toDF("b", "size_b", "sketch_b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
                limit, keep = bands.apart(x, y), np.abs(x - y) <= bands.apart(x, y)
                sa, sb = batch.column("sketch_a"), batch.column("sketch_b")
                for i in np.flatnonzero(keep).tolist():
                    p, q = sa[i].as_py(), sb[i].as_py()
                    size = min(len(p), len(q))
                    keep[i] = np.bitwise_count(folded(p, size) ^ folded(q, size)).sum() <= limit[i]
                yield batch.select(["a", "b"]).filter(pa.array(keep))

        return pairs.join(a, "a").join(b, "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(
            run, "a long, b long"
        )

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are links, by counting the n-grams of both whole texts."""
        if pairs.isEmpty():
            return pairs
        n, salt, percent = self.n, self.salt, self.bands.percent
        needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        # One text of each set that is needed; its hash tells it, so no other text is cut into words or shuffled.
        bits = hash_bits(self.sketches.join(needed, "id", "left_semi").select("body"))

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(filtered(batches, "body", bits), "text"):
                row, hashed, sizes = shingles(batch.column("text"), n)
                first, _ = set_ids(row, hashed, len(sizes), salt)
                yield pa.RecordBatch.from_arrays([pa.array(signed(first)), batch.column("text")], ["id", "text"])

        texts = self.rows.select("text", "body").mapInArrow(named, "id long, text string").join(needed, "id", "left_semi")
        texts = store(texts.dropDuplicates(["id"]), f"{name}-texts")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(pieces(batches, "text_a"), "text_b"):
                ra, ha, x = shingles(batch.column("text_a"), n)
                rb, hb, y = shingles(batch.column("text_b"), n)
                row, hashed = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((hashed, row))
                row, hashed = row[order], hashed[order]
                twice = (row[1:] == row[:-1]) & (hashed[1:] == hashed[:-1])
                shared = np.bincount(row[1:][twice], minlength=len(x))
                keep = 100 * shared >= percent * (x + y - shared)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

        both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        return store(both.select("a", "b", "text_a", "text_b").mapInArrow(count, "a long, b long"), f"{name}-links")

    def links(self) -> DataFrame:
        """Links ``a, b`` between set ids, enough of them that their components are those of all links.

        Every bucket is first compared with one member, its leader. Members that these links already connect need no
        link of their own; all other pairs of a bucket are compared by sketches where they meet, and by their texts
        if the sketches do not rule them out.
        """
        buckets = self.buckets()
        stars = buckets.filter("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
        tested = store(self.close(store(stars.distinct(), "ngram-stars")), "ngram-star-pairs")
        links = self.verified(tested, "ngram-star")
        # First as few pairs as would connect each bucket if all that sketches let through were links, then all that are
        # still in different parts. The second time hardly any are left, however many links a group has.
        for forest in (True, False):
            part = store(connected_components(links), "ngram-parts").toDF("id", "part")
            placed = buckets.join(part, "id", "left").withColumn("part", F.coalesce("part", "id"))
            placed = store(placed, "ngram-placed")
            # A bucket of two was compared as a star; a bucket of one part has nothing to add.
            mixed = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("part").alias("x"), F.max("part").alias("y"))
            mixed = store(mixed.filter("size > 2 AND x <> y").select("key", "size"), "ngram-mixed")
            pairs = self._compared(placed.join(mixed, "key"), forest).distinct().join(tested, ["a", "b"], "left_anti")
            pairs = store(pairs, "ngram-pairs")
            tested = tested.unionByName(pairs)
            links = links.unionByName(self.verified(pairs, "ngram"))
        return links

    def _compared(self, members: DataFrame, forest: bool) -> DataFrame:
        """Pairs of different parts within buckets whose sketches do not rule them out."""
        bands = self.bands
        blocks = F.ceil(F.col("size") / BLOCK)
        own = F.pmod(F.xxhash64("id", "key"), blocks)
        # A member of block i meets block j in the pair (min, max) of the two; a bucket of one block stays whole.
        pairs = F.explode(F.transform(
            F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"))
        ))
        rows = members.join(self.sketches, "id").select("key", "id", "role", "part", "n_shingles", "sketch", own.alias("own"), pairs.alias("p"))
        rows = rows.select("key", "p.i", "p.j", "own", "id", "role", "part", "n_shingles", "sketch")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in runs(batches, ["key", "i", "j"]):
                a, b = compared(group, bands, forest)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long")

    def components(self) -> DataFrame:
        """Per input row ``doc_id, n_shingles, component_id``."""
        part = store(connected_components(self.links()), "ngram-components").toDF("id", "part")
        rows = self.sets.select("doc_id", "n_shingles", "id").join(part, "id", "left")
        # Documents without words are linked with nothing and name themselves.
        rows = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("part", "id")).alias("part"))
        rows = store(rows, "ngram-rows")
        least = store(rows.filter("part IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("least")), "ngram-least")
        return rows.join(least, "part", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


    def leaving(self) -> DataFrame:
        """``doc_id, body`` of the rows that give way to another row of their component: all but one id and text."""
        part = store(connected_components(self.links()), "ngram-components").toDF("id", "part")
        rows = self.sets.filter("n_shingles > 0").select("doc_id", "body", "id").join(part, "id", "left")
        rows = store(rows.select("doc_id", "body", F.coalesce("part", "id").alias("part")), "ngram-rows")
        # The smallest id, null behind all others; of one id the smallest hash of a text.
        first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body")
        stays = store(rows.groupBy("part").agg(F.min(first).alias("stays")), "ngram-least")
        gone = rows.join(stays, "part").filter(
            ~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("body") == F.col("stays.body")))
        )
        return gone.select("doc_id", "body").distinct()

    def repeated(self) -> DataFrame:
        """``doc_id, body`` that several rows with words have in common."""
        rows = self.sets.filter("n_shingles > 0").groupBy("doc_id", "body").agg(F.count("*").alias("n"))
        return rows.filter("n > 1").select("doc_id", "body")


def hash_bits(values: DataFrame) -> np.ndarray:
    """A bit for the low bits of every value of a column of hashes; as many rows as it has words reach the driver at
    most."""
    (name,) = values.columns
    place = F.pmod(name, F.lit(FILTER_BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod({name}, {FILTER_BITS}) % 64 as int))")
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in values.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        words[row["word"]] = row["bits"] % 2**64
    return words


def filtered(batches: Iterator[pa.RecordBatch], column: str, words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows whose hash has its bit: all that were counted in, and few others."""
    for batch in batches:
        at = batch.column(column).to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)
        has = words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
        yield batch.filter(pa.array(has.astype(bool)))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with equal keys, also over the ends of batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield _one(held)
            held = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield _one(held)
                held = []
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def compared(group: pa.RecordBatch, bands: Bands, forest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket (or of two of its blocks) that may be links between different parts.

    With ``forest`` only so many that the parts they connect are the same.
    """
    empty = np.empty(0, np.int64)
    if group.num_rows < 2:
        return empty, empty
    ids, parts, sizes, roles, own = (
        group.column(c).to_numpy() for c in ("id", "part", "n_shingles", "role", "own")
    )
    parts = parts.copy()
    if parts.min() == parts.max():
        return empty, empty
    apart_blocks = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    texts = group.column("sketch").to_pylist()
    width = min(map(len, texts))
    bits = np.stack([folded(s, width) for s in texts]).view(np.uint64)
    a, b = [], []
    for k in range(len(ids) - 1):
        rest = slice(k + 1, None)
        x, y = sizes[k], sizes[rest]
        probe = np.where(y > x, roles[rest], roles[k])
        index = np.where(y > x, roles[k], roles[rest])
        fits = (probe & PROBE > 0) & (index & INDEX > 0) | (y == x) & (roles[k] & INDEX > 0) & (roles[rest] & PROBE > 0)
        limit = bands.apart(x, y)
        near = (parts[rest] != parts[k]) & fits & (np.abs(y - x) <= limit)
        if apart_blocks:
            near &= own[rest] != own[k]
        at = np.flatnonzero(near)
        if len(at):
            far = np.bitwise_count(bits[k + 1 + at] ^ bits[k]).sum(axis=1)
            at = at[far <= limit[at]] + k + 1
            if forest and len(at):
                reached, first = np.unique(parts[at], return_index=True)
                at = at[first]
                parts[np.isin(parts, reached)] = parts[k]
            a.append(np.minimum(ids[k], ids[at]))
            b.append(np.maximum(ids[k], ids[at]))
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", salts: int = 4
) -> DataFrame:
    """Per input row ``doc_id, n_shingles, component_id``.

    The set of a document is its distinct ``n``-grams of words, A-Z lower-cased; with fewer words it is the whole
    sequence. Two documents are linked if 100 x shared >= ``percent`` x united n-grams. ``component_id`` is the smallest
    id that links reach; a null or wordless text is linked with nothing and names itself, rows with equal sets are in one
    component, and a null id gives way to any other. N-grams are compared by 64-bit hashes. If two different sets get
    one 64-bit id, all is done again with other hashes; after ``salts`` times it is an error, not a wrong result.
    """
    return _joined(docs, n, percent, doc_id, text, salts).components()


def _joined(docs: DataFrame, n: int, percent: int, doc_id: str, text: str, salts: int) -> NgramJoin:
    for salt in range(salts):
        join = NgramJoin(docs, n, percent, doc_id, text, salt)
        if not join.collided():
            return join
    raise RuntimeError("too many different texts for 64-bit ids")


def drop_near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", salts: int = 4
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: of each component of ``near_duplicates`` one row.

    It is the row with the smallest id; a null id gives way to any other. Rows are told apart by id and text, so rows
    without an id, and different texts under one id, are judged each on its own; of rows that repeat both one stays.
    Null and wordless texts stay, all of them. No rows in, no rows out.
    """
    join = _joined(docs, n, percent, doc_id, text, salts)
    gone, repeated = join.leaving(), store(join.repeated(), "ngram-repeated")
    # The whole row travels as one struct, so its column names cannot clash with the ones used here.
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("hash"))

    def found_in(keys: DataFrame) -> Column:
        return rows["id"].eqNullSafe(keys["doc_id"]) & (rows["hash"] == keys["body"])

    kept = rows.join(gone, found_in(gone), "left_anti")
    if not repeated.isEmpty():
        # Only rows that repeat id and text are brought together.
        again = Window.partitionBy("id", "hash").orderBy(F.lit(0))
        many = kept.join(repeated, found_in(repeated), "left_semi").withColumn("nth", F.row_number().over(again))
        kept = kept.join(repeated, found_in(repeated), "left_anti").unionByName(many.filter("nth = 1").drop("nth"))
    return kept.select("row.*")
