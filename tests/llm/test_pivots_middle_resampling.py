"""Pivot index, fill-in-the-middle and target resampling against plain Python and SQL, on tables with all kinds of rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entrypoint
from stratus.llm import fill_middle, pivot_index, target_resampling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n long, form string, output string, _key string, _cut int, score long, rank int, a long"


def same(got, expected):
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def texts():
    return [
        None, "", " ", "a", "One one ONE two", "é\U0001f469‍\U0001f467 日本 x", "holds <P> a marker", "ends in <", "<S", "P>",
        "line\nline\r\n\ttab x", "it's 12 wörter, don't", "\x00nul\x01", " ".join(f"long{i % 977}" for i in range(30_000)), "y" * 5_000,
        "x" * 70 + " b " + "é" * 40 + " c d " + "q" * 65, " ".join(["w"] * 25), " ".join(["w"] * 25), *[f"{i} words of text {i % 3} " * 6 for i in range(40)],
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, 1, "x", "y", "z", 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[16], rows[20], rows[20], (None, "one two " * 12, *[None] * 8), (None, None, *[None] * 8)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op11_embedding_pivots", "op12_fill_middle"])
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(entrypoint.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    same([tuple(r) for r in entrypoint.queries()[name](spark, SF).select(columns).collect()], cursor.fetchall())


# 12: fill in the middle


def plain_rearranged(i, text):
    text = text or ""
    n, key = len(text), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, text, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return i, text, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return i, text, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.mark.parametrize("stretch", [1_000_000, 7])
def test_rearrange(docs, stretch):
    got = fill_middle.rearrange(docs, stretch=stretch)
    rows = docs.select("doc_id", "text").collect()
    same([tuple(r) for r in got.collect()], [plain_rearranged(*r) for r in rows])
    back = got.select("text", fill_middle.restored(F.col("output"), F.col("form")).alias("again")).collect()
    assert all(r.text == r.again for r in back)


def test_rearrange_units(docs, empty):
    words = fill_middle.rearrange(docs, unit=r"\S+\s*").collect()
    for r in words:
        assert r.n == (len(re.findall(r"\S+\s*", r.text)) if not r.text[:1].isspace() else None)
        if r.form != "plain":
            ends = [0, *(m.end() for m in re.finditer(r"\S+\s*", r.text))]
            assert r.prefix_chars in ends and r.prefix_chars + r.middle_chars in ends
    assert fill_middle.rearrange(empty).collect() == []


def test_rearrange_markers(docs):
    with pytest.raises(ValueError):
        fill_middle.rearrange(docs, markers=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fill_middle.rearrange(docs, markers=("<<P", "<S>", "<M>"))


# 13: resampling towards a target


def word_list(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def features(text):
    ws = word_list(text)
    return [zlib.crc32(" ".join(ws[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def plain_resampled(rows, target):
    raw, aim = Counter(), Counter()
    for _, t in rows:
        raw.update(features(t))
    for t in target:
        aim.update(features(t))
    s_all, t_all = sum(raw.values()), sum(aim.values())
    out = []
    for i, t in rows:
        found = features(t)
        weight = sum(math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(word_list(t)), len(found), weight, score, None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(fit[: len(fit) * 5 // 100]):
        r[5] = k + 1
    return out


def test_resample(spark, docs, texts):
    target = spark.createDataFrame([("one two three w w w",), (None,), ("",), ("Words of TEXT 1",)], "text string")
    got = target_resampling.resample(docs, target)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = plain_resampled(rows, [r.text for r in target.collect()])
    # Rows that repeat an id and a text may change places in the draw.
    ranked = [r for r in expected if r[5]]
    same([tuple(r)[:5] for r in got.collect()], [tuple(r)[:5] for r in expected])
    same([(r["score"], r["rank"]) for r in got.collect() if r["rank"]], [(r[4], r[5]) for r in ranked])
    assert len(ranked) == 2


def test_resample_registered(spark):
    got = entrypoint.queries()["op13_target_resampling"](spark, SF).collect()
    table = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    rows = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    expected = plain_resampled(rows, [r.text for r in table("benchmark").collect()])
    same([tuple(r) for r in got], [(i, n, w, s, k) for i, _, n, w, s, k in expected])


def test_resample_empty(empty, docs):
    assert target_resampling.resample(empty, docs).collect() == []
    assert target_resampling.resample(docs, empty).count() == docs.count()


@pytest.mark.parametrize("size", [1 << 20, 60, 9])
@pytest.mark.parametrize("known", [0, 40])
def test_features(texts, size, known):
    """With and without a head, and cut anywhere, runs hash to the same buckets."""
    counts = Counter(w for t in texts for w in word_list(t) if len(w.encode()) <= 16)
    frequent = [w for w, _ in counts.most_common(known)]

    def name(w):
        n = int.from_bytes(w.encode(), "little")
        return n % (1 << 64), n >> 64

    pairs = [(*name(a), *name(b)) for a in frequent[:20] for b in frequent[:20]]
    head = target_resampling.Head.of([name(w) for w in frequent], pairs, 10_000)
    assert (head.low > 0).sum() == len(frequent) and (known == 0) == (not (head.pair > 0).any())
    found = [[] for _ in texts]
    for words, of, repeated in target_resampling.stretches(pa.array(texts), size):
        for row, bucket in zip(*target_resampling.features(words, repeated, head), strict=True):
            found[of[row]].append(int(bucket))
    assert [sorted(f) for f in found] == [sorted(features(t)) for t in texts]


# 11: near vectors by shared pivots


def plain_near(rows, least):
    unit = []
    for _, label, v in rows:
        fit = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if fit else None)
    linked = [
        [j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and rows[i][1] == rows[j][1]
         and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
        for i in range(len(rows))
    ]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least_id = min(ids, default=None)
        out.append((rows[i][0], rows[i][1], len(linked[i]), least_id, rows[i][0] == least_id))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = []

    def crowd(n, noise, label):
        centre = rng.normal(size=16)
        for _ in range(n):
            v = centre + noise * np.linalg.norm(centre) / 4 * rng.normal(size=16)
            rows.append((len(rows), label, [float(x) for x in v.astype(np.float32)]))

    for k in range(12):
        crowd(6, 0.12 + 0.02 * k, k % 3)
    crowd(90, 0.14, 1)
    rows += [(len(rows) + k, 2, [float(x) for x in rng.normal(size=16).astype(np.float32)]) for k in range(150)]
    v = rows[0][2]
    odd = [
        None, [], [0.0] * 16, [None] + v[1:], [float("nan")] + v[1:], [float("inf")] + v[1:], v[:8], [2 * x for x in v], [-x for x in v],
        [1e-30] * 16, [1e-30] * 16, [1e30] * 16, [-0.0] + [1.0] * 15, [0.0] + [1.0] * 15,
    ]
    rows += [(1000 + k, 0, x) for k, x in enumerate(odd)] + [(2000, None, v), (3, 0, v), (0, 0, v), (None, 0, v), (None, 9, v)]
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    kind = "vec_id long, label int, embedding array<float>, node long, list int, copies int, component string, vector string"
    given = spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in vectors], kind).repartition(5)
    got = [tuple(r) for r in pivot_index.near_vectors(given).collect()]
    same(got, plain_near(vectors, 0.98))
    assert pivot_index.near_vectors(given.limit(0)).collect() == []
    one = [tuple(r) for r in pivot_index.near_vectors(given.filter("vec_id = 5")).collect()]
    assert one == [(5, 0, 0, 5, True)]


def test_near_vectors_recall():
    """Of pairs at the border of a link, by far the most share enough pivots; of other pairs hardly any do."""
    rng = np.random.default_rng(8)
    base = pivot_index._units(rng.normal(size=(4000, 64)))
    side = rng.normal(size=base.shape)
    side = pivot_index._units(side - (side * base).sum(1, keepdims=True) * base)
    near = 0.98 * base + math.sqrt(1 - 0.98**2) * side
    pivots = pivot_index.Pivots.fit(base[:1500])
    a, b = (np.sort(pivots.nearest(x), axis=1) for x in (base, near))
    shared = np.array([len(set(x) & set(y)) for x, y in zip(a, b, strict=True)])
    other = np.array([len(set(x) & set(y)) for x, y in zip(a[1:], b[:-1], strict=True)])
    assert (shared >= pivot_index.SHARED).mean() > 0.99
    assert (other >= pivot_index.SHARED).mean() < 0.001
    rare = pivot_index.RAREST
    kept = shared >= pivot_index.SHARED
    assert all(len(set(x[:rare]) & set(y[:rare])) >= 2 for x, y in zip(a[kept], b[kept], strict=True))
