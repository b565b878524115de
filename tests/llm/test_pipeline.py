"""The corpus pipeline stage by stage: rows with null and repeated ids, empty tables, clashing columns; and the SQL of all queries."""

import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entrypoint
import corpus_pipeline
from stratus.llm import importance, ngram_join
from stratus.llm.statements import STATEMENTS

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = SCHEMA + ", id long, hash string, body long, part long, row string, kept boolean, mark string, doc struct<x: int>"
GOOD = "the quick brown fox jumps over the lazy dog while a small bird sings in the old tree near our house today".split()
BAD = "zorp blag idiot trash moron junk spam vile nasty hate".split()


def text_of(words, seed, n=60):
    return " ".join(random.Random(seed).choices(words, k=n))


def rows_of(spark, rows, schema=SCHEMA):
    width = len(spark.createDataFrame([], schema).columns)
    return spark.createDataFrame([(*r, "en", "s", 0, *[None] * (width - 5)) for r in rows], schema).repartition(3)


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """A folder whose labels call documents 1000 to 1199 good and 1200 to 1299 toxic, and these documents."""
    folder = str(tmp_path_factory.mktemp("tables"))
    ids = [(i, 1, int(i >= 1200)) for i in range(1000, 1300)]
    spark.createDataFrame(ids, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, [(i, text_of(GOOD if i < 1200 else BAD, i)) for i in range(1000, 1300)]


def test_classifier_judges_rows_not_ids(spark, labelled):
    folder, known = labelled
    good, bad = [text_of(GOOD, s, 500) for s in range(4)], [text_of(BAD, s) for s in range(4)]
    odd = [(None, good[0]), (None, bad[0]), (7, good[1]), (7, bad[1]), (8, good[2]), (8, good[2]), (9, None), (10, ""), (None, None)]
    for schema in (SCHEMA, CLASHING):
        docs = rows_of(spark, known + odd, schema)
        kept = corpus_pipeline.quality_classifier(spark, docs, folder)
        assert kept.schema == docs.schema
        left = texts(kept)
        for row in ((None, good[0]), (7, good[1]), (8, good[2])):
            assert row in left
        # Texts without words weigh nothing; whatever that means here, it means it for all of them.
        assert len({row in left for row in ((9, None), (10, ""), (None, None))}) == 1
        assert left.count((8, good[2])) == 2
        assert (None, bad[0]) not in left and (7, bad[1]) not in left
        assert not [r for r in left if r[0] is not None and r[0] >= 1200]
        assert sum(1 for r in left if r[0] is not None and 1000 <= r[0] < 1200) >= 198
    assert corpus_pipeline.quality_classifier(spark, docs.limit(0), folder).collect() == []


def test_marks_come_back_with_the_verdict(spark, labelled):
    folder, known = labelled
    docs = rows_of(spark, known[:5])
    scores = importance.resample(docs, spark.read.parquet(f"{folder}/labels.parquet"), mark=F.upper("text"))
    assert {(r["doc_id"], r["mark"]) for r in scores.collect()} == {(i, t.upper()) for i, t in known[:5]}


def plain_kept(rows, n=5, percent=80):
    """Of each component of near copies the row with the smallest id, null last; wordless rows all stay."""
    def grams(t):
        ws = (t or "").lower().split()
        return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()

    sets = [grams(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [b if p == a else p for p in part]
    groups = {}
    for i, p in enumerate(part):
        groups.setdefault(p, []).append(i)
    return groups, sets


def test_near_copies_keep_one_row_of_each_group(spark):
    base = text_of([f"w{i}" for i in range(300)], 1, 120).split()
    near = [" ".join(base[:k] + ["x"] + base[k:]) for k in (20, 60, 100)]
    clean = [text_of([f"v{i}" for i in range(300)], s, 80) for s in range(5)]
    rows = [
        (None, " ".join(base)), (None, near[0]), (7, near[1]), (8, near[2]), (8, clean[0]), (8, clean[1]), (None, clean[2]), (None, clean[3]),
        (11, clean[4]), (11, clean[4]), (11, clean[4].upper()), (12, "one two"), (13, "One  two"), (None, "one two"), (14, None), (14, None),
        (None, ""), (15, " \n "), (None, None),
    ]
    for schema in (SCHEMA, CLASHING):
        docs = rows_of(spark, rows, schema)
        kept = ngram_join.drop_near_duplicates(docs)
        assert kept.schema == docs.schema
        left = texts(kept)
        groups, sets = plain_kept(rows)
        assert len(left) == sum(1 if sets[g[0]] else len(g) for g in groups.values())
        for group in groups.values():
            ids = [rows[i][0] for i in group]
            if sets[group[0]]:
                stays = min((i for i in ids if i is not None), default=None)
                assert sum((i, t) in [rows[k] for k in group] for i, t in left if i == stays) >= 1
        for row in ((7, near[1]), (8, clean[0]), (8, clean[1]), (None, clean[2]), (None, clean[3])):
            assert row in left
        assert (None, near[0]) not in left and (8, near[2]) not in left and sum(1 for r in left if r[0] == 11) == 1
    assert ngram_join.drop_near_duplicates(docs.limit(0)).collect() == []


def test_stages_on_empty_and_clashing_tables(spark, labelled):
    folder, known = labelled
    for docs in (rows_of(spark, known[:3]).limit(0), rows_of(spark, [*known[:40], (None, None), (3, "")], CLASHING)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_pipeline_run(spark):
    """Every stage's rows are the next one's; what is packed is what the stages keep."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"by-hand-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    by_hand = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(key).collect())) == sorted(map(tuple, by_hand.select(key).collect()))


# -- the SQL of the registered queries


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_url_sql_on_addresses_with_queries(spark, tmp_path):
    """The SQL knows the same page addresses as the code: queries count, but for tracking parameters."""
    urls = [
        "http://x.example.com/de/?q=1", "http://x.example.com/de", "https://www.x.example.com/de/", "http://y.example.com/de?utm_source=a",
        "http://y.example.com/de", "http://www.y.example.com/DE/", "http://a.org/fr/1?x=1&&gclid=7#top", "http://www.a.org/fr/1/?x=1", "ftp://a.org/fr/1",
        "http://B.net/?a=1&b=2", "http://www.b.net/?b=2&a=1", "http://www.example.net/en/?p", "http://example.net/en", "http://c.com/?", "http://c.com",
        "c.com/de", None, "", "http://", "http:///de", "http://d.com?fbclid=1#x://y", "http://www.d.com#", "http://e.com/a?u=http://f.net/b",
    ]
    rows = [(i, u, "") for i, u in enumerate(urls + urls[:3])]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    cursor = con.execute(STATEMENTS["op1_url_filters"])
    columns = [d[0] for d in cursor.description]
    got = [tuple(r) for r in entrypoint.queries()["op1_url_filters"](spark, str(tmp_path)).select(columns).collect()]
    assert sorted(got, key=repr) == sorted(cursor.fetchall(), key=repr)
    verdicts = {r[0]: r[-1] for r in (tuple(x) for x in got)}
    assert len(verdicts) == len(rows)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_registered_query(spark, database, name):
    cursor = database.execute(STATEMENTS[name])
    columns = [d[0] for d in cursor.description]
    plain = lambda row: tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)
    got = [plain(r) for r in entrypoint.queries()[name](spark, SF).select(columns).collect()]
    assert sorted(got, key=repr) == sorted(map(plain, cursor.fetchall()), key=repr)
