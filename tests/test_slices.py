"""Order-dependent operators against plain Python, with series cut into many slices."""

from datetime import datetime, timedelta
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.operators import counters, sustained
from stratus.operators.slices import row_slices, run_lengths

START = datetime(2024, 1, 1)
SCHEMA = "name string, event_id bigint, ts timestamp_ntz, value bigint"

samples = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 600), st.one_of(st.none(), st.integers(0, 3))),
    min_size=1, max_size=60,
)


def frame(spark, data):
    rows = [(n, i, START + timedelta(seconds=s), v) for i, (n, s, v) in enumerate(data)]
    return spark.createDataFrame(rows, SCHEMA), sorted(rows, key=lambda r: (r[0], r[2], r[1]))


@settings(max_examples=15, deadline=None)
@given(samples, st.sampled_from([7, 60, 1000]))
def test_runs_do_not_depend_on_the_slice_width(spark, data, width):
    df, ordered = frame(spark, data)
    expected = []
    for (name, state), run in groupby(ordered, key=lambda r: (r[0], r[3])):
        run = list(run)
        expected.append((name, state, run[0][2], run[-1][2], len(run)))
    got = run_lengths(df, ["name"], "ts", F.col("value"), "event_id", width)
    got = [tuple(r) for r in got.select("name", "state", "started_at", "ended_at", "samples").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@settings(max_examples=10, deadline=None)
@given(samples, st.sampled_from([1, 3, 16]))
def test_runs_do_not_depend_on_the_number_of_row_slices(spark, data, slices):
    df, ordered = frame(spark, data)
    expected = []
    for (name, state), run in groupby(ordered, key=lambda r: (r[0], r[3])):
        run = list(run)
        expected.append((name, state, run[0][2], run[-1][2], len(run)))
    got = run_lengths(df, ["name"], "ts", F.col("value"), "event_id", slices=slices)
    got = [tuple(r) for r in got.select("name", "state", "started_at", "ended_at", "samples").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_row_slices_cut_a_hot_series_and_a_hot_day(spark):
    """One series with most rows, nearly all of them within one second of a year."""
    hot = spark.range(40_000).selectExpr(
        "if(id % 10 < 9, 'hot', concat('s', id % 50)) AS name",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, if(id % 100 = 0, id * 700, id / 40000)) AS ts", "id AS event_id",
    )
    sizes = [r["count"] for r in row_slices(hot, ["name", "ts", "event_id"], 20).groupBy("name", "_slice").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 20
    runs = run_lengths(hot, ["name"], "ts", F.lit(1), "event_id", slices=20).where("name = 'hot'").collect()
    assert [r.samples for r in runs] == [36_000]


def windows(ordered, share, window, step):
    """Direct evaluation: at every step end, pairs of neighbours inside the window."""
    out = set()
    for name, series in groupby([r for r in ordered if r[3] is not None], key=lambda r: r[0]):
        series = [((r[2] - START).total_seconds(), r[3]) for r in series]
        for t in {(int(s) // step + 1) * step for s, _ in series}:
            inside = [(s, v) for s, v in series if t - window <= s < t]
            total = sum(share(a[1], b[1]) for a, b in zip(inside, inside[1:]))
            out.add((name, START + timedelta(seconds=t), total if len(inside) > 1 else None, len(inside)))
    return out


@settings(max_examples=12, deadline=None)
@given(samples)
def test_increase_counts_resets_and_only_pairs_inside_the_window(spark, data):
    df, ordered = frame(spark, data)
    got = counters.counter_increase(df, ["name"], "value", window=120, step=30)
    got = {tuple(r) for r in got.select("name", "evaluated_at", "increase", "samples").collect()}
    assert got == windows(ordered, lambda p, v: v if v < p else v - p, 120, 30)


@settings(max_examples=8, deadline=None)
@given(samples)
def test_changes(spark, data):
    df, ordered = frame(spark, data)
    got = counters.value_changes(df, ["name"], "value", window=90, step=30)
    got = {tuple(r) for r in got.select("name", "evaluated_at", "changes", "samples").collect()}
    assert got == windows(ordered, lambda p, v: int(v != p), 90, 30)


@settings(max_examples=8, deadline=None)
@given(samples)
def test_increase_over_range(spark, data):
    df, ordered = frame(spark, data)
    expected = {}
    for name, series in groupby([r for r in ordered if r[3] is not None], key=lambda r: r[0]):
        v = [r[3] for r in series]
        expected[name] = sum(b if b < a else b - a for a, b in zip(v, v[1:]))
    got = counters.increase_over_range(df, ["name"], "value", step=45)
    assert {r.name: r.increase for r in got.collect()} == expected


def series(spark, *values, gap=60):
    rows = [("a", i, START + timedelta(seconds=gap * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def test_rate_single_flat_and_reset(spark):
    def last(*values):
        out = counters.counter_rate(series(spark, *values), ["name"], "value", window=300, step=60)
        return out.orderBy(F.desc("evaluated_at")).first().rate

    assert last(5) is None
    assert last(5, 5, 5) == 0.0
    assert last(5, 8, 2) == pytest.approx((3 + 2) / 300)


def test_window_must_be_whole_steps(spark):
    with pytest.raises(ValueError):
        counters.counter_increase(series(spark, 1, 2), ["name"], "value", window=100, step=60)


@pytest.mark.parametrize("values,hold,expected", [
    ((1, 1, 1, 1, 1, 1), 300, 1),  # exactly as long as asked
    ((1, 1, 1, 1, 1), 300, 0),  # one sample short
    ((1, 1, 1, 0, 1, 1), 180, 0),  # a gap in the condition
    ((1, None, 1), 120, 0),  # a missing value breaks it
    ((0, 1, 0), 0, 1),  # no hold: one sample is enough
])
def test_sustained(spark, values, hold, expected):
    df = series(spark, *values)
    found = sustained.sustained_condition(df, ["name"], F.col("value") == 1, hold, slice_seconds=100)
    assert found.count() == expected


def test_a_hot_series_is_spread_over_tasks(spark):
    """One series with all rows: slices, not the series, are the unit of the first shuffle."""
    df = spark.range(20_000).select(
        F.concat(F.lit("hot"), F.col("id") * 0).alias("name"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("value"),
    )
    runs = run_lengths(df, ["name"], "ts", F.col("value") < 6, "event_id", 86_400)
    assert runs.agg(F.sum("samples")).first()[0] == 20_000
    assert runs.where("state").agg(F.max("samples")).first()[0] == 6
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan.split("hashpartitioning(")[-1].split(")")[0]
