"""Tables of merged parts: bounded reads, batches that come again, stops at every step, and the streams that keep them."""

import os
import time as clock
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratus import folders
from stratus.plans.marts import condition_parts, merge_parts, together
from stratus.session import work_path
from stratus.streaming import holding, jobs, parts, running

START = datetime(2024, 1, 1)
SAMPLE = "name string, event_id bigint, ts timestamp_ntz, value double"


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def batch_of(spark, number):
    """Key ``number % 3`` gets ``2 ** number``, key 9 gets 1."""
    return spark.createDataFrame([(number % 3, 2**number), (9, 1)], "k long, n long")


def expected(numbers):
    totals = {}
    for i in numbers:
        totals[i % 3] = totals.get(i % 3, 0) + 2**i
        totals[9] = totals.get(9, 0) + 1
    return totals


def opened(spark, path):
    return parts.PartTable(spark, path, batch_of(spark, 0).schema, summed)


def content(table):
    return {r.k: r.n for r in table.rows().collect()}


def test_levels_bound_what_a_read_opens(spark, monkeypatch):
    monkeypatch.setattr(parts, "FANOUT", 3)
    path = work_path(spark, "levels")
    for i in range(20):
        assert opened(spark, path).commit(i, batch_of(spark, i))
        manifest = opened(spark, path).manifest()
        levels = [p.level for p in manifest.parts]
        assert all(levels.count(n) < 3 for n in levels)
        # On disk are those of this and the last manifest, and nothing else.
        assert len(folders.list_folder(spark, f"{path}/parts")) <= 2 * len(levels) + 3
        assert len(folders.list_folder(spark, f"{path}/manifests")) <= 3
    assert content(opened(spark, path)) == expected(range(20))
    assert max(levels) == 2 and len(levels) <= 6
    assert sum(f == "parquet" for f in [x.split(".")[-1] for x in os.listdir(path)]) == 0


def test_batches_that_come_again(spark):
    path = work_path(spark, "again")
    assert content(opened(spark, path)) == {}
    for i in (0, 1, 2):
        assert opened(spark, path).commit(i, batch_of(spark, i))
    assert not opened(spark, path).commit(2, batch_of(spark, 2)) and not opened(spark, path).commit(0, batch_of(spark, 0))
    assert opened(spark, path).commit("late", batch_of(spark, 3)) and not opened(spark, path).commit("late", batch_of(spark, 3))
    assert content(opened(spark, path)) == expected(range(4))


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["_write", "_publish", "_sweep"])
@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("call", [0, 1])
def test_a_stop_at_any_step_leaves_a_whole_table(spark, monkeypatch, step, when, call):
    """The commit that also merges is stopped at each of its steps, then sent again to a table opened anew."""
    monkeypatch.setattr(parts, "FANOUT", 3)
    path = work_path(spark, "stopped")
    for i in range(2):
        opened(spark, path).commit(i, batch_of(spark, i))
    table, seen, whole = opened(spark, path), [], getattr(parts.PartTable, step)

    def stopping(self, *args):
        seen.append(1)
        if len(seen) == call + 1:
            if when == "before":
                raise Stop
            whole(self, *args)
            raise Stop
        return whole(self, *args)

    with monkeypatch.context() as m:
        m.setattr(parts.PartTable, step, stopping)
        if step == "_sweep" and call == 1:
            table.commit(2, batch_of(spark, 2))
        else:
            with pytest.raises(Stop):
                table.commit(2, batch_of(spark, 2))
    assert content(opened(spark, path)) in (expected(range(2)), expected(range(3)))
    opened(spark, path).commit(2, batch_of(spark, 2))
    assert content(opened(spark, path)) == expected(range(3))
    opened(spark, path).commit(3, batch_of(spark, 3))
    assert content(opened(spark, path)) == expected(range(4))
    kept = {p.folder for p in opened(spark, path).manifest().parts}
    assert kept <= set(folders.list_folder(spark, f"{path}/parts")) and len(kept) <= 2


def test_newest_rows_by_column(spark):
    rows = spark.createDataFrame([("a", 1, None, 5), ("a", 2, "x", 6), ("b", 3, None, 7), ("b", 2, "y", None)], "k string, o long, s string, v long")
    got = parts.newest_by(["k"], "o")(rows).collect()
    assert sorted((r.k, r.s, r.v, r.o) for r in got) == [("a", "x", 6, 2), ("b", None, 7, 3)]


# -- streams


def landed(spark, name, batches, schema=SAMPLE):
    """Files that arrive in the given order, one per micro-batch."""
    path = work_path(spark, name)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        clock.sleep(1.1)  # files are taken in the order of their times
    return path, running.stream_table(spark, path, spark.createDataFrame([], schema).schema, 1)


def newest_first(rows, size):
    return [rows[i : i + size] for i in range(0, len(rows), size)][::-1]


def stateless(path):
    """Whether no query below the checkpoint kept any state."""
    return not any(d == "state" for _, names, _ in os.walk(path) for d in names)


def test_repeats_against_the_days_they_touch(spark):
    rows = [("a", i, START + timedelta(hours=7 * i), float(i)) for i in range(40)] + [(None, None, None, None), ("x", 99, None, 1.0)]
    again = [rows[i] for i in (0, 5, 5, 39, 40, 41)]
    path, stream = landed(spark, "new", [*newest_first(rows, 14), again, rows[:20]])
    out = work_path(spark, "new-out")
    table = running.append_new_to(stream, f"{out}/table", f"{out}/checkpoint", "event_id", "ts")
    got = sorted((tuple(r) for r in table.rows().drop("day").collect()), key=repr)
    assert got == sorted(rows, key=repr) and stateless(f"{out}/checkpoint")
    # Run again: nothing new has come; and a batch that is sent again counts once.
    assert running.append_new_to(stream, f"{out}/table", f"{out}/checkpoint", "event_id", "ts").rows().count() == len(rows)
    assert not table.commit(0, table.parts())


def test_only_touched_days_are_read(spark):
    rows = [("a", i, START + timedelta(days=i), 1.0) for i in range(6)]
    _, stream = landed(spark, "days", [rows])
    out = work_path(spark, "days-out")
    table = running.append_new_to(stream, f"{out}/table", f"{out}/checkpoint", "event_id", "ts")
    plan = table.parts().where(F.col("day").isin(START.date()))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


@pytest.mark.parametrize("window,step", [(300, 60), (60, 60), (600, 120)])
def test_sliding_windows_from_panes(spark, window, step):
    rows = [
        (f"s{i % 2}", i, START + timedelta(seconds=(i * i * 7) % 9_000 + (2_000 if i % 5 else 0)), None if i % 11 == 0 else float(i))
        for i in range(120)
    ]
    rows.append(("s0", 999, None, 1.0))
    path, stream = landed(spark, "panes", newest_first(rows, 50))
    out = work_path(spark, "panes-out")
    table = running.merge_to(
        stream, f"{out}/table", f"{out}/checkpoint", lambda b: jobs.panes(b, ["name"], "value", step_seconds=step), jobs.merged_panes(["name"])
    )
    assert stateless(f"{out}/checkpoint")
    got = {(r.name, r.window_start, r.window_end): (r.total, r.samples) for r in jobs.sliding_from_panes(table.rows(), ["name"], window, step).collect()}
    wanted = {}
    for name, _, ts, v in rows[:-1]:
        pane = int((ts - START).total_seconds()) // step
        for first in range(pane - window // step + 1, pane + 1):
            at = START + timedelta(seconds=first * step)
            total, n = wanted.get((name, at, at + timedelta(seconds=window)), (None, 0))
            wanted[(name, at, at + timedelta(seconds=window))] = (total if v is None else (total or 0) + v, n + (v is not None))
    assert got == wanted
    plan = jobs.panes(spark.read.parquet(path), ["name"], "value")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_panes_have_to_fit(spark):
    with pytest.raises(ValueError):
        jobs.sliding_from_panes(spark.createDataFrame([], "name string, pane long, total double, samples long"), ["name"], 100, 60)


def test_daily_parts_and_ticks_without_state(spark):
    schema = """city_name string, weather_condition string, temperature_celsius double, feels_like_celsius double,
      humidity_percent bigint, pressure_hpa bigint, wind_speed_ms double, measured_at timestamp_ntz"""
    rows = [
        (f"c{i % 2}", "Rain" if i % 3 else "Fog", float(i % 11), float(i % 5), i % 100, 1000 + i % 7, float(i % 4), START + timedelta(minutes=97 * i))
        for i in range(120)
    ]
    path, stream = landed(spark, "daily", newest_first(rows, 40), schema)
    with_day = lambda df: df.withColumn("date_day", F.to_date("measured_at").cast("timestamp_ntz"))
    got = merge_parts(running.finish_merge(with_day(stream), "daily", condition_parts, together))
    wanted = merge_parts(condition_parts(with_day(spark.read.parquet(path))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.select(got.columns).collect()))

    samples = [("a", 10 * i + k, START + timedelta(minutes=i, seconds=20 * k), float((i // 4) % 2 if k == 2 else 0)) for i in range(30) for k in range(3)]
    path, stream = landed(spark, "ticks", newest_first(samples, 30))
    part = lambda df: holding.tick_parts(df, ["name"], F.col("value") > 0, 60)
    kept = running.finish_merge(stream, "ticks", part, parts.newest_by(["name", "tick"], "newest"))
    batch = holding.evaluated_ticks(spark.read.parquet(path), ["name"], F.col("value") > 0, 60)
    assert sorted(map(tuple, kept.drop("newest").collect())) == sorted(map(tuple, batch.collect()))
