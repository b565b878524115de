import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratus.operators import profiles, quality
from stratus.operators.quality import SUITES, Check, Suite
from stratus.workload import quality as workload

SCHEMA = "city_name string, temperature_celsius double, humidity_percent double, wind_speed_ms double, measured_at timestamp_ntz"
AT = datetime(2025, 1, 1)
VALID = [("Paris", 15.2, 65.0, 3.5, AT), ("Lyon", 12.8, 72.0, 2.1, AT), ("Marseille", 18.5, 55.0, 5.8, AT)]
INVALID = [("Paris", 15.2, 65.0, 3.5, AT), (None, 999.0, 150.0, 2.1, AT), ("Marseille", 18.5, -10.0, 5.8, AT)]


def outcome(spark, rows, *checks, now="2025-01-02 00:00:00"):
    df = spark.createDataFrame(rows, SCHEMA)
    found = quality.run_checks(df, "t", checks, now).collect()
    by_label = {(r["check"], r["column"]): (r.success, r.failures) for r in found}
    return [by_label[c.label, c.column] for c in checks]


RANGE = Check("between", "temperature_celsius", -60.0, 60.0)
HUMID = Check("between", "humidity_percent", 0.0, 100.0)
CITY = Check("not_null", "city_name")


def test_valid_and_invalid_frames(spark):
    assert outcome(spark, VALID, RANGE, HUMID, CITY) == [(True, 0)] * 3
    assert outcome(spark, INVALID, RANGE, HUMID, CITY) == [(False, 1), (False, 2), (False, 1)]


def test_bounds_are_inclusive_and_one_sided(spark):
    rows = [("a", -60.0, 100.0, 0.0, AT), ("b", 60.0, None, 1.0, AT)]
    assert outcome(spark, rows, RANGE, HUMID, Check("between", "wind_speed_ms", low=1)) == [(True, 0), (True, 0), (False, 1)]


def test_value_range_fails_on_either_side(spark):
    rows = [("a", -91.0, 1.0, 1.0, AT), ("b", 61.0, 1.0, 1.0, AT), ("c", None, 1.0, 1.0, AT)]
    assert outcome(spark, rows, Check("value_range", "temperature_celsius", -90, 60)) == [(False, 2)]


def test_null_rate_at_the_threshold_passes(spark):
    rows = [(None if i == 0 else "a", 1.0, 1.0, 1.0, AT) for i in range(20)]
    assert outcome(spark, rows, Check("not_null_rate", "city_name")) == [(True, 0)]
    assert outcome(spark, rows[:19], Check("not_null_rate", "city_name")) == [(False, 1)]


def test_empty_table(spark):
    checks = (Check("not_null_rate", "city_name"), Check("freshness_hours", "measured_at"), Check("row_count"), RANGE)
    assert outcome(spark, [], *checks) == [(True, 0), (False, 1), (False, 1), (True, 0)]


def test_freshness_is_strict(spark):
    check = Check("freshness_hours", "measured_at", limit=24)
    assert outcome(spark, VALID, check, now="2025-01-02 00:00:00") == [(True, 0)]
    assert outcome(spark, VALID, check, now="2025-01-02 00:00:00.000001") == [(False, 1)]


def test_unique_counts_repeated_values_without_nulls(spark):
    rows = [(c, 1.0, 1.0, 1.0, AT) for c in ("a", "a", "a", "b", "b", "c", None, None)]
    assert outcome(spark, rows, Check("unique", "city_name")) == [(False, 2)]


def test_missing_column_gives_failed_rows(spark):
    assert outcome(spark, VALID, Check("column_exists", "nope"), Check("not_null", "nope"), CITY) == [
        (False, None), (False, None), (True, 0)]


def test_one_scan_for_all_folded_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(VALID, SCHEMA).write.parquet(path)
    checks = [c for s in SUITES if s.table == "stg_weather_current" for c in s.checks]
    plan = quality.run_checks(spark.read.parquet(path), "t", checks, "2025-01-02")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def tables(spark, rows):
    current = spark.createDataFrame(rows, SCHEMA)
    slots = current.withColumnRenamed("measured_at", "forecast_at")
    daily = spark.createDataFrame([("Paris", AT, 1.0, 1)], "city_name string, date_day timestamp_ntz, avg_temperature_celsius double, observation_count bigint")
    metrics = spark.createDataFrame([("Paris", 1), ("Lyon", 2)], "city_name string, total_observations bigint")
    return {"stg_weather_current": current, "stg_weather_forecast": slots, "weather_daily_summary": daily, "city_weather_metrics": metrics}


def test_suites(spark):
    results = quality.run_suites(tables(spark, VALID), now="2025-01-02")
    verdicts = {r.suite: (r.success, r.checks) for r in quality.suite_verdicts(results).collect()}
    assert all(ok for ok, _ in verdicts.values())
    sizes = {s.name: len(s.checks) for s in SUITES}
    assert {name: n for name, (_, n) in verdicts.items()} == sizes
    assert [sizes[n] for n in ("staging_current_weather", "staging_weather_forecast", "analytics_daily_summary")] == [12, 7, 6]
    assert [n for name, n in sizes.items() if name.startswith("cli_")] == [8, 5, 5, 4]
    assert sum(n for name, n in sizes.items() if name.startswith("scan_")) == 19
    assert quality.all_passed(results).first()[0] is True


def test_suites_fail_per_suite_and_layer(spark):
    broken = tables(spark, INVALID)
    del broken["weather_daily_summary"]
    results = quality.run_suites(broken, now="2025-01-02")
    failed = {r.suite for r in quality.suite_verdicts(results).where("NOT success").collect()}
    assert {"staging_current_weather", "scan_stg_weather_current", "analytics_daily_summary"} <= failed
    assert "cli_city_weather_metrics" not in failed
    assert quality.all_passed(results).first()[0] is False
    mart = quality.run_suites(tables(spark, INVALID), "mart", now="2025-01-02")
    assert quality.all_passed(mart).first()[0] is True
    with pytest.raises(ValueError):
        quality.run_suites(broken, "gold")


def executions(spark, work):
    """The executed plans of all queries that ``work`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    out = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = store.executionsList()
    return out, [found.apply(i).physicalPlanDescription() for i in range(before, found.size())]


def test_suites_are_gathered_while_a_table_is_written(spark, tmp_path):
    """Results equal those of a scan, and nothing but the unique column is read again."""
    suites = (
        Suite("mine", "staging", "t", (
            Check("row_count", limit=1), Check("not_null", "city_name"), RANGE, Check("between", "humidity_percent", 0, 100),
            Check("not_null_rate", "city_name", limit=0.1), Check("freshness_hours", "measured_at", limit=24),
            Check("unique", "city_name"), Check("not_null", "gone"),
        )),
        Suite("again", "staging", "t", (Check("row_count", limit=1), Check("unique", "city_name"))),
        Suite("other", "staging", "u", (Check("row_count", limit=1),)),
    )
    rows = spark.createDataFrame(INVALID + INVALID, SCHEMA)
    for name, frame in (("rows", rows), ("none", rows.limit(0))):
        checked = quality.WhileStoring(frame, "t", suites, AT)
        path = str(tmp_path / name)
        checked.frame.write.parquet(path)
        stored = spark.read.parquet(path)
        got, plans = executions(spark, lambda c=checked, s=stored: c.results(s).collect())
        wanted = quality.run_suites({"t": stored}, suites=suites[:2], now=AT)
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, wanted.select(*got[0].asDict()).collect()), key=repr)
        read = [line for plan in plans for line in plan.splitlines() if line.startswith("ReadSchema")]
        assert set(read) == {"ReadSchema: struct<city_name:string>"}
    assert quality.WhileStoring(rows, "unknown", suites).results(rows) is None


def test_schema_changes(spark):
    before = spark.createDataFrame([("a", "int"), ("b", "string"), ("c", "int")], "column string, type string")
    after = spark.createDataFrame([("a", "int"), ("b", "bigint"), ("d", "int")], "column string, type string")
    got = {(r["column"], r.change) for r in quality.schema_changes(before, after).collect()}
    assert got == {("b", "type_changed"), ("c", "removed"), ("d", "added")}
    frame = spark.createDataFrame(VALID, SCHEMA)
    assert quality.schema_changes(quality.schema_frame(frame), quality.schema_frame(frame.drop("city_name"))).first().change == "removed"


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "b")], "n int, s string")
    got = {r["column"]: r for r in quality.column_profile(df, ["n", "s"], exact_distinct=["s"]).collect()}
    assert (got["n"].row_count, got["n"].null_count, got["n"].mean, got["n"].distinct_estimate) == (3, 1, 2.0, 2)
    assert (got["s"].distinct_count, got["s"].min, got["n"].distinct_count) == (2, None, None)
    assert quality.sample_rows(df, 2).count() == 2


def test_profiles_merge_like_one_scan(spark):
    """Parts of loads, merged in any grouping, give what one profile of all rows gives; estimates are within their errors."""
    rows = spark.range(30_000).selectExpr(
        "id AS n", "if(id % 3 = 0, null, id % 700) AS v", "if(id % 1000 = 1, double('NaN'), double(id)) AS d", "concat('t', id % 50) AS s",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts", "cast(null AS string) AS nothing", "id % 2 = 0 AS b",
        "cast(id AS decimal(12, 2)) AS money", "date_add(date'2024-01-01', cast(id % 90 AS int)) AS day", "cast(null AS int) AS void",
    )
    columns = rows.columns
    loads = [profiles.profile_parts(rows.where(f"id % 4 = {k}".replace("id", "n")), columns) for k in range(4)]
    empty = profiles.profile_parts(rows.limit(0), columns)
    pair = profiles.merge_profiles(loads[0].unionByName(loads[1]))
    merged = profiles.merge_profiles(pair.unionByName(loads[2]).unionByName(loads[3]).unionByName(empty))
    got = {r["column"]: r for r in profiles.profile_report(merged).collect()}
    whole = {r["column"]: r for r in profiles.profile_report(profiles.profile_parts(rows, columns)).collect()}
    same = [c for c in got["n"].asDict() if c not in ("mean", "distinct_estimate", "p25", "p50", "p75")]
    assert all([got[c][k] for k in same] == [whole[c][k] for k in same] or c == "d" for c in columns)
    assert (got["n"].row_count, got["v"].null_count, got["n"]["min"], got["n"]["max"]) == (30_000, 10_000, 0.0, 29_999.0)
    assert (got["s"].min_text, got["s"].max_text, got["s"]["min"]) == ("t0", "t9", None)
    assert (got["ts"].min_text, got["day"].max_text, got["b"].min_text) == ("2024-01-01 00:00:00", "2024-03-30", "false")
    assert got["n"].mean == pytest.approx(14_999.5) and got["money"]["max"] == 29_999.0
    assert got["d"].mean == pytest.approx(sum(i for i in range(30_000) if i % 1000 != 1) / 29_970) and got["d"]["max"] != got["d"]["max"]
    for c, exact in (("n", 30_000), ("v", 700 - 0), ("s", 50), ("ts", 30_000), ("day", 90), ("b", 2), ("money", 30_000)):
        assert abs(got[c].distinct_estimate - exact) <= exact * profiles.DISTINCT_ERROR
    for share in (25, 50, 75):
        assert abs(got["n"][f"p{share}"] / 30_000 - share / 100) <= profiles.RANK_ERROR
    assert (got["nothing"].min_text, got["void"].p50, got["void"].distinct_estimate, got["void"].mean) == (None, None, 0, None)


def test_ranks_are_checked_without_holding_values(spark):
    """The verdict on a rank equals that of exact percentiles, and the registered check gathers no values in a task."""
    rng, rows, shares = random.Random(3), [], ((0.48, 0.52), (0.25, 0.75))
    for k in range(300):
        n = rng.choice((0, 1, 2, 3, 7, 26, 51))
        values = [rng.choice([None, float("nan"), -0.0, float("inf"), rng.randint(0, 9) / 2, rng.gauss(0, 9)]) for _ in range(n)]
        known = [v for v in values if v is not None]
        rows += [(k, rng.choice([None, 0.0, 2.25, *known, *known]), None)]
        rows += [(k, rows[-1][1], v) for v in values]
    df = spark.createDataFrame(rows, "k int, point double, v double")
    exact = [F.percentile("v", F.array(*[F.lit(x) for x in s])).alias(f"e{i}") for i, s in enumerate(shares)]
    verdicts = df.groupBy("k", "point").agg(profiles.rank_around(F.col("v"), F.col("point")).alias("a"), *exact).select(*[
        F.array(profiles.within_ranks(F.col("a"), F.col("point"), *s), F.col("point").between(F.col(f"e{i}")[0], F.col(f"e{i}")[1]))
        for i, s in enumerate(shares)
    ]).collect()
    assert len(verdicts) == 300
    assert all(got == wanted for r in verdicts for got, wanted in r)
    assert all({got for got, _ in of} == {None, True, False} for of in zip(*verdicts))
    plan = workload.profile_by_load(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan


def test_custom_suite(spark):
    suite = Suite("mine", "staging", "stg_weather_current", (RANGE,))
    results = quality.run_suites(tables(spark, INVALID), suites=(suite,))
    assert [(r.suite, r.success, r.failures) for r in results.collect()] == [("mine", False, 1)]
