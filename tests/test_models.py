from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratus.operators import ranking
from stratus.operators.ranking import Rank, global_ranks
from stratus.plans import adhoc, analytic, core, marts, medallion, staging
from stratus.session import work_path
from stratus.sources.landing import CURRENT_PAYLOAD, FORECAST_PAYLOAD, parse_payload

OBS = """row_id string, city_name string, country_code string, temperature_celsius double, feels_like_celsius double,
  humidity_percent bigint, pressure_hpa bigint, wind_speed_ms double, weather_condition string,
  weather_description string, latitude double, longitude double, measured_at timestamp_ntz"""


def day(d, h=0):
    return datetime(2024, 1, d, h)


def obs(spark, *rows):
    """Rows as (city, condition, temperature, measured_at)."""
    data = [
        (str(i), c, "FR", t, t, 50, 1000, 3.0, w, None, 1.0 * i, 2.0, at) for i, (c, w, t, at) in enumerate(rows)
    ]
    return spark.createDataFrame(data, OBS)


def forecasts(spark, *rows):
    return obs(spark, *rows).withColumnRenamed("measured_at", "forecast_at")


def test_daily_summary_mixes_both_legs_and_settles_ties(spark):
    current = obs(
        spark, ("P", "Rain", 1.0, day(1, 3)), ("P", "Clear", 2.0, day(1, 9)), ("P", None, 3.0, day(1, 10)),
        ("P", None, 4.0, day(1, 11)), ("L", None, None, day(1)),
    )
    slots = forecasts(spark, ("P", "Rain", 9.0, day(2)), ("M", "Fog", 5.25, day(1)))
    daily = {(r.city_name, r.date_day): r for r in marts.weather_daily_summary(marts.union_sources(current, slots)).collect()}
    paris = daily["P", day(1)]
    assert paris.dominant_weather_condition == "Clear"  # as often as Rain, and smaller; NULL does not count
    assert (paris.avg_temperature_celsius, paris.observation_count) == (2.5, 4)
    assert daily["P", day(2)].max_temperature_celsius == 9.0
    assert daily["M", day(1)].avg_temperature_celsius == 5.3
    empty = daily["L", day(1)]
    assert (empty.dominant_weather_condition, empty.avg_temperature_celsius, empty.observation_count) == (None, None, 1)


def test_union_keeps_duplicates(spark):
    current = obs(spark, ("P", "Rain", 1.0, day(1)), ("P", "Rain", 1.0, day(1)))
    assert marts.union_sources(current, forecasts(spark, ("P", "Rain", 1.0, day(1)))).count() == 3


def test_dim_city_keeps_one_row_and_latest_keeps_ties(spark):
    df = obs(
        spark, ("P", "a", 1.0, day(1)), ("P", "b", 2.0, day(2)), ("P", "c", 3.0, day(2)), ("L", "d", 4.0, day(1)),
        ("N", "e", 5.0, None),
    )
    assert {(r.city_name, r.latitude) for r in core.dim_city(df).collect()} == {("P", 2.0), ("L", 3.0), ("N", 4.0)}
    latest = adhoc.latest_observations(df, "temperature_celsius").collect()
    assert sorted((r.city_name, r.temperature_celsius) for r in latest) == [("L", 4.0), ("P", 2.0), ("P", 3.0)]


def test_plans_cut_down_hot_cities_before_the_shuffle(spark):
    df = obs(spark, ("P", "a", 1.0, day(1)))
    plan = adhoc.latest_observations(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    plan = core.dim_city(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.rstrip().split("Exchange hashpartitioning(city_name")[-1].count("SortAggregate") == 0


def test_city_metrics_takes_each_maximum_on_its_own(spark):
    df = obs(spark, ("P", "a", 1.0, day(1)), ("P", "b", None, day(3))).withColumn(
        "country_code", F.when(F.col("row_id") == "0", "FR").otherwise("BE")
    )
    row = marts.city_weather_metrics(df).first()
    assert (row.country_code, row.latitude, row.total_observations) == ("FR", 1.0, 2)
    assert (row.avg_temperature_celsius, row.first_observation, row.last_observation) == (1.0, day(1), day(3))


def ranked(values, descending):
    """rank() with NULL as the largest value."""
    key = lambda v: float("inf") if v is None else v
    return [1 + sum((key(o) > key(v)) if descending else (key(o) < key(v)) for o in values) for v in values]


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 2.0, None, -5.5, None, 3.0],
    [7.0],
    [None, None],
    [4.0, 4.0, 4.0],
    [float(i % 37) * 1.7 for i in range(500)],
    [1e-9 * i for i in range(40)] + [1e12],
])
def test_global_ranks_equal_rank_over_everything(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = global_ranks(df, "id", (Rank("down", "v"), Rank("up", "v", descending=False))).orderBy("id").collect()
    assert [r.down for r in got] == ranked(values, True)
    assert [r.up for r in got] == ranked(values, False)


def test_an_outlier_makes_no_bucket_large(spark):
    """Values close together and one huge: each of 16 buckets holds at most twice its share of the distinct values."""
    long = spark.range(20_000).selectExpr("'m' AS measure", "if(id = 7, 1e300, id % 8000 * 1e-9) AS value")
    sizes = []
    whole = ranking.materialise

    def seen(df, name):
        kept = whole(df, name)
        sizes.extend(r["count"] for r in kept.groupBy("bucket").count().collect())
        return kept

    ranking.materialise = seen
    try:
        got = ranking.value_positions(long, 16)
        last = got.where("value = 1e300").first()
    finally:
        ranking.materialise = whole
    assert (last.below, last.above) == (19_999, 0) and got.count() == 8_001
    assert len(sizes) == 16 and max(sizes) <= 2 * 8_001 / 16


def test_positions_number_all_rows(spark):
    rows = spark.range(5_000).selectExpr("id", "if(id % 4 = 0, null, id % 7) AS v").repartition(6)
    got = ranking.row_positions(rows, F.col("v").desc_nulls_last(), F.asc("id")).collect()
    wanted = sorted(((i, None if i % 4 == 0 else i % 7) for i in range(5_000)), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == [r[0] for r in wanted]
    assert ranking.row_positions(rows.limit(0), F.asc("id")).collect() == []


def test_single_city_ranks_first_with_no_difference(spark):
    metrics = marts.city_weather_metrics(obs(spark, ("P", "a", 3.0, day(1))))
    row = analytic.city_comparison_ranking(metrics).first()
    assert (row.temp_rank_warmest, row.temp_rank_coldest, row.wind_rank, row.temp_vs_mean) == (1, 1, 1, 0.0)


def test_trend_counts_rows_not_days(spark):
    days = [1, 2, 3, 10, 11, 12, 13, 20]
    df = spark.createDataFrame(
        [("P", day(d), float(i), 50.0, 1.0, 1) for i, d in enumerate(days)],
        "city_name string, date_day timestamp_ntz, avg_temperature_celsius double, avg_humidity_percent double,"
        " avg_wind_speed_ms double, observation_count int",
    )
    got = analytic.weather_trend_analysis(df).orderBy("date_day").collect()
    assert [r.temp_7d_moving_avg for r in got] == [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0]
    assert [r.temp_day_over_day_change for r in got] == [None] + [1.0] * 7


def test_reports(spark):
    df = obs(
        spark, ("Paris", "a", 15.0, day(1)), ("Paris", "a", 18.0, day(2)), ("Lyon", "a", 12.0, day(1)),
        ("Lyon", "a", 14.0, day(1, 5)), ("Nice", "a", 99.0, day(1)),
    )
    assert [(r.city_name, r.avg_temp_c) for r in adhoc.top_hottest_cities(df, 2).collect()] == [("Nice", 99.0), ("Paris", 16.5)]
    trend = adhoc.daily_temperature_trend(df, "Paris", days=1).collect()
    assert [(str(r.date_day), r.avg_temp) for r in trend] == [("2024-01-02", 18.0)]
    stats = {r.city_name: r.temp_stddev for r in adhoc.weather_summary_stats(df).collect()}
    assert stats == {"Paris": 2.12, "Lyon": 1.41, "Nice": None}
    compared = {r.city_name: r.temp_vs_mean for r in adhoc.cross_city_comparison(df).collect()}
    assert compared == {"Paris": -26.3, "Lyon": -29.8, "Nice": 56.2}
    assert [r.city_name for r in adhoc.implausible_temperatures(df).collect()] == ["Nice"]
    injected = adhoc.daily_temperature_trend(df, "x' OR '1'='1")
    assert injected.count() == 0


CURRENT = '{"name":"Paris","sys":{"country":"FR"},"main":{"temp":15.2,"humidity":65},"weather":[],"dt":1709827200}'
FORECAST = (
    '{"city":{"name":"Paris","country":"FR"},"cnt":2,"list":[{"dt":1709827200,"main":{"temp":1.5},'
    '"weather":[{"main":"Rain","description":"light rain"}],"pop":0.5},{"dt":1709838000,"main":{"temp":2.5}}]}'
)


def payloads(spark, schema, *texts):
    df = spark.createDataFrame([(t, "l", str(i)) for i, t in enumerate(texts)], "raw string, load_id string, row_id string")
    return parse_payload(df, "raw", schema)


def test_current_staging(spark):
    row = staging.stg_weather_current(payloads(spark, CURRENT_PAYLOAD, CURRENT)).first()
    assert (row.city_name, row.country_code, row.temperature_celsius, row.humidity_percent) == ("Paris", "FR", 15.2, 65)
    assert (row.weather_condition, row.latitude, row.measured_at) == (None, None, datetime(2024, 3, 7, 16))
    assert len(row) == 17


def test_forecast_staging_drops_parents_without_slots_and_both_forms_agree(spark):
    raw = payloads(spark, FORECAST_PAYLOAD, FORECAST, '{"city":{"name":"Lyon"},"list":[]}', '{"city":{"name":"Nice"}}')
    from stratus.sources.shaping import unnest_child

    at = "2024-04-01 00:00:00"
    joined = staging.stg_weather_forecast(raw.drop("list"), unnest_child(raw, "list", "row_id"), at)
    exploded = staging.stg_forecast_from_payload(raw, at)
    assert joined.columns == exploded.columns and len(joined.columns) == 17
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, exploded.collect()))
    assert [(r.city_name, r.weather_condition, r.temperature_celsius) for r in exploded.orderBy("forecast_at").collect()] == [
        ("Paris", "Rain", 1.5), ("Paris", None, 2.5)]


def test_layers_are_rebuilt_in_place(spark):
    current = obs(spark, ("P", "Rain", 1.0, day(1)), ("L", "Fog", 2.0, day(1))).withColumns({
        c: F.lit(None).cast("string") for c in ("cloud_coverage_percent", "visibility_meters", "load_id", "loaded_at")
    })
    slots = forecasts(spark, ("P", "Rain", 9.0, day(2)))
    root = work_path(spark, "layers")
    for _ in range(2):
        built = medallion.build_layers(spark, current, slots, root)
    assert {m.name: built[m.name].count() for m in medallion.MODELS} == {
        "dim_city": 2, "fct_weather_observation": 2, "weather_daily_summary": 3, "city_weather_metrics": 2,
        "city_comparison_ranking": 2, "weather_trend_analysis": 3,
    }
    assert spark.sql("SELECT city_name FROM city_comparison_ranking WHERE temp_rank_warmest = 1").first()[0] == "L"
