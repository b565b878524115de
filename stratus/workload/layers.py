"""Staging, core, mart and analytic models and the ad-hoc reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.functions import (
    day_start,
    elapsed_seconds,
    epoch_to_timestamp,
    error_prefix,
    object_key,
    pg_round,
    register_sql_functions,
    row_json,
    split_trim,
)
from stratus.plans import adhoc, analytic, core, marts, medallion, staging
from stratus.session import materialise, work_path
from stratus.sources.export import run_sql
from stratus.sources.landing import CURRENT_PAYLOAD, parse_payload
from stratus.workload import views
from stratus.workload.registry import query
from stratus.workload.views import rounded, with_views

COMBINED = """
combined AS (
  SELECT city_name, temperature_celsius, feels_like_celsius, humidity_percent, pressure_hpa, wind_speed_ms,
    weather_condition, date_trunc('day', measured_at) AS date_day FROM obs
  UNION ALL
  SELECT city_name, temperature_celsius, feels_like_celsius, humidity_percent, pressure_hpa, wind_speed_ms,
    weather_condition, date_trunc('day', forecast_at) AS date_day FROM fc
)
"""


def daily_sql(source: str) -> str:
    return f"""
condition_counts AS (
  SELECT city_name, date_day, weather_condition, row_number() OVER (
    PARTITION BY city_name, date_day ORDER BY count(*) DESC, weather_condition) AS place
  FROM {source} WHERE weather_condition IS NOT NULL GROUP BY city_name, date_day, weather_condition
),
daily AS (
  SELECT s.city_name, s.date_day,
    {rounded('avg(temperature_celsius)', 1)} AS avg_temperature_celsius,
    {rounded('min(temperature_celsius)', 1)} AS min_temperature_celsius,
    {rounded('max(temperature_celsius)', 1)} AS max_temperature_celsius,
    {rounded('avg(feels_like_celsius)', 1)} AS avg_feels_like_celsius,
    {rounded('avg(humidity_percent)', 1)} AS avg_humidity_percent,
    {rounded('avg(pressure_hpa)', 1)} AS avg_pressure_hpa,
    {rounded('avg(wind_speed_ms)', 2)} AS avg_wind_speed_ms,
    any_value(c.weather_condition) AS dominant_weather_condition,
    count(*) AS observation_count
  FROM {source} s JOIN condition_counts c
    ON s.city_name = c.city_name AND s.date_day = c.date_day AND c.place = 1
  GROUP BY s.city_name, s.date_day
)
"""


METRICS_SQL = f"""
city_metrics AS (
  SELECT city_name, max(country_code) AS country_code, max(latitude) AS latitude, max(longitude) AS longitude,
    count(*) AS total_observations,
    {rounded('avg(temperature_celsius)', 1)} AS avg_temperature_celsius,
    {rounded('min(temperature_celsius)', 1)} AS min_temperature_celsius,
    {rounded('max(temperature_celsius)', 1)} AS max_temperature_celsius,
    {rounded('avg(humidity_percent)', 1)} AS avg_humidity_percent,
    {rounded('avg(pressure_hpa)', 1)} AS avg_pressure_hpa,
    {rounded('avg(wind_speed_ms)', 2)} AS avg_wind_speed_ms,
    min(measured_at) AS first_observation, max(measured_at) AS last_observation
  FROM obs GROUP BY city_name
)
"""


def combined(spark, sf_dir):
    return marts.union_sources(views.obs(spark, sf_dir), views.fc(spark, sf_dir))


def daily(spark, sf_dir):
    return marts.weather_daily_summary(combined(spark, sf_dir))


def city_metrics(spark, sf_dir):
    return marts.city_weather_metrics(views.obs(spark, sf_dir))


# -- staging and core ---------------------------------------------------------

@query("stg_current", with_views("payloads", """
SELECT CASE WHEN f <> 3 THEN event_type END AS city_name, cast(NULL AS varchar) AS country_code,
  CASE WHEN f NOT IN (1, 4) THEN cast(cast(value AS decimal(12,2)) AS double) END AS temperature_celsius,
  CASE WHEN f NOT IN (0, 4, 7) THEN 60 END::bigint AS humidity_percent,
  CASE WHEN f <> 6 THEN cast(user_id % 30 AS double) END AS wind_speed_ms,
  CASE WHEN f <> 6 THEN event_type END AS weather_condition,
  1.5e0 AS latitude, cast(user_id % 90 AS double) AS longitude,
  CASE WHEN f <> 5 THEN date_trunc('second', ts) END AS measured_at,
  cast(event_id AS varchar) AS row_id, 'load-1' AS load_id
FROM (SELECT *, event_id % 10 AS f FROM events) WHERE f <> 2
"""))
def stg_current(spark, sf_dir):
    """Landed JSON text through parsing and the staging projection; text that is not JSON stays out."""
    landed = views.payloads(spark, sf_dir).where(F.try_parse_json("raw_json").isNotNull()).select(
        "raw_json", F.col("event_id").cast("string").alias("row_id"), F.lit("load-1").alias("load_id")
    )
    staged = staging.stg_weather_current(parse_payload(landed, "raw_json", CURRENT_PAYLOAD), views.LOADED_AT)
    return staged.select(
        "city_name", "country_code", "temperature_celsius", "humidity_percent", "wind_speed_ms",
        "weather_condition", "latitude", "longitude", F.col("measured_at").cast("timestamp_ntz").alias("measured_at"),
        "row_id", "load_id",
    )


@query("stg_forecast", """
SELECT 'city_' || cast(o_custkey % 20 AS varchar) AS city_name, 'K' || cast(o_custkey % 7 AS varchar) AS country_code,
  cast(o_custkey % 20 AS double) * 1.5e0 AS latitude, cast(o_custkey % 20 AS double) AS longitude,
  l_extendedprice / 1000 AS temperature_celsius, l_extendedprice / 1000 - 2.0e0 AS feels_like_celsius,
  cast(l_quantity AS bigint) AS humidity_percent, cast(l_linenumber + 1000 AS bigint) AS pressure_hpa,
  cast(l_linenumber AS double) AS wind_speed_ms, l_returnflag AS weather_condition,
  l_linestatus AS weather_description, cast(l_quantity AS bigint) AS cloud_coverage_percent,
  l_discount AS precipitation_probability,
  cast(DATE '2024-01-01' + cast(dayofyear(l_shipdate) % 30 AS int) AS timestamp) AS forecast_at,
  'load-1' AS load_id, cast(l_orderkey AS varchar) || '/' || cast(l_linenumber AS varchar) AS row_id,
  TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def stg_forecast(spark, sf_dir):
    staged = staging.stg_weather_forecast(
        views.forecast_parents(spark, sf_dir), views.forecast_children(spark, sf_dir), views.LOADED_AT
    )
    return staged.withColumn("forecast_at", F.col("forecast_at").cast("timestamp_ntz"))


@query("epoch_to_timestamp", """
SELECT event_id, date_trunc('second', ts) AS measured_at FROM events
""")
def epoch_timestamps(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", epoch_to_timestamp(seconds).cast("timestamp_ntz").alias("measured_at")
    )


@query("fct_observation", with_views("obs", """
SELECT row_id, city_name, country_code, temperature_celsius, feels_like_celsius, humidity_percent, pressure_hpa,
  wind_speed_ms, weather_condition, weather_description, cloud_coverage_percent, visibility_meters, measured_at,
  load_id, loaded_at FROM obs
"""))
def fct_observation(spark, sf_dir):
    return core.fct_weather_observation(views.obs(spark, sf_dir))


@query("dim_city", with_views("obs", """
SELECT city_name, country_code, latitude, longitude FROM obs
QUALIFY row_number() OVER (
  PARTITION BY city_name ORDER BY measured_at DESC, country_code DESC, latitude DESC, longitude DESC) = 1
"""))
def dim_city(spark, sf_dir):
    return core.dim_city(views.obs(spark, sf_dir))


# -- marts --------------------------------------------------------------------

@query("union_sources", with_views("obs", "fc", f"WITH {COMBINED} SELECT * FROM combined"))
def union_sources(spark, sf_dir):
    return combined(spark, sf_dir)


@query("daily_summary", with_views("obs", "fc", f"WITH {COMBINED}, {daily_sql('combined')} SELECT * FROM daily"))
def daily_summary(spark, sf_dir):
    return daily(spark, sf_dir)


@query("dominant_value", with_views("obs", """
SELECT city_name, weather_condition AS dominant_weather_condition FROM obs
GROUP BY city_name, weather_condition
QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY count(*) DESC, weather_condition) = 1
"""))
def dominant_value(spark, sf_dir):
    return marts.dominant_value(views.obs(spark, sf_dir), ["city_name"], "weather_condition")


@query("city_metrics", with_views("obs", f"WITH {METRICS_SQL} SELECT * FROM city_metrics"))
def metrics_per_city(spark, sf_dir):
    return city_metrics(spark, sf_dir)


# -- analytic -----------------------------------------------------------------

@query("city_ranking", with_views("obs", f"""
WITH {METRICS_SQL}
SELECT city_name, country_code, avg_temperature_celsius, avg_humidity_percent, avg_wind_speed_ms,
  total_observations, first_observation, last_observation,
  rank() OVER (ORDER BY avg_temperature_celsius DESC NULLS FIRST) AS temp_rank_warmest,
  rank() OVER (ORDER BY avg_temperature_celsius ASC NULLS LAST) AS temp_rank_coldest,
  rank() OVER (ORDER BY avg_humidity_percent DESC NULLS FIRST) AS humidity_rank,
  rank() OVER (ORDER BY avg_wind_speed_ms DESC NULLS FIRST) AS wind_rank,
  rank() OVER (ORDER BY total_observations DESC NULLS FIRST) AS data_completeness_rank,
  {rounded('avg_temperature_celsius - (SELECT avg(avg_temperature_celsius) FROM city_metrics)', 6)} AS temp_vs_mean
FROM city_metrics
"""))
def city_ranking(spark, sf_dir):
    mart = materialise(city_metrics(spark, sf_dir), "city_weather_metrics")
    ranked = analytic.city_comparison_ranking(mart)
    return ranked.withColumn("temp_vs_mean", pg_round("temp_vs_mean", 6))


@query("value_vs_mean", with_views("obs", f"""
WITH per_city AS (SELECT city_name, avg(temperature_celsius) AS avg_temp FROM obs GROUP BY city_name)
SELECT city_name, {rounded('avg_temp', 6)} AS avg_temp,
  {rounded('avg_temp - (SELECT avg(avg_temp) FROM per_city)', 6)} AS temp_vs_mean FROM per_city
"""))
def value_vs_mean(spark, sf_dir):
    per_city = views.obs(spark, sf_dir).groupBy("city_name").agg(F.avg("temperature_celsius").alias("avg_temp"))
    compared = analytic.value_vs_mean(per_city, "avg_temp", "temp_vs_mean")
    return compared.select("city_name", *[pg_round(c, 6).alias(c) for c in ("avg_temp", "temp_vs_mean")])


def _trailing(column: str, digits: int) -> str:
    frame = "(PARTITION BY city_name ORDER BY date_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return rounded(f"avg({column}) OVER {frame}", digits)


@query("rolling_mean_7", with_views("obs", "fc", f"""
WITH {COMBINED}, {daily_sql('combined')}
SELECT city_name, date_day,
  {_trailing('avg_temperature_celsius', 1)} AS temp_7d_moving_avg,
  {_trailing('avg_humidity_percent', 1)} AS humidity_7d_moving_avg,
  {_trailing('avg_wind_speed_ms', 2)} AS wind_7d_moving_avg
FROM daily
"""))
def rolling_mean(spark, sf_dir):
    trend = analytic.weather_trend_analysis(daily(spark, sf_dir))
    return trend.select(
        "city_name", "date_day", "temp_7d_moving_avg", "humidity_7d_moving_avg", "wind_7d_moving_avg"
    )


@query("day_over_day", with_views("obs", "fc", f"""
WITH {COMBINED}, {daily_sql('combined')}
SELECT city_name, date_day, avg_temperature_celsius - lag(avg_temperature_celsius) OVER (
  PARTITION BY city_name ORDER BY date_day) AS temp_day_over_day_change FROM daily
"""))
def day_over_day(spark, sf_dir):
    trend = analytic.weather_trend_analysis(daily(spark, sf_dir))
    return trend.select("city_name", "date_day", "temp_day_over_day_change")


@query("medallion_build", with_views("obs", "fc", f"""
WITH {COMBINED}, {daily_sql('combined')}
SELECT 'dim_city' AS relation, (SELECT count(DISTINCT city_name) FROM obs) AS "rows"
UNION ALL SELECT 'fct_weather_observation', (SELECT count(*) FROM obs)
UNION ALL SELECT 'weather_daily_summary', (SELECT count(*) FROM daily)
UNION ALL SELECT 'city_weather_metrics', (SELECT count(DISTINCT city_name) FROM obs)
UNION ALL SELECT 'city_comparison_ranking', (SELECT count(DISTINCT city_name) FROM obs)
UNION ALL SELECT 'weather_trend_analysis', (SELECT count(*) FROM daily)
"""))
def medallion_build(spark, sf_dir):
    """Builds and stores all layers, then counts the rows of each stored model."""
    root = work_path(spark, "layers")
    built = medallion.build_layers(spark, views.obs(spark, sf_dir), views.fc(spark, sf_dir), root)
    counts = [
        built[m.name].agg(F.count("*").alias("rows")).select(F.lit(m.name).alias("relation"), "rows")
        for m in medallion.MODELS
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


# -- ad-hoc reports -----------------------------------------------------------

@query("top_hottest", with_views("obs", f"""
SELECT city_name, {rounded('avg(temperature_celsius)', 1)} AS avg_temp_c, count(*) AS total_observations
FROM obs GROUP BY city_name ORDER BY avg(temperature_celsius) DESC NULLS FIRST, city_name LIMIT 5
"""))
def top_hottest(spark, sf_dir):
    return adhoc.top_hottest_cities(views.obs(spark, sf_dir))


@query("daily_trend", with_views("obs", f"""
SELECT cast(measured_at AS date) AS date_day, {rounded('avg(temperature_celsius)', 1)} AS avg_temp,
  {rounded('min(temperature_celsius)', 1)} AS min_temp, {rounded('max(temperature_celsius)', 1)} AS max_temp,
  count(*) AS observations
FROM obs WHERE city_name = 'city_7' GROUP BY 1 ORDER BY 1 DESC LIMIT 30
"""))
def daily_trend(spark, sf_dir):
    return adhoc.daily_temperature_trend(views.obs(spark, sf_dir), "city_7")


@query("summary_stats", with_views("obs", f"""
SELECT city_name, count(*) AS total_records, {rounded('avg(temperature_celsius)', 1)} AS avg_temp,
  {rounded('stddev_samp(temperature_celsius)', 2)} AS temp_stddev,
  {rounded('avg(humidity_percent)', 1)} AS avg_humidity, {rounded('avg(wind_speed_ms)', 2)} AS avg_wind,
  min(measured_at) AS first_observation, max(measured_at) AS last_observation
FROM obs GROUP BY city_name
"""))
def summary_stats(spark, sf_dir):
    return adhoc.weather_summary_stats(views.obs(spark, sf_dir))


@query("cross_city", with_views("obs", f"""
WITH city_stats AS (
  SELECT city_name, avg(temperature_celsius) AS avg_temp, avg(humidity_percent) AS avg_humidity,
    avg(wind_speed_ms) AS avg_wind, count(*) AS obs_count FROM obs GROUP BY city_name)
SELECT city_name, {rounded('avg_temp', 1)} AS avg_temp_c, {rounded('avg_humidity', 1)} AS avg_humidity_pct,
  {rounded('avg_wind', 2)} AS avg_wind_ms, obs_count,
  {rounded('avg_temp - (SELECT avg(avg_temp) FROM city_stats)', 1)} AS temp_vs_mean
FROM city_stats
"""))
def cross_city(spark, sf_dir):
    return adhoc.cross_city_comparison(views.obs(spark, sf_dir))


@query("extreme_humidity", with_views("obs", f"""
WITH {METRICS_SQL}
SELECT city_name, avg_humidity_percent AS avg_humidity, total_observations FROM city_metrics
WHERE avg_humidity_percent > 49
"""))
def extreme_humidity(spark, sf_dir):
    # The generated humidity averages near 50, so the usual bound of 80 would select nothing.
    return adhoc.extreme_humidity(city_metrics(spark, sf_dir), above=49)


@query("wind_comparison", with_views("obs", f"""
SELECT city_name, {rounded('avg(wind_speed_ms)', 2)} AS avg_wind, {rounded('max(wind_speed_ms)', 2)} AS max_wind
FROM obs GROUP BY city_name
"""))
def wind_comparison(spark, sf_dir):
    return adhoc.wind_comparison(views.obs(spark, sf_dir))


@query("daily_range_instability", with_views("obs", "fc", f"""
WITH {COMBINED}, {daily_sql('combined')}
SELECT date_day, city_name, {rounded('max_temperature_celsius - min_temperature_celsius', 1)} AS temp_range,
  observation_count
FROM daily WHERE max_temperature_celsius - min_temperature_celsius > 10
ORDER BY temp_range DESC, date_day, city_name LIMIT 20
"""))
def daily_range_instability(spark, sf_dir):
    return adhoc.daily_range_instability(daily(spark, sf_dir))


@query("latest_observation_ties", with_views("obs", """
SELECT s.city_name, temperature_celsius, humidity_percent, wind_speed_ms, weather_description, measured_at
FROM obs s JOIN (SELECT city_name, max(measured_at) AS latest FROM obs GROUP BY city_name) l
  ON s.city_name = l.city_name AND s.measured_at = l.latest
"""))
def latest_observation_ties(spark, sf_dir):
    return adhoc.latest_observations(views.obs(spark, sf_dir))


@query("assert_range_rows", with_views("obs", """
SELECT city_name, temperature_celsius FROM obs WHERE temperature_celsius < -90 OR temperature_celsius > 60
"""))
def assert_range_rows(spark, sf_dir):
    return adhoc.implausible_temperatures(views.obs(spark, sf_dir))


@query("time_range_filter", with_views("obs", """
SELECT row_id, city_name, measured_at FROM obs
WHERE measured_at >= TIMESTAMP '2024-01-10 00:00:00' AND measured_at <= TIMESTAMP '2024-01-17 00:00:00'
"""))
def time_range_filter(spark, sf_dir):
    recent = adhoc.in_time_range(views.obs(spark, sf_dir), "measured_at", "2024-01-10 00:00:00", "2024-01-17 00:00:00")
    return recent.select("row_id", "city_name", "measured_at")


@query("adhoc_sql", with_views("obs", f"""
SELECT weather_condition, count(*) AS n, {rounded('avg(temperature_celsius)', 1)} AS avg_temp
FROM obs WHERE city_name = 'city_3' AND humidity_percent >= 40 GROUP BY weather_condition
"""))
def adhoc_sql(spark, sf_dir):
    register_sql_functions(spark)
    text = """
        SELECT weather_condition, count(*) AS n, pg_round(avg(temperature_celsius), 1) AS avg_temp
        FROM stg_weather_current WHERE city_name = :city AND humidity_percent >= :least
        GROUP BY weather_condition
    """
    return run_sql(spark, text, {"stg_weather_current": views.obs(spark, sf_dir)}, city="city_3", least=40)


# -- scalar functions ---------------------------------------------------------

@query("pg_round", f"""
SELECT l_orderkey, l_linenumber, {rounded('l_extendedprice * l_discount / 7', 1)} AS rounded_1,
  {rounded('l_extendedprice / 3', 2)} AS rounded_2 FROM lineitem
""")
def rounding(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        pg_round(F.col("l_extendedprice") * F.col("l_discount") / 7, 1).alias("rounded_1"),
        pg_round(F.col("l_extendedprice") / 3, 2).alias("rounded_2"),
    )


@query("sql_udf_round", f"""
SELECT l_returnflag, l_linestatus, {rounded('avg(l_extendedprice)', 1)} AS avg_price,
  {rounded('avg(CASE WHEN l_tax < l_discount THEN l_tax ELSE l_tax - l_discount END)', 3)} AS avg_growth
FROM lineitem GROUP BY ALL
""")
def sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    return run_sql(spark, """
        SELECT l_returnflag, l_linestatus, pg_round(avg(l_extendedprice), 1) AS avg_price,
          pg_round(avg(counter_delta(l_discount, l_tax)), 3) AS avg_growth
        FROM raw_items GROUP BY ALL
    """, {"raw_items": views.table(spark, sf_dir, "lineitem")})


@query("date_trunc_day", "SELECT event_id, date_trunc('day', ts)::timestamp AS date_day FROM events")
def date_trunc_day(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select("event_id", day_start("ts").alias("date_day"))


@query("elapsed_seconds", with_views("runs", """
SELECT run_id, cast(round(epoch(coalesce(end_date, TIMESTAMP '2001-08-02 00:00:00') - start_date)) AS bigint) AS elapsed
FROM runs
"""))
def elapsed(spark, sf_dir):
    return views.runs(spark, sf_dir).select(
        "run_id", elapsed_seconds("start_date", "end_date", views.now(views.RUNS_NOW)).alias("elapsed")
    )


@query("error_text_prefix", "SELECT doc_id, left(text, 500) AS text FROM documents")
def error_text_prefix(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select("doc_id", error_prefix("text").alias("text"))


@query("object_key", """
SELECT event_id, 'raw/' || event_type || strftime(ts, '/year=%Y/month=%m/day=%d/') || event_type || '_city_'
  || cast(user_id % 20 AS varchar) || '_' || cast(cast(floor(epoch(ts)) AS bigint) AS varchar) || '.parquet' AS object_key
FROM events
""")
def object_keys(spark, sf_dir):
    city = F.concat(F.lit("City_"), (F.col("user_id") % 20).cast("string"))
    return views.table(spark, sf_dir, "events").select("event_id", object_key("event_type", city, "ts").alias("object_key"))


@query("row_to_json", """
SELECT c_custkey, '{"c_name":' || to_json(c_name) || ',"c_nationkey":' || c_nationkey || ',"c_mktsegment":'
  || to_json(c_mktsegment) || '}' AS payload FROM customer
""")
def row_to_json(spark, sf_dir):
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", row_json("c_name", "c_nationkey", "c_mktsegment").alias("payload")
    )


@query("split_trim", """
SELECT event_id, array_to_string([trim(x) FOR x IN string_split(
  ' ' || event_type || ' ,, city_' || cast(user_id % 20 AS varchar) || ', ', ',') IF trim(x) <> ''], '|') AS items
FROM events
""")
def split_and_trim(spark, sf_dir):
    text = F.concat(
        F.lit(" "), "event_type", F.lit(" ,, city_"), (F.col("user_id") % 20).cast("string"), F.lit(", ")
    )
    return views.table(spark, sf_dir, "events").select("event_id", F.array_join(split_trim(text), "|").alias("items"))
