"""Ad-hoc report library over staging and marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import pg_round
from stratus.plans.analytic import value_vs_mean
from stratus.session import materialise

# Fixed values of the report queries.
HUMID_ABOVE = 80
UNSTABLE_RANGE = 10
UNSTABLE_ROWS = 20
HOTTEST = 5
TREND_DAYS = 30
PLAUSIBLE_TEMPERATURE = (-90, 60)


def top_hottest_cities(observations: DataFrame, limit: int = HOTTEST) -> DataFrame:
    """Warmest cities by unrounded mean; equal means in name order."""
    stats = observations.groupBy("city_name").agg(
        F.avg("temperature_celsius").alias("mean"), F.count("*").alias("total_observations")
    )
    return (
        stats.orderBy(F.col("mean").desc_nulls_first(), F.col("city_name").asc_nulls_last())
        .limit(limit)
        .select("city_name", pg_round("mean", 1).alias("avg_temp_c"), "total_observations")
    )


def daily_temperature_trend(observations: DataFrame, city: str, days: int = TREND_DAYS) -> DataFrame:
    daily = observations.where(F.col("city_name") == F.lit(city)).groupBy(
        F.to_date("measured_at").alias("date_day")
    ).agg(
        pg_round(F.avg("temperature_celsius"), 1).alias("avg_temp"),
        pg_round(F.min("temperature_celsius"), 1).alias("min_temp"),
        pg_round(F.max("temperature_celsius"), 1).alias("max_temp"),
        F.count("*").alias("observations"),
    )
    return daily.orderBy(F.col("date_day").desc_nulls_first()).limit(days)


def weather_summary_stats(observations: DataFrame) -> DataFrame:
    return observations.groupBy("city_name").agg(
        F.count("*").alias("total_records"),
        pg_round(F.avg("temperature_celsius"), 1).alias("avg_temp"),
        pg_round(F.stddev_samp("temperature_celsius"), 2).alias("temp_stddev"),
        pg_round(F.avg("humidity_percent"), 1).alias("avg_humidity"),
        pg_round(F.avg("wind_speed_ms"), 2).alias("avg_wind"),
        F.min("measured_at").alias("first_observation"),
        F.max("measured_at").alias("last_observation"),
    ).orderBy(F.col("total_records").desc_nulls_first(), F.col("city_name").asc_nulls_last())


def cross_city_comparison(observations: DataFrame) -> DataFrame:
    """Means per city and their difference to the unweighted mean of all cities.

    The per-city means feed the rows and the overall mean. They are stored
    once, so the observations are scanned once and not once per use.
    """
    stats = materialise(
        observations.groupBy("city_name").agg(
            F.avg("temperature_celsius").alias("avg_temp"),
            F.avg("humidity_percent").alias("avg_humidity"),
            F.avg("wind_speed_ms").alias("avg_wind"),
            F.count("*").alias("obs_count"),
        ),
        "city_stats",
    )
    return (
        value_vs_mean(stats, "avg_temp", "difference")
        .orderBy(F.col("avg_temp").desc_nulls_first(), F.col("city_name").asc_nulls_last())
        .select(
            "city_name",
            pg_round("avg_temp", 1).alias("avg_temp_c"),
            pg_round("avg_humidity", 1).alias("avg_humidity_pct"),
            pg_round("avg_wind", 2).alias("avg_wind_ms"),
            "obs_count",
            pg_round("difference", 1).alias("temp_vs_mean"),
        )
    )


def extreme_humidity(metrics: DataFrame, above: float = HUMID_ABOVE) -> DataFrame:
    return (
        metrics.where(F.col("avg_humidity_percent") > above)
        .orderBy(F.col("avg_humidity_percent").desc_nulls_first(), "city_name")
        .select("city_name", pg_round("avg_humidity_percent", 1).alias("avg_humidity"), "total_observations")
    )


def wind_comparison(observations: DataFrame) -> DataFrame:
    wind = observations.groupBy("city_name").agg(
        pg_round(F.avg("wind_speed_ms"), 2).alias("avg_wind"),
        pg_round(F.max("wind_speed_ms"), 2).alias("max_wind"),
    )
    return wind.orderBy(F.col("avg_wind").desc_nulls_first(), "city_name")


def daily_range_instability(
    daily: DataFrame, wider_than: float = UNSTABLE_RANGE, limit: int = UNSTABLE_ROWS
) -> DataFrame:
    """Days with the widest temperature range."""
    spread = F.col("max_temperature_celsius") - F.col("min_temperature_celsius")
    return (
        daily.where(spread > wider_than)
        .select("date_day", "city_name", pg_round(spread, 1).alias("temp_range"), "observation_count")
        .orderBy(F.col("temp_range").desc_nulls_first(), "date_day", "city_name")
        .limit(limit)
    )


def latest_observations(observations: DataFrame, *columns: str) -> DataFrame:
    """Every city's newest observations; all rows that share the newest time are kept.

    A rank limited to 1 is applied per task before the shuffle, so each task
    sends only its own newest rows of a city, however many rows that city has.
    Needs one scan and no join.
    """
    kept = columns or ("temperature_celsius", "humidity_percent", "wind_speed_ms", "weather_description")
    newest = Window.partitionBy("city_name").orderBy(F.col("measured_at").desc())
    return (
        observations.where(F.col("measured_at").isNotNull())
        .select("city_name", *kept, "measured_at", F.rank().over(newest).alias("_age"))
        .where(F.col("_age") == 1)
        .drop("_age")
    )


def implausible_temperatures(observations: DataFrame) -> DataFrame:
    low, high = PLAUSIBLE_TEMPERATURE
    value = F.col("temperature_celsius")
    return observations.where((value < low) | (value > high)).select("city_name", "temperature_celsius")


def in_time_range(df: DataFrame, ts: str, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows within a range that includes both ends; reaches the scan as a pushed filter."""
    first, last = (F.lit(str(t)).cast("timestamp_ntz") for t in (start, end))
    return df.where(F.col(ts).between(first, last))
