"""Marts: daily summary per city and lifetime metrics per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import day_start, pg_round

SHARED = (
    "city_name", "temperature_celsius", "feels_like_celsius", "humidity_percent",
    "pressure_hpa", "wind_speed_ms", "weather_condition",
)
# Digits each averaged measure is rounded to.
DIGITS = {
    "temperature_celsius": 1,
    "feels_like_celsius": 1,
    "humidity_percent": 1,
    "pressure_hpa": 1,
    "wind_speed_ms": 2,
}


def union_sources(observations: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Observations and forecast slots as one relation; duplicates stay."""

    def leg(df: DataFrame, at: str) -> DataFrame:
        return df.select(*SHARED, day_start(at).alias("date_day"))

    return leg(observations, "measured_at").unionByName(leg(forecasts, "forecast_at"))


def condition_parts(combined: DataFrame, *groups: Column | str) -> DataFrame:
    """Mergeable daily parts per condition: sums, counts and extremes.

    Uses fixed-width state only, so it hashes and combines per task; the same
    grouping runs on a stream. ``groups`` replaces the default day column.
    """
    return combined.groupBy("city_name", *(groups or ("date_day",)), "weather_condition").agg(
        F.count("*").alias("n"),
        F.min("temperature_celsius").alias("lowest"),
        F.max("temperature_celsius").alias("highest"),
        *[F.sum(F.col(m).cast("double")).alias(f"sum_{m}") for m in DIGITS],
        *[F.count(m).alias(f"n_{m}") for m in DIGITS],
    )


def together(parts: DataFrame) -> DataFrame:
    """Parts of several loads as one part per city, day and condition, of the same form."""
    return parts.groupBy("city_name", "date_day", "weather_condition").agg(
        F.sum("n").alias("n"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        *[F.sum(f"sum_{m}").alias(f"sum_{m}") for m in DIGITS],
        *[F.sum(f"n_{m}").alias(f"n_{m}") for m in DIGITS],
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Daily summary from the parts, one per condition; the most frequent condition is a plain ``min_by`` here.

    Equal counts give the smallest condition; NULL never wins.
    """
    known = F.when(F.col("weather_condition").isNotNull(), F.struct(-F.col("n"), F.col("weather_condition")))

    def mean(measure: str) -> Column:
        value = F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}"))
        return pg_round(value, DIGITS[measure])

    return parts.groupBy("city_name", "date_day").agg(
        mean("temperature_celsius").alias("avg_temperature_celsius"),
        pg_round(F.min("lowest"), 1).alias("min_temperature_celsius"),
        pg_round(F.max("highest"), 1).alias("max_temperature_celsius"),
        mean("feels_like_celsius").alias("avg_feels_like_celsius"),
        mean("humidity_percent").alias("avg_humidity_percent"),
        mean("pressure_hpa").alias("avg_pressure_hpa"),
        mean("wind_speed_ms").alias("avg_wind_speed_ms"),
        F.min_by("weather_condition", known).alias("dominant_weather_condition"),
        F.sum("n").alias("observation_count"),
    )


def weather_daily_summary(combined: DataFrame) -> DataFrame:
    """Daily measures and the most frequent condition per city.

    Two grouping steps: per condition over the raw rows, then per city and day
    over the few condition rows.
    """
    return merge_parts(condition_parts(combined))


def dominant_value(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Most frequent non-NULL value per key; the smallest one when counts are equal."""
    counted = df.groupBy(*keys, column).agg(F.count("*").alias("n"))
    known = F.when(F.col(column).isNotNull(), F.struct(-F.col("n"), F.col(column)))
    return counted.groupBy(*keys).agg(F.min_by(column, known).alias(f"dominant_{column}"))


def city_weather_metrics(observations: DataFrame) -> DataFrame:
    """Lifetime metrics per city.

    ``max`` over text cannot use hash aggregation, so the country joins the
    first grouping key and the raw rows only feed fixed-width state.
    """
    measures = ("temperature_celsius", "humidity_percent", "pressure_hpa", "wind_speed_ms")
    per_country = observations.groupBy("city_name", "country_code").agg(
        F.max("latitude").alias("latitude"),
        F.max("longitude").alias("longitude"),
        F.count("*").alias("n"),
        F.min("temperature_celsius").alias("lowest"),
        F.max("temperature_celsius").alias("highest"),
        F.min("measured_at").alias("first_seen"),
        F.max("measured_at").alias("last_seen"),
        *[F.sum(F.col(m).cast("double")).alias(f"sum_{m}") for m in measures],
        *[F.count(m).alias(f"n_{m}") for m in measures],
    )

    def mean(measure: str):
        value = F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}"))
        return pg_round(value, DIGITS[measure]).alias(f"avg_{measure}")

    return per_country.groupBy("city_name").agg(
        *[F.max(c).alias(c) for c in ("country_code", "latitude", "longitude")],
        F.sum("n").alias("total_observations"),
        pg_round(F.min("lowest"), 1).alias("min_temperature_celsius"),
        pg_round(F.max("highest"), 1).alias("max_temperature_celsius"),
        *[mean(m) for m in measures],
        F.min("first_seen").alias("first_observation"),
        F.max("last_seen").alias("last_observation"),
    )
