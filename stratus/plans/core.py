"""Core star: city dimension and observation fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_COLUMNS = (
    "row_id", "city_name", "country_code",
    "temperature_celsius", "feels_like_celsius", "humidity_percent", "pressure_hpa", "wind_speed_ms",
    "weather_condition", "weather_description", "cloud_coverage_percent", "visibility_meters",
    "measured_at", "load_id", "loaded_at",
)


def dim_city(observations: DataFrame) -> DataFrame:
    """One row per city, from its newest observation; a missing time counts as newest.

    The first grouping is per distinct set of attributes and keeps only
    fixed-width state, so it hashes (no sort) and combines per task before the
    shuffle, however many rows one city has. The second sees a few rows per
    city. Equal times are settled by the largest attributes.
    """
    attributes = ("country_code", "latitude", "longitude")
    variants = observations.groupBy("city_name", *attributes).agg(
        F.max(F.col("measured_at").isNull()).alias("undated"), F.max("measured_at").alias("seen")
    )
    recency = F.struct("undated", "seen", *attributes)
    return (
        variants.groupBy("city_name")
        .agg(F.max_by(F.struct(*attributes), recency).alias("newest"))
        .select("city_name", *[F.col(f"newest.{name}").alias(name) for name in attributes])
    )


def fct_weather_observation(observations: DataFrame) -> DataFrame:
    return observations.select(*FACT_COLUMNS)
