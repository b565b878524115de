"""Staging relations: one projection over the payloads, recomputed on read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import as_instant, epoch_to_timestamp, first_element

MEASURES = {
    "temperature_celsius": "main.temp",
    "feels_like_celsius": "main.feels_like",
    "humidity_percent": "main.humidity",
    "pressure_hpa": "main.pressure",
    "wind_speed_ms": "wind.speed",
}


def _slot_columns(prefix: str = "") -> list[Column]:
    """Columns the two payload kinds share, read from the payload object at ``prefix``."""
    conditions = F.col(f"{prefix}weather")
    return [
        *[F.col(prefix + path).alias(name) for name, path in MEASURES.items()],
        first_element(conditions, "main").alias("weather_condition"),
        first_element(conditions, "description").alias("weather_description"),
        F.col(f"{prefix}clouds.all").alias("cloud_coverage_percent"),
    ]


def stg_weather_current(raw: DataFrame, loaded_at: datetime | str | None = None) -> DataFrame:
    """Typed observations from parsed current payloads (with ``load_id`` and ``row_id``)."""
    return raw.select(
        F.col("name").alias("city_name"),
        F.col("sys.country").alias("country_code"),
        *_slot_columns(),
        F.col("coord.lat").alias("latitude"),
        F.col("coord.lon").alias("longitude"),
        F.col("visibility").alias("visibility_meters"),
        epoch_to_timestamp("dt").alias("measured_at"),
        "load_id",
        "row_id",
        as_instant(loaded_at).alias("loaded_at"),
    )


def _forecast_columns(loaded_at) -> list[Column | str]:
    return [
        F.col("s.city.name").alias("city_name"),
        F.col("s.city.country").alias("country_code"),
        F.col("s.city.coord.lat").alias("latitude"),
        F.col("s.city.coord.lon").alias("longitude"),
        *_slot_columns("f."),
        F.col("f.pop").alias("precipitation_probability"),
        epoch_to_timestamp("f.dt").alias("forecast_at"),
        F.col("s.load_id"),
        F.col("f._row_id").alias("row_id"),
        as_instant(loaded_at).alias("loaded_at"),
    ]


def stg_weather_forecast(
    parents: DataFrame, children: DataFrame, loaded_at: datetime | str | None = None
) -> DataFrame:
    """Forecast slots from separately stored parents and children.

    Plain inner join: the adaptive planner broadcasts the parents when their
    measured size allows, and splits hot parents otherwise.
    """
    joined = parents.alias("s").join(children.alias("f"), F.col("s.row_id") == F.col("f._parent_id"), "inner")
    return joined.select(*_forecast_columns(loaded_at))


def stg_forecast_from_payload(raw: DataFrame, loaded_at: datetime | str | None = None) -> DataFrame:
    """The same slots straight from whole payloads: an explode, no join and no shuffle."""
    parent = F.struct(F.col("city"), F.col("load_id")).alias("s")
    exploded = raw.select(parent, "row_id", F.posexplode("list").alias("_position", "_item"))
    row_id = F.sha2(F.concat_ws("/", "row_id", F.col("_position").cast("string")), 256)
    slots = exploded.select("s", F.col("_item").withField("_row_id", row_id).alias("f"))
    return slots.select(*_forecast_columns(loaded_at))
