"""Payloads parsed once, stored as VARIANT, and typed from there."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import as_instant, epoch_to_timestamp
from stratus.sources.landing import promoted_columns

#: Where each staging column is in a payload object (a whole current payload, or one forecast slot).
SLOT_PATHS = {
    "temperature_celsius": ("$.main.temp", "double"), "feels_like_celsius": ("$.main.feels_like", "double"),
    "humidity_percent": ("$.main.humidity", "bigint"), "pressure_hpa": ("$.main.pressure", "bigint"),
    "wind_speed_ms": ("$.wind.speed", "double"), "weather_condition": ("$.weather[0].main", "string"),
    "weather_description": ("$.weather[0].description", "string"), "cloud_coverage_percent": ("$.clouds.all", "bigint"),
}
CURRENT_PATHS = {
    "city_name": ("$.name", "string"), "country_code": ("$.sys.country", "string"), **SLOT_PATHS,
    "latitude": ("$.coord.lat", "double"), "longitude": ("$.coord.lon", "double"), "visibility_meters": ("$.visibility", "bigint"),
}
CITY_PATHS = {
    "city_name": ("$.city.name", "string"), "country_code": ("$.city.country", "string"),
    "latitude": ("$.city.coord.lat", "double"), "longitude": ("$.city.coord.lon", "double"),
}


def store_documents(df: DataFrame, path: str, raw: str = "raw_json") -> DataFrame:
    """Store ``df`` with ``doc``, its text parsed, and read it back; the text stays where it did not parse.

    This is the one place that parses. Readers take typed paths from the stored document, so no filter and no projection
    parses again, however the optimizer moves them.
    """
    # Within one projection the parsed document is a common subexpression and is made once.
    stored = df.withColumns({"doc": F.try_parse_json(raw), raw: F.when(F.try_parse_json(raw).isNull(), F.col(raw))})
    stored.write.mode("errorifexists").parquet(path)
    return read_documents(df.sparkSession, path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def readable_documents(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("doc").isNotNull())


def _typed(paths: dict[str, tuple[str, str]], document: str) -> list[Column]:
    """Values at the paths; null where there is none or it cannot be read as the type."""
    return [F.try_variant_get(document, path, kind).alias(name) for name, (path, kind) in paths.items()]


def current_observations(documents: DataFrame, loaded_at: datetime | str | None = None) -> DataFrame:
    """Staging rows of current payloads (with ``load_id`` and ``row_id``): all columns of ``plans.staging.stg_weather_current``."""
    return readable_documents(documents).select(
        *_typed(CURRENT_PATHS, "doc"), epoch_to_timestamp(F.try_variant_get("doc", "$.dt", "bigint")).alias("measured_at"),
        "load_id", "row_id", as_instant(loaded_at).alias("loaded_at"),
    )


def forecast_slots(documents: DataFrame, loaded_at: datetime | str | None = None) -> DataFrame:
    """Staging rows of forecast payloads, one per element of ``list``: an explode, no join and no shuffle.

    A payload without slots, or whose ``list`` is no array, gives none. ``row_id`` is drawn from the payload's and the place.
    """
    parts = readable_documents(documents).select(
        *_typed(CITY_PATHS, "doc"), "load_id", F.col("row_id").alias("_parent"),
        F.posexplode(F.try_variant_get("doc", "$.list", "array<variant>")).alias("_place", "_slot"),
    )
    return parts.select(
        *CITY_PATHS, *_typed(SLOT_PATHS, "_slot"), F.try_variant_get("_slot", "$.pop", "double").alias("precipitation_probability"),
        epoch_to_timestamp(F.try_variant_get("_slot", "$.dt", "bigint")).alias("forecast_at"), "load_id",
        F.sha2(F.concat_ws("/", "_parent", F.col("_place").cast("string")), 256).alias("row_id"), as_instant(loaded_at).alias("loaded_at"),
    )


def promoted(documents: DataFrame, source: str = "source") -> DataFrame:
    """``landing.promote_fields`` from stored documents, both kinds."""
    return documents.withColumns(promoted_columns("doc", source))
