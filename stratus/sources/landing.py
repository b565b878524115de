"""Landed JSON payloads: scan, parse, provenance and promoted fields."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import as_instant, nested_or_default

# Shape of the two payload kinds.
CURRENT_PAYLOAD = """
    coord struct<lon: double, lat: double>,
    weather array<struct<id: bigint, main: string, description: string, icon: string>>,
    main struct<temp: double, feels_like: double, humidity: bigint, pressure: bigint,
                temp_min: double, temp_max: double>,
    wind struct<speed: double, deg: bigint>,
    clouds struct<all: bigint>,
    visibility bigint,
    dt bigint,
    sys struct<country: string>,
    name string,
    cod bigint
"""
FORECAST_PAYLOAD = """
    city struct<name: string, country: string, coord: struct<lat: double, lon: double>>,
    list array<struct<dt: bigint,
        main: struct<temp: double, feels_like: double, humidity: bigint, pressure: bigint>,
        weather: array<struct<main: string, description: string>>,
        wind: struct<speed: double>, clouds: struct<all: bigint>, pop: double>>,
    cnt bigint
"""


def _with_verdict(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("value").alias("raw_json"), F.try_parse_json("value").isNull().alias("malformed")
    )


def scan_landing(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed documents as text, one per line (or one per file), each marked when it does not parse.

    The text is kept as it came: a document that breaks its contract is still
    loaded, and one that is not JSON does not stop the others.
    """
    return _with_verdict(spark.read.option("wholetext", whole_files).text(path))


def stream_landing(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    """The same scan as a stream over files as they land."""
    return _with_verdict(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path))


def readable(landed: DataFrame) -> DataFrame:
    """Only the documents that parsed."""
    return landed.where(~F.col("malformed")).drop("malformed")


def parse_payload(df: DataFrame, raw: str, payload: str) -> DataFrame:
    """Expand a raw JSON column into the typed payload columns, keeping the other columns.

    A field of another type than declared becomes NULL; its neighbours stay.
    """
    parsed = df.withColumn("_payload", F.from_json(raw, payload))
    return parsed.select(*[c for c in df.columns if c != raw], "_payload.*")


def stamp_provenance(
    df: DataFrame, city: Column | str, extracted_at: datetime | Column | str | None = None
) -> DataFrame:
    """Record which entity was asked for and when, in epoch seconds."""
    city = F.col(city) if isinstance(city, str) else city
    at = as_instant(extracted_at).cast("timestamp")
    return df.withColumns({
        "_extraction_city": city,
        "_extraction_timestamp": F.unix_micros(at) / F.lit(1e6),
    })


def promoted_columns(document: str, source: str) -> dict[str, Column]:
    """The commonly asked fields of a parsed payload, per payload kind."""
    is_current = F.col(source) == "weather_current"
    is_forecast = F.col(source) == "weather_forecast"
    current = {
        "temperature": nested_or_default(document, "$.main.temp", "double"),
        "humidity": nested_or_default(document, "$.main.humidity", "double"),
        "wind_speed": nested_or_default(document, "$.wind.speed", "double"),
        "weather_main": nested_or_default(document, "$.weather[0].main", "string", ""),
        "dt": nested_or_default(document, "$.dt", "bigint"),
    }
    forecast = {
        "forecast_count": nested_or_default(document, "$.cnt", "bigint"),
        "city_name": nested_or_default(document, "$.city.name", "string"),
    }
    promoted = {name: F.when(is_current, value) for name, value in current.items()}
    return promoted | {name: F.when(is_forecast, value) for name, value in forecast.items()}


def promote_fields(df: DataFrame, raw: str = "raw_json", source: str = "source") -> DataFrame:
    """Put the commonly asked fields next to the whole payload, per payload kind."""
    return df.withColumn("_doc", F.try_parse_json(raw)).withColumns(promoted_columns("_doc", source)).drop("_doc")
