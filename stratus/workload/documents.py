"""Whole payloads of both kinds, stored as documents and typed from there; stated from the events themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.operators.contracts import FORECAST_CONTRACT, check_contract
from stratus.session import work_path
from stratus.sources import documents
from stratus.workload import views
from stratus.workload.registry import query

SECOND = "date_trunc('second', ts)"
LOADED = f"TIMESTAMP '{views.LOADED_AT}'"
KNOWN = "CASE WHEN f <> 1 THEN event_type END AS weather_condition, CASE WHEN f <> 1 THEN 'it is ' || event_type END AS weather_description"


def _measures(more: int, guard: str = "true") -> str:
    return f"""CASE WHEN {guard} THEN cast(cast(value AS decimal(12,2)) AS double) END AS temperature_celsius,
  CASE WHEN {guard} THEN cast(user_id % 17 AS double) END AS feels_like_celsius,
  CASE WHEN {guard} THEN user_id % 100 END AS humidity_percent, CASE WHEN {guard} THEN 1000 + user_id % 30 + {more} END AS pressure_hpa,
  cast(user_id % 30 AS double) AS wind_speed_ms, {KNOWN}, CASE WHEN f <> 2 THEN user_id % 50 END AS cloud_coverage_percent"""


def stored(spark, sf_dir, source=None):
    payloads = views.whole_payloads(spark, sf_dir)
    if source is not None:
        payloads = payloads.where(F.col("source") == source)
    return documents.store_documents(payloads, work_path(spark, "documents"))


@query("documents_current", f"""
SELECT event_type AS city_name, CASE WHEN f <> 2 THEN 'K' || cast(user_id % 7 AS varchar) END AS country_code, {_measures(0, 'f <> 4')},
  1.5e0 AS latitude, cast(user_id % 90 AS double) AS longitude, user_id * 10 AS visibility_meters, {SECOND} AS measured_at,
  'load-1' AS load_id, cast(event_id AS varchar) AS row_id, {LOADED} AS loaded_at
FROM (SELECT *, event_id % 5 AS f FROM events) WHERE f <> 3 AND user_id % 2 = 0
""")
def documents_current(spark, sf_dir):
    """Current payloads parsed once and stored; all staging columns."""
    rows = documents.current_observations(stored(spark, sf_dir, "weather_current"), views.LOADED_AT)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("measured_at", "loaded_at")})


@query("documents_forecast", " UNION ALL ".join(f"""
SELECT event_type AS city_name, CASE WHEN f <> 2 THEN 'K' || cast(user_id % 7 AS varchar) END AS country_code,
  CASE WHEN f <> 2 THEN 1.5e0 END AS latitude, CASE WHEN f <> 2 THEN cast(user_id % 90 AS double) END AS longitude, {_measures(k)},
  0.{k + 1}e0 AS precipitation_probability, {SECOND} + INTERVAL {3 * (k + 1)} HOUR AS forecast_at, 'load-1' AS load_id,
  sha256(cast(event_id AS varchar) || '/{k}') AS row_id, {LOADED} AS loaded_at
FROM (SELECT *, event_id % 5 AS f FROM events) WHERE f NOT IN (1, 3) AND user_id % 2 = 1
""" for k in (0, 1)))
def documents_forecast(spark, sf_dir):
    """Forecast payloads end to end: text, stored document, one row per slot."""
    rows = documents.forecast_slots(stored(spark, sf_dir, "weather_forecast"), views.LOADED_AT)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("forecast_at", "loaded_at")})


@query("documents_promoted", f"""
SELECT event_id, source, CASE WHEN c AND f NOT IN (3, 4) THEN cast(cast(value AS decimal(12,2)) AS double) END AS temperature,
  CASE WHEN c AND f NOT IN (3, 4) THEN cast(user_id % 100 AS double) END AS humidity,
  CASE WHEN c AND f <> 3 THEN cast(user_id % 30 AS double) END AS wind_speed,
  CASE WHEN c THEN CASE WHEN f IN (1, 3) THEN '' ELSE event_type END END AS weather_main,
  CASE WHEN c AND f <> 3 THEN cast(floor(epoch(ts)) AS bigint) END AS dt,
  CASE WHEN NOT c AND f NOT IN (3, 4) THEN 2::bigint END AS forecast_count, CASE WHEN NOT c AND f <> 3 THEN event_type END AS city_name,
  f <> 3 AS parsed
FROM (
  SELECT *, event_id % 5 AS f, user_id % 2 = 0 AS c, CASE WHEN user_id % 2 = 0 THEN 'weather_current' ELSE 'weather_forecast' END AS source
  FROM events
)
""")
def documents_promoted(spark, sf_dir):
    """All promoted fields of both kinds of payload."""
    rows = documents.promoted(stored(spark, sf_dir))
    return rows.select(
        "event_id", "source", "temperature", "humidity", "wind_speed", "weather_main", "dt", "forecast_count", "city_name",
        F.col("raw_json").isNull().alias("parsed"),
    )


@query("contract_forecast", """
SELECT event_id, f = 3 AS malformed, CASE f WHEN 2 THEN 'Missing required field: city.coord'
  WHEN 4 THEN 'Type mismatch at cnt: expected integer, got str' WHEN 3 THEN NULL ELSE '' END AS errors
FROM (SELECT *, event_id % 5 AS f FROM events) WHERE user_id % 2 = 1
""")
def contract_forecast(spark, sf_dir):
    """The forecast contract over forecast payloads."""
    payloads = views.whole_payloads(spark, sf_dir).where("source = 'weather_forecast'")
    checked = check_contract(payloads, "raw_json", FORECAST_CONTRACT)
    errors = F.when(~F.col("malformed"), F.array_join("contract_errors", "; "))
    return checked.select("event_id", "malformed", errors.alias("errors"))
