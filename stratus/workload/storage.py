"""Landing, raw zone, shaping, export and replay over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from stratus.session import work_path
from stratus.sources import bronze, export, landing, replay, shaping
from stratus.workload import views
from stratus.workload.registry import query
from stratus.workload.views import with_views


@query("json_landing_scan", with_views("payloads", """
SELECT event_type AS kind, count(*) AS documents, count(*) FILTER (NOT json_valid(raw_json)) AS malformed
FROM payloads GROUP BY event_type
"""))
def json_landing_scan(spark, sf_dir):
    """Lands the payloads as JSON lines and scans them; text that is not JSON is only marked."""
    path = work_path(spark, "landing")
    views.payloads(spark, sf_dir).select("raw_json").write.text(path)
    landed = landing.scan_landing(spark, path)
    kind = F.regexp_extract("raw_json", '(click|error|purchase|signup|view)', 1)
    return landed.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("documents"), F.count_if("malformed").alias("malformed")
    )


@query("provenance_stamp", """
SELECT event_id, 'city_' || cast(user_id % 20 AS varchar) AS _extraction_city,
  1706745600.25e0 AS _extraction_timestamp FROM events
""")
def provenance_stamp(spark, sf_dir):
    city = F.concat(F.lit("city_"), (F.col("user_id") % 20).cast("string"))
    return landing.stamp_provenance(
        views.table(spark, sf_dir, "events").select("event_id", "user_id"), city, "2024-02-01 00:00:00.25"
    ).drop("user_id")


@query("payload_promotion", with_views("bronze", """
WITH docs AS (SELECT *, CASE WHEN json_valid(raw_json) THEN cast(raw_json AS json) END AS doc FROM bronze)
SELECT event_id,
  CASE WHEN source = 'weather_current' THEN try_cast(json_extract_string(doc, '$.main.temp') AS double) END AS temperature,
  CASE WHEN source = 'weather_current' THEN coalesce(json_extract_string(doc, '$.weather[0].main'), '') END AS weather_main,
  CASE WHEN source = 'weather_current' THEN json_extract_string(doc, '$.wind.speed')::double END AS wind_speed,
  CASE WHEN source = 'weather_forecast' THEN cast(NULL AS bigint) END AS forecast_count
FROM docs
"""))
def payload_promotion(spark, sf_dir):
    promoted = landing.promote_fields(views.bronze_rows(spark, sf_dir))
    return promoted.select("event_id", "temperature", "weather_main", "wind_speed", "forecast_count")


def stored(spark, sf_dir):
    path = work_path(spark, "bronze")
    bronze.write_bronze(views.bronze_rows(spark, sf_dir), path)
    return path


@query("bronze_partitioned_write", with_views("bronze", """
SELECT source, cast(year(extracted_at) AS int) AS year, cast(month(extracted_at) AS int) AS month,
  cast(day(extracted_at) AS int) AS day, count(*) AS payloads FROM bronze GROUP BY ALL
"""))
def bronze_partitioned_write(spark, sf_dir):
    rows = bronze.read_bronze(spark, stored(spark, sf_dir))
    return rows.groupBy(*bronze.PARTITIONS).agg(F.count("*").alias("payloads"))


@query("bronze_file_inventory", with_views("bronze", """
SELECT 'source=' || source || strftime(extracted_at, '/year=%Y/month=%m/day=%d') AS folder, count(*) AS "rows"
FROM bronze GROUP BY ALL
"""))
def bronze_file_inventory(spark, sf_dir):
    files = bronze.file_inventory(bronze.read_bronze(spark, stored(spark, sf_dir)))
    folder = F.regexp_extract("file_path", "(source=.*)/[^/]+$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.sum("rows").alias("rows"))


@query("bronze_payload_read", with_views("bronze", """
SELECT b.raw_json FROM bronze b JOIN (SELECT max(extracted_at) AS at FROM bronze) m ON b.extracted_at = m.at
"""))
def bronze_payload_read(spark, sf_dir):
    rows = bronze.read_bronze(spark, stored(spark, sf_dir))
    key = rows.select(F.max(F.struct("extracted_at", "source", "city")).alias("k")).first().k
    return bronze.read_payload(rows, key.source, key.city, key.extracted_at)


@query("date_range_scan", with_views("bronze", """
SELECT event_id, source, city, extracted_at FROM bronze
WHERE cast(extracted_at AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
"""))
def date_range_scan(spark, sf_dir):
    rows = bronze.read_bronze(spark, stored(spark, sf_dir))
    return bronze.in_date_range(rows, "2024-01-10", "2024-01-12").select("event_id", "source", "city", "extracted_at")


@query("append_load_ids", """
SELECT event_id, load_id, sha256('{"load_id":"' || load_id || '","event_id":' || event_id || '}') AS row_id
FROM (SELECT event_id, unnest(['load-1', 'load-2']) AS load_id FROM events)
""")
def append_load_ids(spark, sf_dir):
    """Appends the events twice, as two loads; nothing is replaced."""
    path = work_path(spark, "loads")
    events = views.table(spark, sf_dir, "events").select("event_id")
    for load in ("load-1", "load-2"):
        bronze.append_load(events, path, load, "event_id")
    return spark.read.schema("event_id bigint, load_id string, row_id string").parquet(path)


@query("flatten_struct", """
SELECT cast(o_orderkey AS varchar) AS row_id, 'load-1' AS load_id,
  'city_' || cast(o_custkey % 20 AS varchar) AS city__name, 'K' || cast(o_custkey % 7 AS varchar) AS city__country,
  cast(o_custkey % 20 AS double) * 1.5e0 AS city__coord__lat, cast(o_custkey % 20 AS double) AS city__coord__lon
FROM orders
""")
def flatten_struct(spark, sf_dir):
    return shaping.flatten_struct(views.forecast_parents(spark, sf_dir))


@query("unnest_child", """
SELECT sha256(doc_id || '/' || (i - 1)) AS _row_id, doc_id AS _parent_id, cast(i - 1 AS int) AS _position,
  sentences[i] AS sentence
FROM (SELECT doc_id, sentences, unnest(generate_series(1, len(sentences))) AS i FROM (
  SELECT doc_id, string_split(text, '. ') AS sentences FROM documents))
""")
def unnest_child(spark, sf_dir):
    """Each document's sentences as a child relation."""
    sentences = F.transform(F.split("text", "\\. "), lambda s: F.struct(s.alias("sentence")))
    parents = views.table(spark, sf_dir, "documents").select("doc_id", sentences.alias("sentences"))
    return shaping.unnest_child(parents, "sentences", "doc_id")


@query("schema_merge_union", """
SELECT c_custkey AS "key", c_name AS name, c_mktsegment AS segment, cast(NULL AS varchar) AS brand FROM customer
UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part
""")
def schema_merge_union(spark, sf_dir):
    """Two loads with different columns in one folder, merged by name on read."""
    path = work_path(spark, "merge")
    customers = views.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_mktsegment AS segment"
    )
    parts = views.table(spark, sf_dir, "part").selectExpr("p_partkey AS key", "p_name AS name", "p_brand AS brand")
    for load in (customers, parts):
        load.write.mode("append").parquet(path)
    return bronze.read_bronze(spark, path, merge_schema=True).select("key", "name", "segment", "brand")


EXPORTED = with_views("obs", "SELECT row_id, city_name, temperature_celsius, humidity_percent, measured_at FROM obs")


def _export_rows(spark, sf_dir):
    return views.obs(spark, sf_dir).select(
        "row_id", "city_name", "temperature_celsius", "humidity_percent", "measured_at"
    )


@query("export_parquet_roundtrip", EXPORTED)
def export_parquet_roundtrip(spark, sf_dir):
    path = export.export_parquet(_export_rows(spark, sf_dir), work_path(spark, "export"))
    return spark.read.parquet(path)


@query("export_csv_roundtrip", EXPORTED)
def export_csv_roundtrip(spark, sf_dir):
    rows = _export_rows(spark, sf_dir)
    return export.read_csv_export(spark, export.export_csv(rows, work_path(spark, "export")), rows)


@query("replay_range", with_views("bronze", """
SELECT 'success' AS status, DATE '2024-01-05' AS date_start, DATE '2024-01-08' AS date_end,
  count(*) AS records_loaded, true AS transformed
FROM bronze WHERE cast(extracted_at AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'
"""))
def replay_range(spark, sf_dir):
    target, derived = work_path(spark, "replayed"), work_path(spark, "derived")

    def transform(rows):
        landing.promote_fields(rows).write.mode("overwrite").parquet(derived)

    summary = replay.replay_range(
        spark, stored(spark, sf_dir), target, date(2024, 1, 5), date(2024, 1, 8), transform
    )
    return summary.drop("files_found")
