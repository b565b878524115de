"""Streaming jobs run to the end of the given tables, in the order they landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.functions import day_start, pg_round
from stratus.operators.contracts import CURRENT_CONTRACT
from stratus.plans.marts import condition_parts, merge_parts, together
from stratus.session import work_path
from stratus.streaming import holding, jobs, running
from stratus.streaming.parts import newest_by
from stratus.workload import layers, quality, views
from stratus.workload.registry import query
from stratus.workload.views import rounded, with_views


def event_stream(spark, sf_dir):
    schema = views.table(spark, sf_dir, "events").schema
    return running.stream_table(spark, f"{sf_dir}/events.parquet", schema)


@query("stream_ingest", "SELECT * FROM events")
def stream_ingest(spark, sf_dir):
    """Appends newly landed files, each once."""
    return running.finish_append(event_stream(spark, sf_dir), "ingest")


@query("stream_daily_summary", with_views("obs", f"""
WITH days AS (SELECT *, date_trunc('day', measured_at)::timestamp AS date_day FROM obs), {layers.daily_sql('days')}
SELECT * FROM daily
"""))
def stream_daily_summary(spark, sf_dir):
    landed = views.obs_columns(event_stream(spark, sf_dir)).withColumn("date_day", day_start("measured_at"))
    return merge_parts(running.finish_merge(landed, "daily", condition_parts, together))


@query("stream_sliding_rate", with_views("series", f"""
SELECT name, make_timestamp(start_us) AS window_start, make_timestamp(start_us + 300000000) AS window_end,
  {rounded('sum(value)', 6)} AS total, count(value) AS samples, {rounded('sum(value) / 300.0e0', 6)} AS rate
FROM (SELECT *, (epoch_us(ts) // 60000000 - unnest(range(0, 5))) * 60000000 AS start_us FROM series)
GROUP BY name, start_us
"""))
def stream_sliding_rate(spark, sf_dir):
    landed = views.series_columns(event_stream(spark, sf_dir))
    panes = running.finish_merge(
        landed, "panes", lambda rows: jobs.panes(rows, ["name"], "value"), jobs.merged_panes(["name"])
    )
    return jobs.per_second(jobs.sliding_from_panes(panes, ["name"]), 300).select(
        "name", "window_start", "window_end", pg_round("total", 6).alias("total"), "samples",
        pg_round("rate", 6).alias("rate"),
    )


@query("stream_dedup", "SELECT cast(event_id AS varchar) AS row_id, ts FROM events")
def stream_dedup(spark, sf_dir):
    """Every row arrives twice and is kept once."""
    twice = event_stream(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("row_id"), "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("arrival")
    )
    return running.finish_new(twice.drop("arrival"), "dedup", "row_id", "ts")


@query("stream_contract", with_views("payloads", f"""
WITH {quality.CHECKED}
SELECT CASE WHEN malformed OR len(errors) > 0 THEN 'quarantine' ELSE 'valid' END AS target, malformed,
  nullif(array_to_string(errors, '; '), '') AS errors, count(*) AS "rows"
FROM checked GROUP BY ALL
"""))
def stream_contract(spark, sf_dir):
    """Checks payloads in flight and sends each to its folder."""
    landed = views.payloads_columns(event_stream(spark, sf_dir)).select("event_id", "raw_json")
    path = work_path(spark, "contract")
    checked = jobs.contract_stream(landed, "raw_json", CURRENT_CONTRACT)
    running.append_to(checked, f"{path}/table", f"{path}/checkpoint", ("target",))
    rows = spark.read.schema(checked.schema).parquet(f"{path}/table")
    errors = F.array_join("contract_errors", "; ")
    return rows.groupBy("target", "malformed", F.when(errors != "", errors).alias("errors")).agg(
        F.count("*").alias("rows")
    )


@query("stream_alert_hold", with_views("series", """
WITH ticks AS (
  SELECT name, epoch_us(ts) // 1800000000 * 1800000000 AS tick, arg_max(value > 20, (ts, event_id)) AS truth
  FROM series GROUP BY ALL
),
islands AS (
  SELECT name, tick, row_number() OVER (PARTITION BY name ORDER BY tick)
    - row_number() OVER (PARTITION BY name, truth ORDER BY tick) AS island, truth FROM ticks
),
runs AS (SELECT name, island, min(tick) AS since FROM islands WHERE truth GROUP BY ALL)
SELECT r.name, make_timestamp(r.since) AS held_since, make_timestamp(min(i.tick)) AS fired_at
FROM runs r JOIN islands i ON r.name = i.name AND r.island = i.island AND i.truth AND i.tick - r.since >= 3600000000
GROUP BY r.name, r.since
"""))
def stream_alert_hold(spark, sf_dir):
    """Alerts for values that stay high for an hour; a rule is evaluated every 30 minutes."""
    samples = views.series_columns(event_stream(spark, sf_dir))
    current = running.finish_merge(
        samples, "hold", lambda rows: holding.tick_parts(rows, ["name"], F.col("value") > 20, tick_seconds=1_800),
        newest_by(["name", "tick"], "newest"),
    )
    fired = holding.held_ticks(current, ["name"], hold_seconds=3_600)
    return fired.select("name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("held_since", "fired_at")])
