"""Metric-series, run-history, alert and log operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.functions import containers as box
from stratus.functions import label_matches, pg_round, relabel
from stratus.functions.metric_names import METRIC_RULES, UNMAPPED, with_metric_name
from stratus.operators import absence, alerts, anomaly, counters, logs, runs, series, sustained
from stratus.operators.alerts import THRESHOLD_RULES
from stratus.plans import alert_rules
from stratus.workload import views
from stratus.workload.registry import query
from stratus.workload.views import EVENTS_NOW, RUNS_NOW, rounded, with_views

STEP = 300
E_NOW = f"TIMESTAMP '{EVENTS_NOW}'"
R_NOW = f"TIMESTAMP '{RUNS_NOW}'"


# -- counters -----------------------------------------------------------------

def windowed_sql(value: str, share: str, window: int, result: str) -> str:
    """Brute force: join every evaluation instant with the samples in its window."""
    return with_views("series", f"""
WITH pairs AS (
  SELECT name, epoch_us(ts) AS us, {value} AS v,
    lag({value}) OVER w AS p, lag(epoch_us(ts)) OVER w AS pus FROM series WHERE {value} IS NOT NULL
  WINDOW w AS (PARTITION BY name ORDER BY ts, event_id)
),
instants AS (SELECT DISTINCT name, (us // {STEP * 1_000_000} + 1) * {STEP * 1_000_000} AS t FROM pairs),
sums AS (
  SELECT i.name, i.t, count(*) AS samples,
    sum(CASE WHEN pus >= t - {window * 1_000_000} THEN {share} ELSE 0 END)::bigint AS total
  FROM instants i JOIN pairs s ON s.name = i.name AND s.us < i.t AND s.us >= i.t - {window * 1_000_000}
  GROUP BY i.name, i.t
)
SELECT name, make_timestamp(t) AS evaluated_at, samples, {result} FROM sums
""")


DELTA = "CASE WHEN v < p THEN v ELSE v - p END"


@query("counter_increase", windowed_sql("counter", DELTA, 3600, "CASE WHEN samples >= 2 THEN total END AS increase"))
def counter_increase(spark, sf_dir):
    return counters.counter_increase(views.series(spark, sf_dir), ["name"], "counter", window=3600, step=STEP)


@query("counter_rate", windowed_sql(
    "counter", DELTA, 900, f"{rounded('CASE WHEN samples >= 2 THEN total / 900.0e0 * 60 END', 6)} AS rate"))
def counter_rate(spark, sf_dir):
    rates = counters.counter_rate(views.series(spark, sf_dir), ["name"], "counter", window=900, step=STEP, per=60)
    return rates.withColumn("rate", pg_round("rate", 6))


@query("value_changes", windowed_sql(
    "counter % 3", "CASE WHEN v <> p THEN 1 ELSE 0 END", 900, "CASE WHEN samples >= 2 THEN total END AS changes"))
def value_changes(spark, sf_dir):
    gauges = views.series(spark, sf_dir).withColumn("gauge", F.col("counter") % 3)
    changed = counters.value_changes(gauges, ["name"], "gauge", window=900, step=STEP)
    return changed.withColumn("changes", F.col("changes").cast("bigint"))


@query("counter_increase_range", with_views("series", f"""
SELECT name, sum(CASE WHEN p IS NULL THEN 0 ELSE {DELTA} END)::bigint AS increase, count(*) AS samples
FROM (SELECT name, counter AS v, lag(counter) OVER (PARTITION BY name ORDER BY ts, event_id) AS p FROM series)
GROUP BY name
"""))
def counter_increase_range(spark, sf_dir):
    return counters.increase_over_range(views.series(spark, sf_dir), ["name"], "counter")


# -- held conditions ----------------------------------------------------------

@query("sustained_condition", with_views("series", """
WITH marked AS (
  SELECT name, ts, value > 20 AS truth,
    row_number() OVER (PARTITION BY name ORDER BY ts, event_id)
      - row_number() OVER (PARTITION BY name, value > 20 ORDER BY ts, event_id) AS island FROM series
),
spans AS (
  SELECT name, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS samples FROM marked
  WHERE truth GROUP BY name, island
)
SELECT name, started_at, ended_at, samples, (epoch_us(ended_at) - epoch_us(started_at)) / 1e6 AS held_seconds,
  started_at + INTERVAL 3600 SECOND AS fires_from
FROM spans WHERE epoch_us(ended_at) - epoch_us(started_at) >= 3600000000
"""))
def sustained_condition(spark, sf_dir):
    return sustained.sustained_condition(views.series(spark, sf_dir), ["name"], F.col("value") > 20, 3600)


@query("availability_timeline", with_views("series", """
SELECT name, state, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS samples FROM (
  SELECT name, ts, counter % 2 AS state,
    row_number() OVER (PARTITION BY name ORDER BY ts, event_id)
      - row_number() OVER (PARTITION BY name, counter % 2 ORDER BY ts, event_id) AS island FROM series)
GROUP BY name, state, island
"""))
def availability_timeline(spark, sf_dir):
    return sustained.availability_timeline(views.series(spark, sf_dir), ["name"], F.col("counter") % 2)


# -- series -------------------------------------------------------------------

@query("metric_ratio_alert", with_views("series", """
WITH sides AS (
  SELECT instance, epoch_us(ts) // 21600000000 AS step,
    arg_max(value, (ts, event_id)) FILTER (name = 'view') AS numerator,
    arg_max(value, (ts, event_id)) FILTER (name = 'click') AS denominator
  FROM series WHERE name IN ('view', 'click') GROUP BY ALL
)
SELECT instance, make_timestamp((step + 1) * 21600000000) AS evaluated_at, numerator, denominator,
  numerator / denominator * 100 AS percent
FROM sides WHERE numerator / denominator * 100 > 85
"""))
def metric_ratio_alert(spark, sf_dir):
    ratio = series.metric_ratio(views.series(spark, sf_dir), ["instance"], "view", "click", step=21_600)
    return ratio.where(F.col("percent") > 85)


def _newest(name: str) -> str:
    return f"""
  SELECT "user", arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM series
  WHERE name = '{name}' GROUP BY "user" HAVING arg_max(value, (ts, event_id)) > 30
"""


def newest(spark, sf_dir, name: str):
    samples = views.series(spark, sf_dir).where(F.col("name") == name)
    return series.latest_samples(samples, ["user"], tiebreak="event_id").where(F.col("value") > 30)


@query("series_and_semi", with_views("series", f"""
SELECT * FROM ({_newest('error')}) WHERE "user" IN (SELECT "user" FROM ({_newest('click')}))
"""))
def series_and(spark, sf_dir):
    return series.series_and(newest(spark, sf_dir, "error"), newest(spark, sf_dir, "click"), ["user"])


@query("series_or_union", with_views("series", f"""
SELECT * FROM ({_newest('error')}) UNION ALL
SELECT * FROM ({_newest('click')}) WHERE "user" NOT IN (SELECT "user" FROM ({_newest('error')}))
"""))
def series_or(spark, sf_dir):
    return series.series_or(newest(spark, sf_dir, "error"), newest(spark, sf_dir, "click"), ["user"])


@query("absent_series", with_views("series", """
SELECT DISTINCT "user", 1 AS value FROM series WHERE "user" NOT IN (
  SELECT "user" FROM series WHERE name = 'purchase'
    AND ts > TIMESTAMP '2024-01-23 00:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00')
"""))
def absent_series(spark, sf_dir):
    samples = views.series(spark, sf_dir)
    expected = samples.select("user").distinct()
    return series.absent_series(
        expected, samples.where(F.col("name") == "purchase"), ["user"], views.now("2024-01-31 00:00:00"), 8 * 86_400
    )


@query("absence_periods", with_views("series", """
WITH bought AS (SELECT "user" AS u, epoch_us(ts) AS us FROM series WHERE name = 'purchase'),
gaps AS (
  SELECT u, us AS a, lead(us) OVER (PARTITION BY u ORDER BY us) AS b FROM bought
  UNION ALL SELECT e.u, NULL, min(us) FROM (SELECT DISTINCT "user" AS u FROM series) e LEFT JOIN bought USING (u) GROUP BY 1
),
ticks AS (
  SELECT u, greatest(473352, coalesce((a + 172800000000 + 3599999999) // 3600000000, 473352)) AS f,
    least(474072, coalesce((b + 3599999999) // 3600000000 - 1, 474072)) AS l FROM gaps
)
SELECT u AS "user", make_timestamp(f * 3600000000) AS started_at, make_timestamp(l * 3600000000) AS ended_at,
  l - f + 1 AS evaluations, make_timestamp((f + 24) * 3600000000) AS fires_from
FROM ticks WHERE f <= l AND l - f >= 24
"""))
def absence_periods(spark, sf_dir):
    """Users without a purchase for two days, seen hourly in January and held for a day."""
    samples = views.series(spark, sf_dir)
    return absence.absence_periods(
        samples.where(F.col("name") == "purchase"), ["user"], views.now("2024-01-01 00:00:00"), views.now("2024-01-31 00:00:00"),
        2 * 86_400, 3_600, 86_400, expected=samples.select("user"),
    )


@query("sum_by_label", with_views("series", f"""
SELECT instance, date_trunc('day', ts)::timestamp AS day, {rounded('sum(value)', 6)} AS total,
  {rounded('avg(value)', 6)} AS mean FROM series GROUP BY ALL
"""))
def sum_by_label(spark, sf_dir):
    daily = views.series(spark, sf_dir).withColumn("day", F.to_date("ts").cast("timestamp_ntz"))
    return series.sum_by_label(daily, ["instance", "day"]).select(
        "instance", "day", *[pg_round(c, 6).alias(c) for c in ("total", "mean")]
    )


@query("series_reducers", with_views("series", f"""
SELECT name, instance, {rounded('avg(v)', 6)} AS mean, max(v) AS "max",
  arg_max(v, (ts, event_id)) FILTER (v IS NOT NULL) AS last_not_null
FROM (SELECT *, CASE WHEN counter < 90 THEN value END AS v FROM series) GROUP BY ALL
"""))
def series_reducers(spark, sf_dir):
    gappy = views.series(spark, sf_dir).withColumn("value", F.when(F.col("counter") < 90, F.col("value")))
    reduced = series.series_reducers(gappy, ["name", "instance"])
    return reduced.withColumn("mean", pg_round("mean", 6))


@query("histogram_buckets", with_views("series", f"""
WITH bounds AS (SELECT unnest([{', '.join(f"{float(b)!r}e0" for b in series.HISTOGRAM_BOUNDS)}]) AS b,
  unnest([{', '.join(f"'{float(b)}'" for b in series.HISTOGRAM_BOUNDS)}]) AS le),
totals AS (SELECT name, count(value) AS observations, {rounded('sum(value)', 6)} AS total FROM series GROUP BY name),
counted AS (
  SELECT name, le, count(*) FILTER (value <= b) AS bucket_count FROM series CROSS JOIN bounds GROUP BY ALL
  UNION ALL SELECT name, '+Inf', count(value) FROM series GROUP BY name
)
SELECT name, observations, total, le, bucket_count FROM counted JOIN totals USING (name)
"""))
def histogram_buckets(spark, sf_dir):
    buckets = series.histogram_buckets(views.series(spark, sf_dir), ["name"])
    return buckets.withColumn("total", pg_round("total", 6))


@query("run_counters", with_views("runs", """
SELECT 'records_ingested_total' AS metric, l_returnflag AS label, sum(l_quantity) AS value FROM lineitem GROUP BY 2
UNION ALL SELECT 'pipeline_failures_total', dag_id, cast(count(*) FILTER (state <> 'success') AS double)
  FROM runs GROUP BY dag_id
UNION ALL SELECT 'pipeline_last_run_success', dag_id,
  arg_max(CASE WHEN state = 'success' THEN 1.0e0 ELSE 0.0e0 END, (start_date, run_id)) FROM runs GROUP BY dag_id
"""))
def run_counters(spark, sf_dir):
    totals = series.record_totals(views.table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")
    history = views.runs(spark, sf_dir)
    return totals.unionByName(
        series.pipeline_run_metrics(history, "dag_id", F.col("state") == "success", "start_date", "run_id")
    )


FRESHNESS = f"""
SELECT name AS source, max(ts) AS last_seen, (epoch_us({E_NOW}) - epoch_us(max(ts))) / 1e6 AS age_seconds
FROM series GROUP BY name
"""


@query("freshness_gauge", with_views("series", FRESHNESS))
def freshness_gauge(spark, sf_dir):
    return series.freshness_gauge(views.series(spark, sf_dir), "name", "ts", views.now(EVENTS_NOW))


@query("stale_source", with_views("series", FRESHNESS.replace("name AS source", '"user" AS source').replace(
    "GROUP BY name", 'GROUP BY "user" HAVING (epoch_us(' + E_NOW + ') - epoch_us(max(ts))) / 1e6 > 172800')))
def stale_source(spark, sf_dir):
    return series.stale_sources(views.series(spark, sf_dir), "user", "ts", views.now(EVENTS_NOW), 2 * 86_400)


@query("label_regex_match", with_views("series", """
SELECT event_id, name, regexp_full_match(name, 'view|cli.*') AS matches,
  NOT regexp_full_match(name, 'err.*|sign') AS differs FROM series
"""))
def label_regex_match(spark, sf_dir):
    return views.series(spark, sf_dir).select(
        "event_id", "name", label_matches("name", "view|cli.*").alias("matches"),
        label_matches("name", "err.*|sign", negate=True).alias("differs"),
    )


# -- run history --------------------------------------------------------------

@query("idle_busy_percent", with_views("series", f"""
WITH pairs AS (
  SELECT instance, name, epoch_us(ts) AS us, counter AS v, lag(counter) OVER w AS p, lag(epoch_us(ts)) OVER w AS pus
  FROM series WINDOW w AS (PARTITION BY instance, name ORDER BY ts, event_id)
),
instants AS (SELECT DISTINCT instance, name, (us // 3600000000 + 1) * 3600000000 AS t FROM pairs),
rates AS (
  SELECT i.instance, i.name, t,
    sum(CASE WHEN pus >= t - 21600000000 THEN {DELTA} ELSE 0 END) / 21600.0e0 AS rate
  FROM instants i JOIN pairs s ON s.instance = i.instance AND s.name = i.name AND s.us < t AND s.us >= t - 21600000000
  GROUP BY ALL HAVING count(*) >= 2
)
SELECT instance, make_timestamp(t) AS evaluated_at, {rounded('100.0e0 - avg(rate) * 100', 6)} AS busy_percent
FROM rates GROUP BY instance, t
"""))
def idle_busy_percent(spark, sf_dir):
    rates = counters.counter_rate(
        views.series(spark, sf_dir), ["instance", "name"], "counter", window=21_600, step=3_600
    )
    busy = counters.idle_to_busy_percent(rates.where(F.col("rate").isNotNull()), ["instance", "evaluated_at"])
    return busy.withColumn("busy_percent", pg_round("busy_percent", 6))


@query("run_state_counts", with_views("runs", """
SELECT count(*) FILTER (state = 'success') AS n_success, count(*) FILTER (state = 'failed') AS n_failed,
  count(*) FILTER (state = 'running') AS n_running
FROM runs WHERE start_date >= TIMESTAMP '1996-01-01 00:00:00' AND start_date <= TIMESTAMP '1998-12-31 00:00:00'
"""))
def run_state_counts(spark, sf_dir):
    return runs.run_state_counts(
        views.runs(spark, sf_dir), ["success", "failed", "running"], "1996-01-01 00:00:00", "1998-12-31 00:00:00"
    )


@query("success_rate", with_views("runs", f"""
SELECT dag_id, count(*) FILTER (state = 'success') AS successes, count(*) FILTER (state = 'failed') AS failures,
  count(*) AS total,
  {rounded("100.0e0 * count(*) FILTER (state = 'success') / nullif(count(*), 0)", 1)} AS success_rate
FROM runs GROUP BY dag_id
"""))
def success_rate(spark, sf_dir):
    return runs.success_rate(views.runs(spark, sf_dir))


@query("duration_stats", with_views("runs", f"""
SELECT dag_id, count(*) AS runs, {rounded('avg(s)', 1)} AS avg_seconds, {rounded('min(s)', 1)} AS min_seconds,
  {rounded('max(s)', 1)} AS max_seconds, {rounded('stddev_samp(s)', 1)} AS stddev_seconds
FROM (SELECT dag_id, epoch(end_date - start_date) AS s FROM runs WHERE end_date IS NOT NULL) GROUP BY dag_id
"""))
def duration_stats(spark, sf_dir):
    return runs.duration_stats(views.runs(spark, sf_dir))


@query("recent_runs", with_views("runs", f"""
SELECT *, cast(round(epoch(coalesce(end_date, {R_NOW}) - start_date)) AS bigint) AS elapsed_seconds
FROM runs ORDER BY start_date DESC, run_id DESC LIMIT 200
"""))
def recent_runs(spark, sf_dir):
    return runs.recent_runs(views.runs(spark, sf_dir), views.now(RUNS_NOW))


@query("recent_errors", "SELECT doc_id, left(text, 500) AS text FROM documents ORDER BY doc_id DESC LIMIT 50")
def recent_errors(spark, sf_dir):
    return runs.recent_errors(views.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id")


@query("state_timeline", with_views("runs", f"""
SELECT start_date AS time, dag_id AS metric,
  CASE state WHEN 'success' THEN 1 WHEN 'running' THEN 2 WHEN 'failed' THEN 3 WHEN 'queued' THEN 4 ELSE 0 END AS value
FROM runs UNION ALL SELECT coalesce(end_date, {R_NOW}), dag_id, 0 FROM runs
"""))
def state_timeline(spark, sf_dir):
    return runs.state_timeline(views.runs(spark, sf_dir), views.now(RUNS_NOW))


MISSED = f"""
SELECT dag_id FROM dags WHERE has_schedule AND dag_id NOT IN (
  SELECT dag_id FROM customer_runs WHERE start_date >= {R_NOW} - INTERVAL 720 HOUR)
"""
PAUSED = """
SELECT CASE WHEN is_paused IS NULL THEN r.dag_id || ' (NOT FOUND)' ELSE r.dag_id END AS dag_id
FROM required r LEFT JOIN dags d ON r.dag_id = d.dag_id WHERE is_paused IS NULL OR is_paused
"""
STUCK = f"""
SELECT dag_id, run_id, (epoch_us({R_NOW}) - epoch_us(start_date)) / 1e6 AS running_seconds FROM customer_runs
WHERE state = 'running' AND epoch_us({R_NOW}) - epoch_us(start_date) > 14400000000
"""
ANOMALIES = """
SELECT dag_id, count(*) AS runs, arg_min(s, age) AS latest_seconds, avg(s) AS mean_seconds FROM (
  SELECT dag_id, epoch(end_date - start_date) AS s,
    row_number() OVER (PARTITION BY dag_id ORDER BY start_date DESC, run_id DESC) AS age
  FROM customer_runs WHERE state = 'success' QUALIFY age <= 20)
WHERE s IS NOT NULL GROUP BY dag_id HAVING count(*) >= 2 AND arg_min(s, age) > 3.0e0 * avg(s)
"""


def missed(spark, sf_dir):
    # Runs are sparse here: thirty days take the place of one.
    return runs.missed_executions(
        views.dags(spark, sf_dir), views.customer_runs(spark, sf_dir), views.now(RUNS_NOW), hours=720
    )


def paused(spark, sf_dir):
    return runs.paused_or_missing(views.required(spark, sf_dir), views.dags(spark, sf_dir))


def stuck(spark, sf_dir):
    return runs.stuck_runs(views.customer_runs(spark, sf_dir), views.now(RUNS_NOW))


def slow(spark, sf_dir):
    return runs.duration_anomalies(views.customer_runs(spark, sf_dir))


query("missed_executions", with_views("customer_runs", "dags", MISSED))(missed)
query("paused_or_missing", with_views("required", "dags", PAUSED))(paused)
query("stuck_runs", with_views("customer_runs", STUCK))(stuck)


@query("duration_anomaly", with_views("customer_runs", f"""
SELECT dag_id, runs, {rounded('latest_seconds', 3)} AS latest_seconds, {rounded('mean_seconds', 3)} AS mean_seconds
FROM ({ANOMALIES})
"""))
def duration_anomaly(spark, sf_dir):
    found = slow(spark, sf_dir)
    return found.select("dag_id", "runs", *[pg_round(c, 3).alias(c) for c in ("latest_seconds", "mean_seconds")])


@query("ops_report", with_views("customer_runs", "dags", "required", f"""
SELECT (SELECT count(*) FROM ({PAUSED})) AS paused, (SELECT count(*) FROM ({MISSED})) AS missed,
  (SELECT count(*) FROM ({STUCK})) AS stuck, (SELECT count(*) FROM ({ANOMALIES})) AS anomaly,
  (SELECT count(*) FROM ({PAUSED})) + (SELECT count(*) FROM ({MISSED}))
  + (SELECT count(*) FROM ({STUCK})) + (SELECT count(*) FROM ({ANOMALIES})) AS total_issues
"""))
def ops_report(spark, sf_dir):
    return runs.ops_report(
        paused(spark, sf_dir), missed(spark, sf_dir), stuck(spark, sf_dir), slow(spark, sf_dir)
    )


@query("volume_anomaly", f"""
WITH daily AS (
  SELECT cast(d AS timestamp) AS day, count(o_orderkey) AS row_count
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
  LEFT JOIN orders ON cast(o_orderdate AS date) = cast(d AS date) GROUP BY 1
),
scored AS (
  SELECT day, row_count, count(*) OVER w AS baseline_days, avg(row_count) OVER w AS mean,
    stddev_samp(row_count) OVER w AS deviation FROM daily
  WINDOW w AS (ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)
)
SELECT day, row_count, baseline_days, {rounded('z', 6)} AS z_score, coalesce(abs(z) > 3, false) AS is_anomaly
FROM (SELECT *, CASE WHEN baseline_days >= 7 AND deviation > 0 THEN (row_count - mean) / deviation END AS z FROM scored)
""")
def volume_anomaly(spark, sf_dir):
    scored = anomaly.volume_anomaly(views.table(spark, sf_dir, "orders"), "o_orderdate")
    return scored.withColumn("z_score", pg_round("z_score", 6))


# -- alerts -------------------------------------------------------------------

def _rule_sql(rule) -> str:
    sign = "=" if rule.comparison == "==" else rule.comparison
    tests = [f"name = '{rule.metric}'", f"value {sign} {rule.threshold}"]
    tests += [f"regexp_full_match({label}, '{pattern}')" for label, pattern in rule.labels.items()]
    return f"""
  SELECT name, instance, event_id, ts, value, '{rule.alert}' AS alertname, '{rule.severity}' AS severity,
    '{rule.component}' AS component, cast({rule.threshold} AS double) AS threshold, {rule.hold} AS hold_seconds
  FROM metrics WHERE {' AND '.join(tests)}"""


FIRED = " UNION ALL ".join(_rule_sql(r) for r in THRESHOLD_RULES)


def fired(spark, sf_dir):
    return alerts.threshold_alerts(views.metrics(spark, sf_dir))


query("threshold_alerts", with_views("metrics", FIRED))(fired)


@query("alert_groups", with_views("metrics", f"""
SELECT alertname, severity, count(*) AS firing,
  list_aggregate(list_sort(list(DISTINCT component)), 'string_agg', ',') AS components
FROM ({FIRED}) GROUP BY ALL
"""))
def alert_groups(spark, sf_dir):
    return alerts.alert_groups(fired(spark, sf_dir))


@query("alert_throttle", with_views("metrics", f"""
WITH RECURSIVE ticks AS (
  SELECT alertname, severity, epoch_us(ts) // 15000000 * 15000000 AS tick, count(*) AS n,
    cast(CASE severity WHEN 'critical' THEN 3600 ELSE 14400 END AS bigint) * 1000000 AS gap
  FROM ({FIRED}) GROUP BY ALL
),
hops AS (
  SELECT a.alertname, a.severity, a.tick, b.tick AS next_tick
  FROM (SELECT *, tick + gap AS due FROM ticks) a
  ASOF LEFT JOIN ticks b ON a.alertname = b.alertname AND a.severity = b.severity AND a.due <= b.tick
),
sent AS (
  SELECT alertname, severity, min(tick) AS tick FROM ticks GROUP BY ALL
  UNION ALL
  SELECT h.alertname, h.severity, h.next_tick FROM sent s JOIN hops h
    ON s.alertname = h.alertname AND s.severity = h.severity AND s.tick = h.tick WHERE h.next_tick IS NOT NULL
)
SELECT s.alertname, s.severity, make_timestamp(s.tick) AS notified_at, sum(t.n)::bigint AS alerts
FROM (SELECT *, lag(tick) OVER (PARTITION BY alertname, severity ORDER BY tick) AS last_tick FROM sent) s
JOIN ticks t ON t.alertname = s.alertname AND t.severity = s.severity
  AND t.tick <= s.tick AND t.tick > coalesce(s.last_tick, -1)
GROUP BY ALL
"""))
def alert_throttle(spark, sf_dir):
    return alerts.alert_throttle(fired(spark, sf_dir))


# -- all shipped rules ----------------------------------------------------------

NO_MOUNT = "cast(NULL AS varchar) AS mountpoint"
PLAIN_TRUTHS = " UNION ALL ".join(
    f"SELECT '{r.alert}' AS alertname, {r.hold} AS hold, instance, device, mountpoint, step, value "
    f"{'=' if r.comparison == '==' else r.comparison} {r.threshold} AS truth FROM last WHERE name = '{r.metric}'"
    + "".join(f" AND regexp_full_match({label}, '{pattern}')" for label, pattern in r.labels.items())
    for r in THRESHOLD_RULES
)


def _windowed(alert: str, hold: int, metric: str, share: str, window: int, truth: str, where: str = "true") -> str:
    pair = "CASE WHEN v < p THEN v ELSE v - p END" if share == "growth" else "CASE WHEN v <> p THEN 1 ELSE 0 END"
    return f"""
SELECT '{alert}' AS alertname, {hold} AS hold, instance, device, {NO_MOUNT}, step, samples >= 2 AND {truth} AS truth FROM (
  SELECT i.instance, i.device, i.cpu, i.step, count(*) AS samples,
    sum(CASE WHEN s.pus >= (i.step + 1) * 60000000 - {window * 1_000_000} THEN {pair} ELSE 0 END) AS total
  FROM (SELECT DISTINCT instance, device, cpu, step FROM pairs WHERE name = '{metric}' AND {where}) i
  JOIN (SELECT * FROM pairs WHERE name = '{metric}' AND {where}) s
    ON s.instance = i.instance AND s.device IS NOT DISTINCT FROM i.device
    AND s.cpu IS NOT DISTINCT FROM i.cpu AND s.us < (i.step + 1) * 60000000
    AND s.us >= (i.step + 1) * 60000000 - {window * 1_000_000}
  GROUP BY i.instance, i.device, i.cpu, i.step)"""


def _shares(alert: str, part: str, whole: str, truth: str, where: str = "true") -> str:
    return f"""
SELECT '{alert}' AS alertname, 300 AS hold, a.instance, a.device, a.mountpoint, a.step, {truth} AS truth
FROM (SELECT * FROM {'last_disk' if where != 'true' else 'last'} WHERE name = '{part}') a
JOIN (SELECT * FROM {'last_disk' if where != 'true' else 'last'} WHERE name = '{whole}') b
  ON a.instance = b.instance AND a.step = b.step AND a.mountpoint IS NOT DISTINCT FROM b.mountpoint"""


def _and(alert: str, hold: int, first: str, second: str) -> str:
    return f"""
SELECT '{alert}' AS alertname, {hold} AS hold, instance, device, {NO_MOUNT}, step, count(*) FILTER (truth) = 2 AS truth
FROM ({first} UNION ALL {second}) GROUP BY instance, device, step"""


_STACK = "regexp_full_match(instance, 'airflow.*|redis|minio|postgres')"
_CARDS = "NOT regexp_full_match(device, 'lo|veth.*|docker.*|br-.*')"
COMPUTED_TRUTHS = " UNION ALL ".join([
    _windowed("AirflowSchedulerDown", 120, "airflow_scheduler_heartbeat", "growth", 300, "total = 0"),
    _windowed("AirflowHighTaskFailureRate", 300, "airflow_ti_failures", "growth", 900, "total / 900.0e0 > 0.1"),
    _windowed("AirflowZombiesDetected", 0, "airflow_zombies_killed", "growth", 3600, "total > 0"),
    _and(
        "ContainerRestarted", 0,
        f"""SELECT instance, device, step, value > 0 AS truth FROM last
  WHERE name = 'docker_container_restart_count' AND {_STACK}""",
        f"""SELECT instance, device, step, truth FROM ({_windowed(
            "x", 0, "docker_container_start_time_seconds", "changes", 900, "total > 0", _STACK)})""",
    ),
    _shares("ContainerHighMemory", "docker_container_memory_usage_bytes", "docker_container_memory_limit_bytes",
            "a.value / b.value * 100 > 85"),
    """SELECT 'PipelineDataStale', 600, instance, device, mountpoint, step, (step + 1) * 60 - value > 86400
  FROM last WHERE name = 'push_time_seconds'""",
    f"""SELECT 'HostHighCPU', 300, instance, device, {NO_MOUNT}, step, 100.0e0 - avg(total / 300.0e0) * 100 > 85 FROM ({_windowed(
      "x", 0, "node_cpu_seconds_total", "growth", 300, "total >= 0", "mode = 'idle'"
  ).replace("samples >= 2 AND total >= 0 AS truth", "samples, total")}) WHERE samples >= 2 GROUP BY instance, device, step""",
    _shares("HostHighMemory", "node_memory_MemAvailable_bytes", "node_memory_MemTotal_bytes",
            "(1 - a.value / b.value) * 100 > 85"),
    _shares("HostDiskSpaceLow", "node_filesystem_avail_bytes", "node_filesystem_size_bytes",
            "(1 - a.value / b.value) * 100 > 85", "disk"),
    _and("HostNetworkDown", 180, *[
        f"SELECT instance, device, step, truth FROM ({_windowed('x', 0, m, 'growth', 300, 'total = 0', _CARDS)})"
        for m in ("node_network_receive_bytes_total", "node_network_transmit_bytes_total")
    ]),
    _windowed("PrometheusTooManyRestarts", 0, "process_start_time_seconds", "changes", 3600, "total > 2",
              "instance = 'prometheus'"),
])
RULE_OWNERS = {r.alert: (r.severity, r.component) for r in alert_rules.all_named()}


@query("alert_rules", with_views("fast", "samples", f"""
WITH pairs AS (
  SELECT name, instance, device, mode, cpu, epoch_us(ts) AS us, epoch_us(ts) // 60000000 AS step, value AS v,
    lag(value) OVER w AS p, lag(epoch_us(ts)) OVER w AS pus FROM samples
  WINDOW w AS (PARTITION BY name, instance, device, mode, cpu ORDER BY ts, event_id)
),
last AS (
  SELECT name, instance, device, mountpoint, epoch_us(ts) // 60000000 AS step, arg_max(value, (ts, event_id)) AS value
  FROM samples GROUP BY ALL
),
last_disk AS (
  SELECT name, instance, device, mountpoint, epoch_us(ts) // 60000000 AS step, arg_max(value, (ts, event_id)) AS value
  FROM samples WHERE fstype IS DISTINCT FROM 'tmpfs' GROUP BY ALL
),
truths AS ({PLAIN_TRUTHS} UNION ALL {COMPUTED_TRUTHS}),
islands AS (
  SELECT *, row_number() OVER (PARTITION BY alertname, instance, device, mountpoint ORDER BY step)
    - row_number() OVER (PARTITION BY alertname, instance, device, mountpoint, truth ORDER BY step) AS island FROM truths
),
held AS (
  SELECT alertname, instance, device, mountpoint, make_timestamp((min(step) + 1) * 60000000) AS started_at,
    make_timestamp((max(step) + 1) * 60000000) AS ended_at, count(*) AS samples
  FROM islands WHERE truth GROUP BY alertname, hold, instance, device, mountpoint, island
  HAVING (max(step) - min(step)) * 60 >= hold
),
watched AS (
  SELECT 'AirflowSchedulerDown' AS alertname, epoch_us(ts) AS us FROM samples WHERE name = 'airflow_scheduler_heartbeat'
  UNION ALL SELECT 'LokiDown', epoch_us(ts) FROM samples WHERE name = 'up' AND instance = 'loki'
),
span AS (SELECT min(epoch_us(ts)) // 60000000 + 1 AS lo, max(epoch_us(ts)) // 60000000 + 1 AS hi FROM samples),
gaps AS (
  SELECT alertname, us AS a, lead(us) OVER (PARTITION BY alertname ORDER BY us) AS b FROM watched
  UNION ALL SELECT e.alertname, NULL, min(us)
  FROM (VALUES ('AirflowSchedulerDown'), ('LokiDown')) e(alertname) LEFT JOIN watched w ON e.alertname = w.alertname GROUP BY 1
),
absent AS (
  SELECT alertname, greatest(lo, (a + 300000000 + 59999999) // 60000000) AS f, least(hi, (b + 59999999) // 60000000 - 1) AS l
  FROM gaps, span
)
SELECT alertname, CASE alertname WHEN 'LokiDown' THEN 'warning' ELSE 'critical' END AS severity,
  CASE alertname WHEN 'LokiDown' THEN 'monitoring' ELSE 'scheduler' END AS component,
  CASE alertname WHEN 'LokiDown' THEN 'loki' END AS instance, NULL AS device, NULL AS mode, NULL AS fstype, NULL AS cpu,
  NULL AS mountpoint, make_timestamp(f * 60000000) AS started_at, make_timestamp(l * 60000000) AS ended_at, l - f + 1 AS samples
FROM absent WHERE f <= l AND (l - f) * 60 >= 120
UNION ALL
SELECT alertname, severity, component, instance, device, cast(NULL AS varchar) AS mode,
  CASE alertname WHEN 'HostDiskSpaceLow' THEN 'ext4' END AS fstype,
  cast(NULL AS varchar) AS cpu, mountpoint, started_at, ended_at, samples FROM held JOIN (VALUES
  {', '.join(f"('{name}', '{severity}', '{part}')" for name, (severity, part) in RULE_OWNERS.items())}
) o(alertname, severity, component) USING (alertname)
"""))
def all_rules(spark, sf_dir):
    """All rules over all samples, held for their required time."""
    return alert_rules.all_rule_alerts(views.rule_samples(spark, sf_dir))


@query("absent_rules", with_views("fast", "samples", """
SELECT * FROM (VALUES ('AirflowSchedulerDown', 'airflow_scheduler_heartbeat', ''), ('LokiDown', 'up', 'loki'))
  e(alertname, name, instance)
WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.name = e.name AND (e.instance = '' OR s.instance = e.instance)
  AND ts > TIMESTAMP '2024-01-01 05:55:00' AND ts <= TIMESTAMP '2024-01-01 06:00:00')
"""))
def absent_rules(spark, sf_dir):
    return alert_rules.absence_alerts(views.rule_samples(spark, sf_dir), views.now("2024-01-01 06:00:00"))


# -- logs ---------------------------------------------------------------------

IS_ERROR = "regexp_matches(line, '(?i)(error|exception|traceback|warning|import|module|no module|syntaxerror|cannot)')"


@query("log_regex_filter", with_views("logs", f"SELECT * FROM logs WHERE {IS_ERROR}"))
def log_regex_filter(spark, sf_dir):
    return logs.error_lines(views.logs(spark, sf_dir))


@query("log_error_counts", with_views("logs", f"""
SELECT container_name, count(*) AS lines FROM logs WHERE {IS_ERROR} GROUP BY container_name
"""))
def log_error_counts(spark, sf_dir):
    return logs.log_error_counts(views.logs(spark, sf_dir), ["container_name"])


@query("log_line_format", with_views("logs", """
SELECT ts, '[' || container_name || '] ' || line AS formatted FROM logs
"""))
def log_line_format(spark, sf_dir):
    return logs.formatted_lines(views.logs(spark, sf_dir)).select("ts", "formatted")


@query("late_reject", with_views("logs", f"SELECT * FROM logs WHERE ts >= {E_NOW} - INTERVAL 168 HOUR"))
def late_reject(spark, sf_dir):
    return logs.reject_old(views.logs(spark, sf_dir), "ts", views.now(EVENTS_NOW))


# -- containers and names -----------------------------------------------------

@query("relabel", with_views("containers", "SELECT event_id, ltrim(name, '/') AS container_name FROM containers"))
def relabelled(spark, sf_dir):
    return views.containers(spark, sf_dir).select("event_id", relabel("name").alias("container_name"))


@query("status_code_map", with_views("containers", """
SELECT event_id, CASE health WHEN 'healthy' THEN 1.0e0 WHEN 'starting' THEN 0.5e0 WHEN 'unhealthy' THEN 0.0e0
  ELSE -1.0e0 END AS health_code, CASE state WHEN 'running' THEN 1 ELSE 0 END AS running FROM containers
"""))
def status_code_map(spark, sf_dir):
    return views.containers(spark, sf_dir).select(
        "event_id", box.health_code("health").alias("health_code"), box.running_flag("state").alias("running")
    )


@query("cpu_percent", with_views("containers", f"""
SELECT event_id, {rounded('''coalesce(CASE WHEN k > user_id % 50 AND user_id % 9 <> 0 THEN
  k * 7.0e0 / ((k - user_id % 50) * 11) * coalesce(nullif(user_id % 5, 0), 1) * 100 END, 0)''', 6)} AS cpu_percent
FROM containers
"""))
def cpu_percent(spark, sf_dir):
    share = box.cpu_percent("cpu_total", "precpu_total", "system_cpu", "presystem_cpu", "online_cpus")
    return views.containers(spark, sf_dir).select("event_id", pg_round(share, 6).alias("cpu_percent"))


@query("map_value_sum", with_views("containers", """
SELECT event_id, CASE kind WHEN 'view' THEN 0 ELSE user_id * 10 END AS rx_bytes,
  CASE kind WHEN 'view' THEN 0 WHEN 'error' THEN user_id ELSE user_id + k END AS tx_bytes FROM containers
"""))
def map_value_sum(spark, sf_dir):
    return views.containers(spark, sf_dir).select(
        "event_id", box.network_total("networks", "rx_bytes").alias("rx_bytes"),
        box.network_total("networks", "tx_bytes").alias("tx_bytes"),
    )


@query("uptime_seconds", with_views("containers", f"""
SELECT event_id, CASE WHEN kind NOT IN ('click', 'view') THEN cast(floor(epoch(ts)) AS bigint) END AS started,
  CASE WHEN kind NOT IN ('click', 'view', 'signup') THEN cast(epoch({E_NOW}) AS bigint) - cast(floor(epoch(ts)) AS bigint)
  END AS uptime FROM containers
"""))
def uptime_seconds(spark, sf_dir):
    return views.containers(spark, sf_dir).select(
        "event_id", box.start_epoch("started_at").alias("started"),
        box.uptime_seconds("started_at", "state", views.now(EVENTS_NOW)).alias("uptime"),
    )


def _glob_sql() -> tuple[str, str]:
    names, labels = [], []
    for pattern, name, keys in METRIC_RULES:
        regex = "^" + pattern.replace(".", "[.]").replace("*", "([^.]+)") + "$"
        names.append(f"WHEN regexp_matches(dotted, '{regex}') THEN '{name}'")
        parts = " || ',' || ".join(
            f"'{key}=' || regexp_extract(dotted, '{regex}', {i})" for i, key in enumerate(keys, 1)
        )
        labels.append(f"WHEN regexp_matches(dotted, '{regex}') THEN {parts or chr(39) * 2}")
    return f"CASE {' '.join(names)} ELSE '{UNMAPPED}' END", f"CASE {' '.join(labels)} ELSE '' END"


@query("metric_name_mapping", with_views("metric_names", """
SELECT event_id, {} AS name, {} AS labels FROM metric_names
""".format(*_glob_sql())))
def metric_name_mapping(spark, sf_dir):
    mapped = with_metric_name(views.metric_names(spark, sf_dir), "dotted", "m")
    pairs = F.transform(F.map_entries("m.labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return mapped.select("event_id", F.col("m.name").alias("name"), F.array_join(pairs, ",").alias("labels"))
