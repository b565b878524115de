"""Contracts, checks and suites over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.functions import pg_round
from stratus.operators import contracts, profiles, quality
from stratus.operators.contracts import CURRENT_CONTRACT
from stratus.operators.quality import SUITES, Check
from stratus.plans import medallion
from stratus.session import work_path
from stratus.sources.export import write_report
from stratus.streaming.parts import PartTable
from stratus.workload import layers, views
from stratus.workload.registry import query
from stratus.workload.views import EVENTS_NOW, rounded, with_views

E_NOW = f"TIMESTAMP '{EVENTS_NOW}'"


# -- contracts ----------------------------------------------------------------

KIND = (
    "CASE json_type({j}) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' "
    "WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END"
)
ACCEPTS = {
    "string": ["str"], "integer": ["int", "bool"], "number": ["int", "float", "bool"], "array": ["list"],
    "object": ["dict"],
}


def _error_cases(fields, path: str = "$", shown: str = "", guard: str = "true") -> list[str]:
    cases = []
    for spec in fields:
        here, label = f"{path}.{spec.name}", f"{shown}.{spec.name}" if shown else spec.name
        j = f"json_extract(doc, '{here}')"
        kind = KIND.format(j=j)
        missing = f"'Missing required field: {label}'" if spec.required else "NULL"
        case = f"CASE WHEN {guard} AND {j} IS NULL THEN {missing}"
        if spec.type in ACCEPTS:
            accepted = ", ".join(f"'{k}'" for k in ACCEPTS[spec.type])
            case += (
                f" WHEN {j} IS NOT NULL AND {kind} NOT IN ({accepted})"
                f" THEN 'Type mismatch at {label}: expected {spec.type}, got ' || {kind}"
            )
        cases.append(case + " END")
        if spec.type == "object":
            cases += _error_cases(spec.fields, here, label, f"coalesce(json_type({j}) = 'OBJECT', false)")
    return cases


CHECKED = f"""
parsed AS (
  SELECT event_id, ts, CASE WHEN json_valid(raw_json) THEN cast(raw_json AS json) END AS doc FROM payloads),
checked AS (
  SELECT event_id, ts, doc IS NULL AS malformed, CASE WHEN doc IS NOT NULL THEN
    [x FOR x IN [{', '.join(_error_cases(CURRENT_CONTRACT.fields))}] IF x IS NOT NULL] END AS errors
  FROM parsed)
"""


def _joined(condition: str) -> str:
    return with_views("payloads", f"""
WITH {CHECKED}
SELECT event_id, CASE WHEN NOT malformed THEN array_to_string([x FOR x IN errors IF {condition}], '; ') END AS errors
FROM checked
""")


def checked(spark, sf_dir):
    return contracts.check_contract(views.payloads(spark, sf_dir), "raw_json", CURRENT_CONTRACT)


def _errors(spark, sf_dir, keep):
    found = F.array_join(F.filter("contract_errors", keep), "; ")
    return checked(spark, sf_dir).select("event_id", found.alias("errors"))


@query("contract_missing", _joined("starts_with(x, 'Missing')"))
def contract_missing(spark, sf_dir):
    return _errors(spark, sf_dir, lambda e: e.startswith("Missing"))


@query("contract_types", _joined("starts_with(x, 'Type')"))
def contract_types(spark, sf_dir):
    return _errors(spark, sf_dir, lambda e: e.startswith("Type"))


@query("contract_nested", _joined("contains(x, 'main.') OR contains(x, 'wind.') OR contains(x, 'coord.')"))
def contract_nested(spark, sf_dir):
    return _errors(spark, sf_dir, lambda e: e.rlike("(main|wind|coord)[.]"))


@query("contract_quarantine", with_views("payloads", f"""
WITH {CHECKED}
SELECT event_id, malformed, cast(len(errors) AS int) AS error_count,
  CASE WHEN malformed OR len(errors) > 0 THEN 'quarantine' ELSE 'valid' END AS target FROM checked
"""))
def contract_quarantine(spark, sf_dir):
    """Stores both sides in one pass and reads them back."""
    valid, broken = contracts.store_split(checked(spark, sf_dir), work_path(spark, "checked"))
    both = valid.unionByName(broken)
    count = F.when(~F.col("malformed"), F.size("contract_errors"))
    return both.select("event_id", "malformed", count.alias("error_count"), "target")


@query("row_freshness", f"""
SELECT event_id, coalesce((epoch_us(TIMESTAMP '2024-01-15 12:00:00') / 1e6 - dt) / 60 <= 360, true) AS is_fresh
FROM (SELECT event_id, CASE WHEN user_id % 13 <> 0 THEN cast(floor(epoch(ts)) AS bigint) END AS dt FROM events)
""")
def row_freshness(spark, sf_dir):
    dt = F.when(F.col("user_id") % 13 != 0, F.unix_timestamp(F.col("ts").cast("timestamp")))
    fresh = contracts.row_freshness(dt, CURRENT_CONTRACT, views.now("2024-01-15 12:00:00"))
    return views.table(spark, sf_dir, "events").select("event_id", fresh.alias("is_fresh"))


# -- checks -------------------------------------------------------------------

DIRTY = """
dirty AS (
  SELECT row_id, CASE WHEN cast(row_id AS bigint) % 50 <> 0 THEN city_name END AS city_name,
    CASE WHEN cast(row_id AS bigint) % 7 = 0 THEN -temperature_celsius ELSE temperature_celsius END
      AS temperature_celsius,
    CASE WHEN cast(row_id AS bigint) % 11 = 0 THEN NULL ELSE humidity_percent END AS humidity_percent,
    measured_at
  FROM obs)
"""


def dirty(spark, sf_dir):
    number = F.col("row_id").cast("bigint")
    return views.obs(spark, sf_dir).select(
        "row_id",
        F.when(number % 50 != 0, F.col("city_name")).alias("city_name"),
        F.when(number % 7 == 0, -F.col("temperature_celsius")).otherwise(F.col("temperature_celsius")).alias(
            "temperature_celsius"
        ),
        F.when(number % 11 != 0, F.col("humidity_percent")).alias("humidity_percent"),
        "measured_at",
    )


def check_sql(check: Check, source: str, target: str) -> str:
    """What a check must report, stated per check as its own query."""
    c = check.column
    column = f"'{c}'" if c else "cast(NULL AS varchar)"
    bad = " OR ".join(
        [f"{c} < {check.low}"] * (check.low is not None) + [f"{c} > {check.high}"] * (check.high is not None)
    )
    if check.kind == "row_count":
        observed, failures = "count(*)", f"CASE WHEN count(*) < {check.limit} THEN 1 ELSE 0 END"
    elif check.kind == "column_exists":
        observed, failures = f"count({c})", "0"
    elif check.kind == "not_null":
        observed = failures = f"count(*) FILTER ({c} IS NULL)"
    elif check.kind in ("between", "value_range"):
        observed = failures = f"count(*) FILTER ({bad})"
    elif check.kind == "not_null_rate":
        observed = f"cast(count(*) FILTER ({c} IS NULL) AS double) / nullif(count(*), 0)"
        failures = f"CASE WHEN {observed} > {check.limit} THEN count(*) FILTER ({c} IS NULL) ELSE 0 END"
    elif check.kind == "freshness_hours":
        observed = f"(epoch_us({E_NOW}) - epoch_us(max({c}))) / 1e6"
        failures = f"CASE WHEN max({c}) < {E_NOW} - INTERVAL {check.limit:g} HOUR OR max({c}) IS NULL THEN 1 ELSE 0 END"
    else:
        source = f"(SELECT count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"
        observed = failures = "count(*) FILTER (n > 1)"
    return f"""
SELECT '{check.label}' AS "check", '{target}' AS target, {column} AS "column", '{check.severity}' AS severity,
  ({failures}) = 0 AS success, cast({observed} AS double) AS observed, cast({failures} AS bigint) AS failures
FROM {source}"""


def _register(name: str, *checks: Check) -> None:
    union = " UNION ALL ".join(check_sql(c, "dirty", "observations") for c in checks)

    @query(name, with_views("obs", f"WITH {DIRTY} {union}"))
    def run(spark, sf_dir):
        return quality.run_checks(dirty(spark, sf_dir), "observations", checks, EVENTS_NOW)


_register("freshness_hours", Check("freshness_hours", "measured_at", limit=24),
          Check("freshness_hours", "measured_at", limit=48))
_register("not_null_rate", Check("not_null_rate", "city_name", limit=0.05),
          Check("not_null_rate", "humidity_percent", limit=0.05))
_register("value_range", Check("value_range", "temperature_celsius", -90, 60),
          Check("value_range", "humidity_percent", low=10), Check("value_range", "humidity_percent", high=100))
_register("check_row_count", Check("row_count", limit=1), Check("row_count", limit=1_000_000_000))
_register("check_columns_exist", *[Check("column_exists", c) for c in (
    "city_name", "temperature_celsius", "humidity_percent", "measured_at")])
_register("check_not_null", *[Check("not_null", c) for c in ("city_name", "temperature_celsius", "humidity_percent")])
_register("check_between", Check("between", "temperature_celsius", -60.0, 60.0, severity="warning"),
          Check("between", "temperature_celsius", -90, 60), Check("between", "humidity_percent", 0, 100))
_register("check_unique", Check("unique", "row_id"), Check("unique", "city_name"))


# -- suites -------------------------------------------------------------------

def _suite_sql() -> str:
    sources = {
        "stg_weather_current": "obs", "stg_weather_forecast": "fc",
        "weather_daily_summary": "daily", "city_weather_metrics": "city_metrics",
    }
    rows = [
        f"SELECT '{s.name}' AS suite, '{s.layer}' AS layer, success FROM ({check_sql(c, sources[s.table], s.table)})"
        for s in SUITES for c in s.checks
    ]
    return f"""
WITH {layers.COMBINED}, {layers.daily_sql('combined')}, {layers.METRICS_SQL},
checks AS ({' UNION ALL '.join(rows)})
SELECT suite, layer, bool_and(success) AS success, count(*) AS checks, count(*) FILTER (NOT success) AS failed
FROM checks GROUP BY suite, layer
"""


def suite_results(spark, sf_dir):
    """The marts that suites look at are built and stored, and checked while they are written."""
    models = tuple(m for m in medallion.MODELS if m.name in {s.table for s in SUITES})
    return medallion.build_checked_layers(
        spark, views.obs(spark, sf_dir), views.fc(spark, sf_dir), work_path(spark, "checked-layers"), models, now=EVENTS_NOW
    )[1]


@query("quality_suite", with_views("obs", "fc", _suite_sql()))
def quality_suite(spark, sf_dir):
    return quality.suite_verdicts(suite_results(spark, sf_dir))


REPORT_CHECKS = (
    Check("row_count", limit=1), Check("not_null", "city_name"), Check("not_null", "humidity_percent"),
    Check("between", "temperature_celsius", -60.0, 60.0, severity="warning"),
)


@query("quality_report_sink", with_views("obs", f"""
WITH {DIRTY} {" UNION ALL ".join(check_sql(c, "dirty", "observations") for c in REPORT_CHECKS)}
"""))
def quality_report_sink(spark, sf_dir):
    """Writes a report as partitioned JSON and reads it back."""
    path = work_path(spark, "reports")
    results = quality.run_checks(dirty(spark, sf_dir), "observations", REPORT_CHECKS)
    write_report(results, path, "checks_staging", "20240201T000000")
    stored = spark.read.schema(f"{quality.RESULT}, report string, run_ts string").json(path)
    return stored.drop("report", "run_ts")


@query("schema_changes", with_views("payloads", f"""
WITH docs AS (SELECT cast(raw_json AS json) AS doc FROM payloads WHERE json_valid(raw_json)),
seen AS (
  SELECT DISTINCT k AS "column", {KIND.format(j="json_extract(doc, '$.' || k)")} AS new_type
  FROM (SELECT doc, unnest(json_keys(doc)) AS k FROM docs)),
known AS (SELECT * FROM (VALUES ('name', 'str'), ('dt', 'int'), ('main', 'dict'), ('coord', 'dict'),
  ('weather', 'list'), ('visibility', 'int')) t("column", old_type))
SELECT "column", CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed'
  ELSE 'type_changed' END AS change, old_type, new_type
FROM known FULL JOIN seen USING ("column") WHERE old_type IS DISTINCT FROM new_type
"""))
def schema_changes(spark, sf_dir):
    """Fields of the landed payloads against a stored baseline."""
    baseline = spark.createDataFrame(
        [("name", "str"), ("dt", "int"), ("main", "dict"), ("coord", "dict"), ("weather", "list"), ("visibility", "int")],
        "column string, type string",
    )
    seen = quality.payload_schema(views.payloads(spark, sf_dir), "raw_json").select("column", "type")
    return quality.schema_changes(baseline, seen)


@query("column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) - count({c}) AS null_count,
  {f"cast(min({c}) AS double)" if number else "cast(NULL AS double)"} AS "min",
  {f"cast(max({c}) AS double)" if number else "cast(NULL AS double)"} AS "max",
  {rounded(f"avg({c})", 6) if number else "cast(NULL AS double)"} AS mean,
  {f"count(DISTINCT {c})" if exact else "cast(NULL AS bigint)"} AS distinct_count FROM lineitem"""
    for c, number, exact in (
        ("l_orderkey", True, False), ("l_quantity", True, True), ("l_extendedprice", True, False),
        ("l_returnflag", False, True), ("l_linestatus", False, True),
    )
))
def column_profile(spark, sf_dir):
    profile = quality.column_profile(
        views.table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"],
        exact_distinct=["l_quantity", "l_returnflag", "l_linestatus"],
    )
    # The estimate is left out here: it has no exact counterpart to compare with.
    return profile.drop("distinct_estimate").withColumn("mean", pg_round("mean", 6))


PROFILED = {
    "l_orderkey": "number", "l_quantity": "number", "l_extendedprice": "number", "l_returnflag": "text", "l_linestatus": "text",
    "l_shipdate": "time",
}


@query("profile_by_load", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) - count({c}) AS null_count,
  {f"cast(min({c}) AS double)" if kind == "number" else "cast(NULL AS double)"} AS "min",
  {f"cast(max({c}) AS double)" if kind == "number" else "cast(NULL AS double)"} AS "max",
  {f"cast(min({c}) AS varchar)" if kind != "number" else "cast(NULL AS varchar)"} AS min_text,
  {f"cast(max({c}) AS varchar)" if kind != "number" else "cast(NULL AS varchar)"} AS max_text,
  {rounded(f"avg({c})", 6) if kind == "number" else "cast(NULL AS double)"} AS mean,
  true AS distinct_within, {"true" if kind == "number" else "cast(NULL AS boolean)"} AS median_within FROM lineitem"""
    for c, kind in PROFILED.items()
))
def profile_by_load(spark, sf_dir):
    """A profile kept per load, one for each ship year, and merged; its estimates are held against exact counts."""
    rows = views.table(spark, sf_dir, "lineitem").select(*PROFILED)
    year = F.year("l_shipdate")
    years = [r[0] for r in rows.select(year).distinct().collect()]  # one row per load
    schema = profiles.profile_parts(rows.limit(0), list(PROFILED)).schema
    table = PartTable(spark, work_path(spark, "profiles"), schema, profiles.merge_profiles)
    for load in years:
        table.commit(f"year={load}", profiles.profile_parts(rows.where(year.eqNullSafe(F.lit(load))), list(PROFILED)))
    report = profiles.profile_report(table.rows())
    medians = {r["column"]: r["p50"] for r in report.select("column", "p50").collect()}  # one row per column

    exact, held = [], []
    for i, (c, kind) in enumerate(PROFILED.items()):
        median, within = F.lit(medians.get(c)).cast("double"), F.lit(None).cast("boolean")
        exact += [F.count_distinct(F.col(c)).alias(f"d{i}")]
        if kind == "number":
            exact += [profiles.rank_around(F.col(c).cast("double"), median).alias(f"m{i}")]
            within = profiles.within_ranks(F.col(f"m{i}"), median, 0.5 - profiles.RANK_ERROR, 0.5 + profiles.RANK_ERROR)
        held.append(F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("_distinct"), within.alias("_within")))
    known = rows.agg(*exact).select(F.inline(F.array(*held)))
    error = F.abs(F.col("distinct_estimate") - F.col("_distinct")) <= F.col("_distinct") * profiles.DISTINCT_ERROR
    return report.join(known, "column").select(
        "column", "row_count", "null_count", "min", "max", "min_text", "max_text", pg_round("mean", 6).alias("mean"),
        error.alias("distinct_within"), F.col("_within").alias("median_within"),
    )
