"""Views over the given tables that have the shapes the operators work on.

Every view exists twice: as a DataFrame and as SQL text for the check. The
SQL texts refer to the given tables by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_NOW = "2024-02-01 00:00:00"
RUNS_NOW = "2001-08-02 00:00:00"
LOADED_AT = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def now(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def obs_columns(events: DataFrame) -> DataFrame:
    """Observations; works on the table and on a stream of it."""
    place = F.col("user_id") % 20
    return events.select(
        F.col("event_id").cast("string").alias("row_id"),
        F.concat(F.lit("city_"), place.cast("string")).alias("city_name"),
        F.concat(F.lit("K"), (F.col("user_id") % 7).cast("string")).alias("country_code"),
        F.col("value").alias("temperature_celsius"),
        (F.col("value") - 1.5).alias("feels_like_celsius"),
        _k().alias("humidity_percent"),
        (_k() + 950).alias("pressure_hpa"),
        (F.col("user_id") % 30).cast("double").alias("wind_speed_ms"),
        F.col("event_type").alias("weather_condition"),
        F.concat("event_type", F.lit(" sky")).alias("weather_description"),
        _k().alias("cloud_coverage_percent"),
        (place.cast("double") * 1.5).alias("latitude"),
        ((F.col("user_id") % 90).cast("double") - 45.0).alias("longitude"),
        (F.col("user_id") + 1000).alias("visibility_meters"),
        F.col("ts").alias("measured_at"),
        F.lit("load-1").alias("load_id"),
        now(LOADED_AT).alias("loaded_at"),
    )


OBS = """
SELECT cast(event_id AS varchar) AS row_id,
  'city_' || cast(user_id % 20 AS varchar) AS city_name,
  'K' || cast(user_id % 7 AS varchar) AS country_code,
  value AS temperature_celsius, value - 1.5e0 AS feels_like_celsius,
  cast(json_extract_string(props, '$.k') AS bigint) AS humidity_percent,
  cast(json_extract_string(props, '$.k') AS bigint) + 950 AS pressure_hpa,
  cast(user_id % 30 AS double) AS wind_speed_ms,
  event_type AS weather_condition, event_type || ' sky' AS weather_description,
  cast(json_extract_string(props, '$.k') AS bigint) AS cloud_coverage_percent,
  cast(user_id % 20 AS double) * 1.5e0 AS latitude,
  cast(user_id % 90 AS double) - 45.0e0 AS longitude,
  user_id + 1000 AS visibility_meters,
  ts AS measured_at, 'load-1' AS load_id, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
FROM events
"""


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_columns(table(spark, sf_dir, "events"))


def fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast slots: orders are the parents, line items the slots."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    items = table(spark, sf_dir, "lineitem")
    shift = (F.dayofyear("l_shipdate") % 30).cast("int")
    return orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("city_"), (F.col("o_custkey") % 20).cast("string")).alias("city_name"),
        F.concat(F.lit("K"), (F.col("o_custkey") % 7).cast("string")).alias("country_code"),
        F.col("o_orderpriority").alias("weather_condition"),
        (F.col("l_extendedprice") / 1000).alias("temperature_celsius"),
        (F.col("l_extendedprice") / 1000 - 2.0).alias("feels_like_celsius"),
        F.col("l_quantity").cast("bigint").alias("humidity_percent"),
        (F.col("l_linenumber") + 1000).cast("bigint").alias("pressure_hpa"),
        F.col("l_linenumber").cast("double").alias("wind_speed_ms"),
        F.date_add(F.lit("2024-01-01").cast("date"), shift).cast("timestamp_ntz").alias("forecast_at"),
    )


FC = """
SELECT 'city_' || cast(o_custkey % 20 AS varchar) AS city_name,
  'K' || cast(o_custkey % 7 AS varchar) AS country_code,
  o_orderpriority AS weather_condition,
  l_extendedprice / 1000 AS temperature_celsius, l_extendedprice / 1000 - 2.0e0 AS feels_like_celsius,
  cast(l_quantity AS bigint) AS humidity_percent, cast(l_linenumber + 1000 AS bigint) AS pressure_hpa,
  cast(l_linenumber AS double) AS wind_speed_ms,
  cast(DATE '2024-01-01' + cast(dayofyear(l_shipdate) % 30 AS int) AS timestamp) AS forecast_at
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""


def forecast_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast payload parents in their nested, landed form."""
    place = F.col("o_custkey") % 20
    city = F.struct(
        F.concat(F.lit("city_"), place.cast("string")).alias("name"),
        F.concat(F.lit("K"), (F.col("o_custkey") % 7).cast("string")).alias("country"),
        F.struct(
            (place.cast("double") * 1.5).alias("lat"), place.cast("double").alias("lon")
        ).alias("coord"),
    )
    return table(spark, sf_dir, "orders").select(
        city.alias("city"), F.lit("load-1").alias("load_id"), F.col("o_orderkey").cast("string").alias("row_id")
    )


def forecast_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast slots in their nested, landed form."""
    day = F.dayofyear("l_shipdate") % 30
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("_parent_id"),
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("_row_id"),
        F.struct(
            (F.col("l_extendedprice") / 1000).alias("temp"),
            (F.col("l_extendedprice") / 1000 - 2.0).alias("feels_like"),
            F.col("l_quantity").cast("bigint").alias("humidity"),
            (F.col("l_linenumber") + 1000).cast("bigint").alias("pressure"),
        ).alias("main"),
        F.array(F.struct(
            F.col("l_returnflag").alias("main"), F.col("l_linestatus").alias("description")
        )).alias("weather"),
        F.struct(F.col("l_linenumber").cast("double").alias("speed")).alias("wind"),
        F.struct(F.col("l_quantity").cast("bigint").alias("all")).alias("clouds"),
        F.col("l_discount").alias("pop"),
        (F.lit(1704067200) + day * 86400).cast("bigint").alias("dt"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history from orders: one entity per priority, length from the price."""
    state = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed")
    length = F.make_dt_interval(secs=F.floor("o_totalprice").cast("decimal(18,6)"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dag_id"),
        F.col("o_orderkey").alias("run_id"),
        state.otherwise("running").alias("state"),
        F.col("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + length).alias("end_date"),
    )


RUNS = """
SELECT o_orderpriority AS dag_id, o_orderkey AS run_id,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS state,
  o_orderdate AS start_date,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(cast(floor(o_totalprice) AS bigint)) END AS end_date
FROM orders
"""


def customer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history with one entity per customer group and a long tail of run lengths."""
    price = F.col("o_totalprice")
    length = F.make_dt_interval(secs=F.floor(price * price * price / 1e12).cast("decimal(18,6)"))
    state = F.when(F.col("o_orderstatus") == "P", "running").otherwise("success")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("dag_"), (F.col("o_custkey") % 300).cast("string")).alias("dag_id"),
        F.col("o_orderkey").alias("run_id"),
        state.alias("state"),
        F.col("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + length).alias("end_date"),
    )


CUSTOMER_RUNS = """
SELECT 'dag_' || cast(o_custkey % 300 AS varchar) AS dag_id, o_orderkey AS run_id,
  CASE o_orderstatus WHEN 'P' THEN 'running' ELSE 'success' END AS state, o_orderdate AS start_date,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate
    + to_seconds(cast(floor(o_totalprice * o_totalprice * o_totalprice / 1e12) AS bigint)) END AS end_date
FROM orders
"""


def dags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known entities with their pause flag and whether they have a schedule."""
    return table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("dag_"), (F.col("o_custkey") % 300).cast("string")).alias("dag_id")
    ).agg(
        (F.max("o_totalprice") > 499000).alias("is_paused"), (F.min("o_totalprice") < 20000).alias("has_schedule")
    )


DAGS = """
SELECT 'dag_' || cast(o_custkey % 300 AS varchar) AS dag_id,
  max(o_totalprice) > 499000 AS is_paused, min(o_totalprice) < 20000 AS has_schedule
FROM orders GROUP BY 1
"""


def required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that must exist: one per customer group, more groups than there are entities."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("dag_"), (F.col("c_custkey") % 320).cast("string")).alias("dag_id")
    ).distinct()


REQUIRED = "SELECT DISTINCT 'dag_' || cast(c_custkey % 320 AS varchar) AS dag_id FROM customer"


def series_columns(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("name"),
        F.concat(F.lit("i"), (F.col("user_id") % 4).cast("string")).alias("instance"),
        F.col("user_id").alias("user"),
        "event_id",
        "ts",
        "value",
        _k().alias("counter"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_columns(table(spark, sf_dir, "events"))


SERIES = """
SELECT event_type AS name, 'i' || cast(user_id % 4 AS varchar) AS instance, user_id AS "user",
  event_id, ts, value, cast(json_extract_string(props, '$.k') AS bigint) AS counter
FROM events
"""

# Event type to the metric it stands for in rule checks.
METRIC_OF = {
    "click": "airflow_executor_open_slots",
    "error": "airflow_dag_processing_import_errors",
    "purchase": "up",
    "signup": "docker_container_health_status",
    "view": "docker_container_cpu_usage_percent",
}
INSTANCE_OF = ("airflow-scheduler", "redis", "pushgateway", "loki")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples under the metric names the shipped rules refer to; flags are floored values."""
    names = F.create_map(*[F.lit(x) for pair in METRIC_OF.items() for x in pair])
    instances = F.array(*[F.lit(x) for x in INSTANCE_OF])
    flags = F.col("event_type").isin("purchase", "signup")
    return table(spark, sf_dir, "events").select(
        names[F.col("event_type")].alias("name"),
        F.get(instances, (F.col("user_id") % 4).cast("int")).alias("instance"),
        "event_id",
        "ts",
        F.when(flags, F.floor(F.col("value") / 10).cast("double")).otherwise(F.col("value")).alias("value"),
    )


METRICS = f"""
SELECT CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_OF.items())} END AS name,
  CASE user_id % 4 {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(INSTANCE_OF))} END AS instance,
  event_id, ts,
  CASE WHEN event_type IN ('purchase', 'signup') THEN floor(value / 10) ELSE value END AS value
FROM events
"""


# Per event type the samples it stands for, as (metric, value), and the labels that go with a metric.
RULE_SAMPLES = {
    "click": (
        ("airflow_scheduler_heartbeat", "floor(value / 20)"), ("airflow_ti_failures", "k * 10"),
        ("airflow_executor_open_slots", "k % 6"),
    ),
    "error": (
        ("airflow_dag_processing_import_errors", "k % 3"), ("airflow_zombies_killed", "floor(k / 80)"),
        ("docker_container_running", "k % 2"), ("process_start_time_seconds", "k % 4"),
    ),
    "view": (
        ("docker_container_restart_count", "floor(k / 50)"), ("docker_container_start_time_seconds", "floor(k / 60)"),
        ("docker_container_cpu_usage_percent", "value"), ("docker_container_memory_usage_bytes", "k"),
        ("docker_container_memory_limit_bytes", "90"), ("docker_container_health_status", "k % 2"),
    ),
    "signup": (
        ("push_time_seconds", "1704067200 - k * 2000"), ("up", "k % 2"), ("node_cpu_seconds_total", "k"),
        ("node_memory_MemAvailable_bytes", "k"), ("node_memory_MemTotal_bytes", "200"),
    ),
    "purchase": (
        ("node_filesystem_avail_bytes", "k"), ("node_filesystem_size_bytes", "200"),
        ("node_network_receive_bytes_total", "floor(k / 90)"), ("node_network_transmit_bytes_total", "floor(k / 90)"),
    ),
}
RULE_INSTANCES = ("airflow-scheduler", "redis", "pushgateway", "prometheus")
RULE_DEVICE = "CASE WHEN name LIKE 'node_network%' THEN CASE WHEN u % 8 < 4 THEN 'eth0' ELSE 'lo' END END"
RULE_MODE = "CASE WHEN name = 'node_cpu_seconds_total' THEN CASE WHEN u % 16 < 8 THEN 'idle' ELSE 'user' END END"
RULE_FSTYPE = "CASE WHEN name LIKE 'node_filesystem%' THEN CASE WHEN u % 8 < 4 THEN 'ext4' ELSE 'tmpfs' END END"
RULE_CPU = "CASE WHEN name = 'node_cpu_seconds_total' THEN CASE WHEN u % 32 < 16 THEN '0' ELSE '1' END END"
RULE_MOUNT = "CASE WHEN name LIKE 'node_filesystem%' THEN CASE WHEN u % 16 < 8 THEN '/' ELSE '/data' END END"
_RULE_INSTANCE = "CASE u % 4 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(RULE_INSTANCES)) + " END"


def rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples for all shipped rules. Time runs sixty times faster, so that windows of minutes hold several."""
    start = 1_704_067_200_000_000
    micros = F.lit(start) + F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - start) / 60)
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.col("user_id").alias("u"), _k().alias("k"),
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("ts"),
    )
    arrays = "CASE event_type " + " ".join(
        f"WHEN '{kind}' THEN array("
        + ", ".join(f"named_struct('name', '{name}', 'v', cast({value} AS double))" for name, value in pairs) + ")"
        for kind, pairs in RULE_SAMPLES.items()
    ) + " END"
    return events.select("event_id", "ts", "u", F.expr(f"inline({arrays})")).selectExpr(
        "name", f"{_RULE_INSTANCE} AS instance", f"{RULE_DEVICE} AS device", f"{RULE_MODE} AS mode",
        f"{RULE_FSTYPE} AS fstype", f"{RULE_CPU} AS cpu", f"{RULE_MOUNT} AS mountpoint", "event_id", "ts", "v AS value",
    )


RULE_SAMPLES_SQL = f"""
SELECT name, {_RULE_INSTANCE} AS instance, {RULE_DEVICE} AS device, {RULE_MODE} AS mode, {RULE_FSTYPE} AS fstype,
  {RULE_CPU} AS cpu, {RULE_MOUNT} AS mountpoint, event_id, ts, value
FROM ({' UNION ALL '.join(
    f"SELECT event_id, u, ts, '{name}' AS name, cast({value} AS double) AS value FROM fast WHERE event_type = '{kind}'"
    for kind, pairs in RULE_SAMPLES.items() for name, value in pairs)})
"""
FAST = """
SELECT event_id, event_type, value, user_id AS u, cast(json_extract_string(props, '$.k') AS bigint) AS k,
  make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS ts FROM events
"""


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "ts",
        F.concat(F.lit("i"), (F.col("user_id") % 4).cast("string")).alias("container_name"),
        F.concat(F.upper("event_type"), F.lit(" user="), F.col("user_id").cast("string"), F.lit(" "), "props").alias(
            "line"
        ),
    )


LOGS = """
SELECT ts, 'i' || cast(user_id % 4 AS varchar) AS container_name,
  upper(event_type) || ' user=' || cast(user_id AS varchar) || ' ' || props AS line
FROM events
"""


def _payload_text(epoch: str) -> str:
    """Current payloads as JSON text, with one kind of fault per last digit of the id."""
    name = "concat('\"name\":\"', event_type, '\"')"
    dt = f"concat(',\"dt\":', cast({epoch} AS string))"
    place = "concat(',\"coord\":{\"lon\":', cast(user_id % 90 AS string), ',\"lat\":1.5}')"
    wind = "concat(',\"wind\":{\"speed\":', cast(user_id % 30 AS string), '}')"
    weather = "concat(',\"weather\":[{\"main\":\"', event_type, '\"}]')"
    temp = "concat('\"temp\":', cast(cast(value AS decimal(12,2)) AS string))"

    def main(*parts: str) -> str:
        return "concat(',\"main\":{', " + ", ',', ".join(parts) + ", '}')"

    humid, press = "'\"humidity\":60'", "'\"pressure\":1013'"
    whole = main(temp, humid, press)

    def doc(*parts: str) -> str:
        return "concat('{', " + ", ".join(parts) + ", '}')"

    faults = {
        0: doc(name, dt, place, wind, weather, main(temp, press)),
        1: doc(name, dt, place, wind, weather, main("'\"temp\":\"x\"'", humid, press)),
        2: "concat('{\"name\": \"', event_type)",
        3: doc("'\"name\":null'", dt, place, wind, weather, whole),
        4: doc(name, dt, place, wind, weather, "',\"main\":7'"),
        5: doc(name, f"concat(',\"dt\":', cast({epoch} AS string), '.5')", place, wind, weather, whole),
        6: doc(name, dt, place, "',\"weather\":{}'", whole),
        7: doc(name, dt, place, wind, weather, main(temp, "'\"humidity\":true'", "'\"pressure\":1013.0'")),
    }
    cases = " ".join(f"WHEN {digit} THEN {text}" for digit, text in faults.items())
    sound = doc(name, dt, place, wind, weather, whole)
    return f"CASE event_id % 10 {cases} ELSE {sound} END"


SPARK_PAYLOAD = _payload_text("unix_timestamp(cast(ts AS timestamp))")
PAYLOADS = f"""
SELECT event_id, user_id, event_type, ts, {_payload_text("cast(floor(epoch(ts)) AS bigint)")} AS raw_json FROM events
"""


def payloads_columns(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "event_type", "ts", F.expr(SPARK_PAYLOAD).alias("raw_json"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads_columns(table(spark, sf_dir, "events"))


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads addressed as the raw zone stores them."""
    return payloads(spark, sf_dir).select(
        F.concat(F.lit("city_"), (F.col("user_id") % 20).cast("string")).alias("city"),
        F.when(F.col("user_id") % 2 == 0, "weather_current").otherwise("weather_forecast").alias("source"),
        F.col("ts").alias("extracted_at"),
        "event_id",
        "raw_json",
    )


BRONZE = f"""
SELECT 'city_' || cast(user_id % 20 AS varchar) AS city,
  CASE WHEN user_id % 2 = 0 THEN 'weather_current' ELSE 'weather_forecast' END AS source,
  ts AS extracted_at, event_id, raw_json FROM ({PAYLOADS})
"""


def _whole_payload() -> str:
    """Whole payloads of both kinds as JSON text: even users current ones, odd users forecasts of two slots.

    By the last digit of the id, base five: 1 has empty lists, 2 no country and no clouds (or no place), 3 is cut off, 4
    has no measures (or another count).
    """
    epoch = "unix_timestamp(cast(ts AS timestamp))"
    f = "event_id % 5"
    value = "cast(cast(value AS decimal(12,2)) AS string)"

    def text(expression: str) -> str:
        return f"cast({expression} AS string)"

    def measures(more: str) -> str:
        return (f"concat('\"main\":{{\"temp\":', {value}, ',\"feels_like\":', {text('user_id % 17')}, "
                f"',\"humidity\":', {text('user_id % 100')}, ',\"pressure\":', {text(f'1000 + user_id % 30 + {more}')}, '}},')")

    weather = "concat('\"weather\":[{\"id\":1,\"main\":\"', event_type, '\",\"description\":\"it is ', event_type, '\"}]')"
    weather = f"CASE {f} WHEN 1 THEN '\"weather\":[]' ELSE {weather} END"
    clouds = f"CASE {f} WHEN 2 THEN '' ELSE concat(',\"clouds\":{{\"all\":', {text('user_id % 50')}, '}}') END"
    wind = f"concat(',\"wind\":{{\"speed\":', {text('user_id % 30')}, '}}')"
    country = f"CASE {f} WHEN 2 THEN '' ELSE concat(',\"country\":\"K', {text('user_id % 7')}, '\"') END"
    place = f"concat('{{\"lon\":', {text('user_id % 90')}, ',\"lat\":1.5}}')"
    current = (
        f"concat('{{\"name\":\"', event_type, '\",\"sys\":{{\"id\":7', {country}, '}},\"coord\":', {place}, ',', "
        f"CASE {f} WHEN 4 THEN '' ELSE {measures('0')} END, {weather}, {clouds}, {wind}, "
        f"',\"visibility\":', {text('user_id * 10')}, ',\"dt\":', {text(epoch)}, CASE {f} WHEN 3 THEN ',' ELSE '}}' END)"
    )

    def slot(k: int) -> str:
        return (f"concat('{{', {measures(str(k))}, {weather}, {clouds}, {wind}, ',\"pop\":0.{k + 1},\"dt\":', "
                f"{text(f'{epoch} + {10_800 * (k + 1)}')}, '}}')")

    forecast = (
        f"concat('{{\"city\":{{\"name\":\"', event_type, '\"', {country}, "
        f"CASE {f} WHEN 2 THEN '' ELSE concat(',\"coord\":', {place}) END, '}},\"cnt\":', CASE {f} WHEN 4 THEN '\"two\"' ELSE '2' END, "
        f"',\"list\":[', CASE {f} WHEN 1 THEN '' ELSE concat({slot(0)}, ',', {slot(1)}) END, CASE {f} WHEN 3 THEN '}}' ELSE ']}}' END)"
    )
    return f"CASE WHEN user_id % 2 = 0 THEN {current} ELSE {forecast} END"


def whole_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole payloads of both kinds, with the ids a load gives them."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("user_id") % 2 == 0, "weather_current").otherwise("weather_forecast").alias("source"),
        F.expr(_whole_payload()).alias("raw_json"), F.lit("load-1").alias("load_id"), F.col("event_id").cast("string").alias("row_id"),
    )


def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container samples with all the special cases the measures treat."""
    kind = F.col("event_type")
    stats = "struct<rx_bytes: bigint, tx_bytes: bigint>"
    one = F.struct((F.col("user_id") * 10).alias("rx_bytes"), F.col("user_id").alias("tx_bytes"))
    two = F.struct(F.lit(None).cast("bigint").alias("rx_bytes"), _k().alias("tx_bytes"))
    empty = F.create_map().cast(f"map<string, {stats}>")
    networks = (
        F.when(kind == "view", empty)
        .when(kind == "error", F.create_map(F.lit("eth0"), one))
        .otherwise(F.create_map(F.lit("eth0"), one, F.lit("eth1"), two))
    )
    started = (
        F.when(kind == "click", "0001-01-01T00:00:00Z").when(kind == "view", "")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    health = (
        F.when(kind == "purchase", "healthy").when(kind == "error", "unhealthy")
        .when(kind == "view", "starting").when(kind == "signup", "none")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("/c"), (F.col("user_id") % 40).cast("string")).alias("name"),
        F.when(kind == "signup", "exited").otherwise("running").alias("state"),
        started.alias("started_at"),
        health.alias("health"),
        (F.col("event_id") * 1000 + _k() * 7).alias("cpu_total"),
        F.when(F.col("user_id") % 9 != 0, F.col("event_id") * 1000).alias("precpu_total"),
        (F.col("event_id") * 5000 + _k() * 11).alias("system_cpu"),
        (F.col("event_id") * 5000 + (F.col("user_id") % 50) * 11).alias("presystem_cpu"),
        F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 5).cast("int").alias("online_cpus"),
        networks.alias("networks"),
    )


CONTAINERS = """
SELECT event_id, '/c' || cast(user_id % 40 AS varchar) AS name,
  CASE event_type WHEN 'signup' THEN 'exited' ELSE 'running' END AS state, event_type AS kind, ts, user_id,
  CASE event_type WHEN 'purchase' THEN 'healthy' WHEN 'error' THEN 'unhealthy' WHEN 'view' THEN 'starting'
    WHEN 'signup' THEN 'none' END AS health,
  cast(json_extract_string(props, '$.k') AS bigint) AS k
FROM events
"""


def metric_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted names of several rule shapes, and some no rule knows."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    name = (
        F.when(F.col("user_id") % 8 == 0, F.concat_ws(".", F.lit("airflow.dag"), kind, user, F.lit("duration")))
        .when(F.col("user_id") % 8 == 1, F.concat_ws(".", F.lit("airflow.ti.finish"), kind, user, F.lit("success")))
        .when(F.col("user_id") % 8 == 2, F.concat_ws(".", F.lit("airflow.pool.open_slots"), kind))
        .when(F.col("user_id") % 8 == 3, F.lit("airflow.ti_failures"))
        .when(F.col("user_id") % 8 == 4, F.concat_ws(".", F.lit("airflow.dagrun.schedule_delay"), kind))
        .when(F.col("user_id") % 8 == 5, F.concat_ws(".", F.lit("airflow"), kind))
        .when(F.col("user_id") % 8 == 6, F.concat_ws(".", F.lit("airflow.dagrun"), kind, F.lit("first_task_scheduling_delay")))
        .otherwise(F.concat_ws(".", F.lit("other"), kind, user))
    )
    return table(spark, sf_dir, "events").select("event_id", name.alias("dotted"))


METRIC_NAMES = """
SELECT event_id, CASE user_id % 8
  WHEN 0 THEN 'airflow.dag.' || event_type || '.' || user_id || '.duration'
  WHEN 1 THEN 'airflow.ti.finish.' || event_type || '.' || user_id || '.success'
  WHEN 2 THEN 'airflow.pool.open_slots.' || event_type
  WHEN 3 THEN 'airflow.ti_failures'
  WHEN 4 THEN 'airflow.dagrun.schedule_delay.' || event_type
  WHEN 5 THEN 'airflow.' || event_type
  WHEN 6 THEN 'airflow.dagrun.' || event_type || '.first_task_scheduling_delay'
  ELSE 'other.' || event_type || '.' || user_id END AS dotted
FROM events
"""

VIEW_SQL = {
    "obs": OBS, "fc": FC, "runs": RUNS, "customer_runs": CUSTOMER_RUNS, "dags": DAGS, "required": REQUIRED,
    "series": SERIES, "metrics": METRICS, "logs": LOGS, "payloads": PAYLOADS, "bronze": BRONZE,
    "containers": CONTAINERS, "metric_names": METRIC_NAMES, "fast": FAST, "samples": RULE_SAMPLES_SQL,
}


def with_views(*names_and_body: str) -> str:
    """SQL text whose first names become common table expressions before the last argument."""
    *names, body = names_and_body
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}" if ctes else body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}" if ctes else body
    return f"WITH {ctes}\n{body}" if ctes else body


def rounded(expression: str, digits: int) -> str:
    """SQL text of the decimal rounding."""
    return f"cast(round(cast({expression} AS decimal(38,12)), {digits}) AS double)"
