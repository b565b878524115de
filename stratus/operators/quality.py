"""Data-quality checks: declared as data, folded into one pass per table.

A check row is ``(check, target, column, severity, success, observed, failures)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratus.functions import as_instant, seconds_between
from stratus.operators.contracts import json_shape, kind_name

RESULT = (
    "check string, target string, column string, severity string, "
    "success boolean, observed double, failures bigint"
)
NULL_RATE = 0.05
FRESH_HOURS = 24


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    limit: float | None = None
    severity: str = "critical"

    @property
    def label(self) -> str:
        bounds = ["" if b is None else f"{b:g}" for b in (self.low, self.high)]
        if self.kind in ("between", "value_range"):
            return f"{self.kind}[{bounds[0]},{bounds[1]}]"
        if self.limit is not None:
            return f"{self.kind}[{self.limit:g}]"
        return self.kind


@dataclass(frozen=True)
class Outcome:
    """Aggregates one check needs, and how to read them."""

    observed: Column
    failures: Column


def _out_of_range(column: str, low: float | None, high: float | None) -> Column:
    value = F.col(column)
    tests = []
    if low is not None:
        tests.append(value < F.lit(low))
    if high is not None:
        tests.append(value > F.lit(high))
    bad = F.lit(False)
    for test in tests:
        bad = bad | test
    return F.count_if(bad)


def _row_count(check: Check, now: Column) -> Outcome:
    rows = F.count("*")
    return Outcome(rows, (rows < F.lit(check.limit if check.limit is not None else 1)).cast("bigint"))


def _column_exists(check: Check, now: Column) -> Outcome:
    return Outcome(F.count(F.col(check.column)), F.lit(0))


def _not_null(check: Check, now: Column) -> Outcome:
    missing = F.count_if(F.col(check.column).isNull())
    return Outcome(missing, missing)


def _between(check: Check, now: Column) -> Outcome:
    bad = _out_of_range(check.column, check.low, check.high)
    return Outcome(bad, bad)


def _not_null_rate(check: Check, now: Column) -> Outcome:
    missing = F.count_if(F.col(check.column).isNull())
    rate = F.try_divide(missing.cast("double"), F.count("*").cast("double"))
    limit = check.limit if check.limit is not None else NULL_RATE
    return Outcome(rate, F.when(rate > limit, missing).otherwise(0))


def _freshness_hours(check: Check, now: Column) -> Outcome:
    newest = F.max(F.col(check.column))
    age = seconds_between(newest, now)
    limit = check.limit if check.limit is not None else FRESH_HOURS
    stale = F.coalesce(age > F.lit(float(limit) * 3600), F.lit(True))
    return Outcome(age, stale.cast("bigint"))


AGGREGATED: dict[str, Callable[[Check, Column], Outcome]] = {
    "row_count": _row_count,
    "column_exists": _column_exists,
    "not_null": _not_null,
    "between": _between,
    "value_range": _between,
    "not_null_rate": _not_null_rate,
    "freshness_hours": _freshness_hours,
}
KINDS = {*AGGREGATED, "unique"}


@dataclass(frozen=True)
class Placed:
    """A check together with the suite and layer it is reported under, if any."""

    check: Check
    suite: str | None = None
    layer: str | None = None


def _row(placed: Placed, target: str, observed: Column, failures: Column) -> Column:
    check, failures = placed.check, failures.cast("bigint")
    owner = []
    if placed.suite is not None:
        owner = [F.lit(placed.suite).alias("suite"), F.lit(placed.layer).alias("layer")]
    return F.struct(
        *owner,
        F.lit(check.label).alias("check"),
        F.lit(target).alias("target"),
        F.lit(check.column).cast("string").alias("column"),
        F.lit(check.severity).alias("severity"),
        (failures == 0).alias("success"),
        observed.cast("double").alias("observed"),
        failures.alias("failures"),
    )


def _repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once; counting combines per task."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("n"))
    )


def _unavailable(spark: SparkSession, placed: list[Placed], target: str) -> DataFrame:
    owned = placed[0].suite is not None
    rows = [
        ((p.suite, p.layer) if owned else ())
        + (p.check.label, target, p.check.column, p.check.severity, False, None, None)
        for p in placed
    ]
    return spark.createDataFrame(rows, f"suite string, layer string, {RESULT}" if owned else RESULT)


@dataclass(frozen=True)
class _Plan:
    """How the checks of one table are computed: folded into one aggregate, by a grouping of their own, or not at all."""

    folded: list[Check]
    placed: list[Placed]
    repeated: list[Placed]
    unavailable: list[Placed]

    @classmethod
    def of(cls, df: DataFrame, placed: list[Placed]) -> _Plan:
        present = set(df.columns)
        known = [p for p in placed if p.check.column is None or p.check.column in present]
        folding = [p for p in known if p.check.kind in AGGREGATED]
        return cls(
            list(dict.fromkeys(p.check for p in folding)), folding, [p for p in known if p.check.kind == "unique"],
            [p for p in placed if p not in known],
        )

    def aggregates(self, now: Any) -> list[Column]:
        instant, columns = as_instant(now), []
        for i, check in enumerate(self.folded):
            outcome = AGGREGATED[check.kind](check, instant)
            columns += [outcome.observed.cast("double").alias(f"o{i}"), outcome.failures.cast("bigint").alias(f"f{i}")]
        return columns

    def folded_rows(self, aggregated: DataFrame, target: str) -> list[DataFrame]:
        """Check rows from one row of aggregates."""
        rows = [
            _row(p, target, F.col(f"o{i}"), F.col(f"f{i}")) for p in self.placed for i in (self.folded.index(p.check),)
        ]
        return [aggregated.select(F.inline(F.array(*rows)))] if rows else []

    def other_rows(self, df: DataFrame, target: str) -> list[DataFrame]:
        parts = []
        for column in dict.fromkeys(p.check.column for p in self.repeated):
            rows = [_row(p, target, F.col("n"), F.col("n")) for p in self.repeated if p.check.column == column]
            parts.append(_repeated_values(df, column).select(F.inline(F.array(*rows))))
        if self.unavailable:
            parts.append(_unavailable(df.sparkSession, self.unavailable, target))
        return parts


def _check_rows(df: DataFrame, target: str, placed: list[Placed], now: Any) -> DataFrame:
    plan = _Plan.of(df, placed)
    folded = plan.folded_rows(df.agg(*plan.aggregates(now)), target) if plan.folded else []
    return reduce(DataFrame.unionByName, folded + plan.other_rows(df, target))


def run_checks(df: DataFrame, target: str, checks: list[Check] | tuple[Check, ...], now: Any = None) -> DataFrame:
    """All checks of one table as check rows.

    Everything that is an aggregate shares a single scan and a single partial
    aggregation; only uniqueness needs a grouping of its own. A check on a
    column the table lacks gives a failed row.
    """
    return _check_rows(df, target, [Placed(c) for c in checks], now)


@dataclass(frozen=True)
class Suite:
    name: str
    layer: str
    table: str
    checks: tuple[Check, ...]


def _exists(*columns: str) -> tuple[Check, ...]:
    return tuple(Check("column_exists", c) for c in columns)


def _filled(*columns: str, severity: str = "critical") -> tuple[Check, ...]:
    return tuple(Check("not_null", c, severity=severity) for c in columns)


_ROWS = Check("row_count", limit=1)
_TEMPERATURE = Check("between", "temperature_celsius", -60.0, 60.0, severity="warning")
_HUMIDITY = Check("between", "humidity_percent", 0.0, 100.0, severity="warning")

# The shipped suites.
SUITES = (
    Suite("staging_current_weather", "staging", "stg_weather_current", (
        _ROWS,
        *_exists("city_name", "temperature_celsius", "humidity_percent", "wind_speed_ms", "measured_at"),
        *_filled("city_name", "temperature_celsius", "measured_at"),
        _TEMPERATURE, _HUMIDITY, Check("between", "wind_speed_ms", 0.0, 200.0, severity="warning"),
    )),
    Suite("staging_weather_forecast", "staging", "stg_weather_forecast", (
        _ROWS,
        *_exists("city_name", "temperature_celsius", "forecast_at"),
        *_filled("city_name", "temperature_celsius"),
        _TEMPERATURE,
    )),
    Suite("analytics_daily_summary", "mart", "weather_daily_summary", (
        _ROWS,
        *_exists("city_name", "date_day"),
        *_filled("city_name", "date_day"),
        Check("between", "observation_count", low=1, severity="warning"),
    )),
    Suite("cli_stg_weather_current", "staging", "stg_weather_current", (
        _ROWS,
        *_exists("city_name", "temperature_celsius", "humidity_percent"),
        *_filled("city_name", "temperature_celsius"),
        _TEMPERATURE, _HUMIDITY,
    )),
    Suite("cli_stg_weather_forecast", "staging", "stg_weather_forecast", (
        _ROWS, *_exists("city_name", "temperature_celsius"), *_filled("city_name"), _TEMPERATURE,
    )),
    Suite("cli_weather_daily_summary", "mart", "weather_daily_summary", (
        _ROWS, *_exists("city_name", "date_day"), *_filled("city_name", "date_day"),
    )),
    Suite("cli_city_weather_metrics", "mart", "city_weather_metrics", (
        _ROWS, *_exists("city_name"), Check("unique", "city_name"), *_filled("total_observations"),
    )),
    Suite("scan_stg_weather_current", "staging", "stg_weather_current", (
        _ROWS,
        *_filled("city_name", "temperature_celsius", "measured_at"),
        Check("between", "temperature_celsius", -90, 60),
        Check("between", "humidity_percent", 0, 100),
    )),
    Suite("scan_stg_weather_forecast", "staging", "stg_weather_forecast", (
        _ROWS, *_filled("city_name", "temperature_celsius", "forecast_at"),
    )),
    Suite("scan_weather_daily_summary", "mart", "weather_daily_summary", (
        _ROWS,
        *_filled("city_name", "date_day", "avg_temperature_celsius"),
        Check("between", "observation_count", low=1),
    )),
    Suite("scan_city_weather_metrics", "mart", "city_weather_metrics", (
        _ROWS,
        Check("unique", "city_name"),
        *_filled("total_observations"),
        Check("between", "total_observations", low=1),
    )),
)


def run_suites(
    tables: dict[str, DataFrame], layer: str = "all", suites: tuple[Suite, ...] = SUITES, now: Any = None
) -> DataFrame:
    """Check rows of every suite of a layer, with ``suite`` and ``layer`` columns.

    Suites of one table share its scan, and a check two suites have in common
    is computed once. A table that is not given yields failed rows.
    """
    if layer not in ("all", "staging", "mart"):
        raise ValueError(f"unknown layer: {layer}")
    chosen = [s for s in suites if layer in ("all", s.layer)]
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for table in dict.fromkeys(s.table for s in chosen):
        placed = [Placed(c, s.name, s.layer) for s in chosen if s.table == table for c in s.checks]
        if table in tables:
            parts.append(_check_rows(tables[table], table, placed, now))
        else:
            parts.append(_unavailable(spark, placed, table))
    return reduce(DataFrame.unionByName, parts)


class WhileStoring:
    """The suites of one table, gathered from its rows while they are written.

    ``frame`` is the table with the aggregates of its checks observed on the way; write it once, then read the check
    rows. Only uniqueness, which needs a grouping, reads the stored table again, and of it the one column.
    """

    def __init__(self, df: DataFrame, table: str, suites: tuple[Suite, ...] = SUITES, now: Any = None):
        self.table = table
        self.plan = _Plan.of(df, [Placed(c, s.name, s.layer) for s in suites if s.table == table for c in s.checks])
        self.observation = Observation()
        self.frame = df.observe(self.observation, *self.plan.aggregates(now)) if self.plan.folded else df

    def results(self, stored: DataFrame) -> DataFrame | None:
        """Check rows as ``run_suites`` gives them; None if no suite has the table."""
        parts = self.plan.other_rows(stored, self.table)
        if self.plan.folded:
            seen = self.observation.get
            names = [f"{kind}{i}" for i in range(len(self.plan.folded)) for kind in "of"]
            values = [None if seen[n] is None else (float if n[0] == "o" else int)(seen[n]) for n in names]
            schema = ", ".join(f"{n} {'double' if n[0] == 'o' else 'bigint'}" for n in names)
            # One row of as many numbers as there are checks.
            parts = self.plan.folded_rows(stored.sparkSession.createDataFrame([values], schema), self.table) + parts
        return reduce(DataFrame.unionByName, parts) if parts else None


def suite_verdicts(results: DataFrame) -> DataFrame:
    """Per suite: do all its checks pass, and how many do not."""
    return results.groupBy("suite", "layer").agg(
        F.bool_and("success").alias("success"),
        F.count("*").alias("checks"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def all_passed(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.bool_and("success"), F.lit(False)).alias("all_passed"))


def schema_frame(df: DataFrame) -> DataFrame:
    """Column names and types of a relation as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def schema_changes(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Columns added, removed or of another type than in the stored baseline."""
    before = baseline.select("column", F.col("type").alias("old_type"))
    after = current.select("column", F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    both = before.join(after, "column", "full_outer").withColumn("change", change)
    return both.where(F.col("change").isNotNull()).select("column", "change", "old_type", "new_type")


def payload_schema(df: DataFrame, raw: str) -> DataFrame:
    """Top-level fields and types seen in a raw JSON column, with how many rows hold each."""
    parsed = df.select(F.try_parse_json(raw).alias("_doc"))
    fields = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_doc").outer()))
    return fields.groupBy(
        F.col("key").alias("column"), kind_name(json_shape(F.col("value"))).alias("type")
    ).agg(F.count("*").alias("rows"))


def column_profile(df: DataFrame, columns: list[str], exact_distinct: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Row, NULL and distinct counts, extremes and mean per column, from one scan.

    Distinct counts are estimated with a mergeable sketch; for the columns in
    ``exact_distinct`` a second, grouped pass counts exactly.
    """
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in
               ("byte", "short", "integer", "long", "float", "double", "decimal")}
    aggregates, rows = [F.count("*").alias("n")], []
    for i, c in enumerate(columns):
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        aggregates += [
            F.count(c).alias(f"k{i}"), F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"), F.avg(number).alias(f"m{i}"),
        ]
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col("n").alias("row_count"),
            (F.col("n") - F.col(f"k{i}")).alias("null_count"), F.col(f"d{i}").alias("distinct_estimate"),
            F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"), F.col(f"m{i}").alias("mean"),
        ))
    profile = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    if not exact_distinct:
        return profile
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in exact_distinct
    ]))).where(F.col("value").isNotNull())
    exact = values.distinct().groupBy("column").agg(F.count("*").alias("distinct_count"))
    return profile.join(exact, "column", "left")


def sample_rows(df: DataFrame, rows: int = 50) -> DataFrame:
    """A few rows to look at, as a profile shows them."""
    return df.limit(rows)
