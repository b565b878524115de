"""Decimal rounding, half away from zero, as a numeric cast followed by round."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EXACT = "decimal(38,12)"


def pg_round(value: Column | str, digits: int) -> Column:
    """Round a double through its decimal form.

    ``round`` on the binary double differs between engines at ties. Values the
    decimal cannot hold (beyond 1e26, NaN, infinities) carry no fraction to
    round and pass through unchanged.
    """
    value = F.col(value) if isinstance(value, str) else value
    rounded = F.round(value.try_cast(EXACT), digits).cast("double")
    return F.coalesce(rounded, value.cast("double"))


def register_sql_functions(spark: SparkSession, most_digits: int = 6) -> None:
    """Expose ``pg_round`` and ``counter_delta`` to SQL text as temporary SQL functions."""
    # ``round`` wants a literal digit count, so there is one branch per count.
    branches = " ".join(f"WHEN {n} THEN cast(round(try_cast(x AS {EXACT}), {n}) AS double)" for n in range(most_digits + 1))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION pg_round(x DOUBLE, n INT) RETURNS DOUBLE RETURN "
        f"coalesce(CASE n {branches} END, x)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION counter_delta(previous DOUBLE, current DOUBLE) "
        "RETURNS DOUBLE RETURN CASE WHEN previous IS NULL THEN 0D"
        " WHEN current < previous THEN current ELSE current - previous END"
    )
