"""Column profiles that are kept per load and merged: counts, extremes of every type, distinct and quantile sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

#: Sketch sizes: 2**12 registers estimate a distinct count to 3 % (two standard deviations), 400 items a rank to 1 %.
DISTINCT_BITS = 12
RANK_ITEMS = 400
DISTINCT_ERROR = 0.06
RANK_ERROR = 0.02
QUANTILES = (0.25, 0.5, 0.75)


def profile_parts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One mergeable row per column, all from one scan and one aggregate.

    Numbers have ``low``, ``high``, ``total`` and a rank sketch; texts, times, dates and booleans have ``first`` and ``last`` as
    text, in the order of their own type. Whatever has no such thing has null there. NaN counts as a number above all
    others, and not in the total.
    """
    aggregates, rows = [F.count("*").alias("n")], []
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType
        number = isinstance(kind, NumericType)
        value = F.col(c).cast("double") if number else F.lit(None).cast("double")
        ordered = F.lit(None).cast("string") if number else F.col(c)
        seen = F.col(c) if isinstance(kind, StringType) else F.col(c).cast("string")
        aggregates += [
            F.count(c).alias(f"k{i}"), F.hll_sketch_agg(seen, DISTINCT_BITS).alias(f"d{i}"),
            F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}"),
            F.sum(F.when(~F.isnan(value), value)).alias(f"s{i}"), F.count_if(F.isnan(value)).alias(f"x{i}"),
            F.min(ordered).cast("string").alias(f"f{i}"), F.max(ordered).cast("string").alias(f"l{i}"),
        ]
        if number:
            aggregates.append(F.kll_sketch_agg_double(F.when(~F.isnan(value), value), RANK_ITEMS).alias(f"q{i}"))
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col("n").alias("row_count"), F.col(f"k{i}").alias("known_count"),
            F.col(f"x{i}").alias("nan_count"), F.col(f"a{i}").alias("low"), F.col(f"b{i}").alias("high"),
            F.col(f"s{i}").alias("total"), F.col(f"f{i}").alias("first"), F.col(f"l{i}").alias("last"),
            F.col(f"d{i}").alias("distinct"), (F.col(f"q{i}") if number else F.lit(None).cast("binary")).alias("ranks"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Parts of several loads as one part per column, of the same form: what was profiled is never read again."""
    return parts.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "known_count", "nan_count")],
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("ranks").alias("ranks"),
    )


def _quantile(ranks: Column, share: float) -> Column:
    return F.when(F.kll_sketch_get_n_double(ranks) > 0, F.kll_sketch_get_quantile_double(ranks, F.lit(share)))


def profile_report(parts: DataFrame) -> DataFrame:
    """Profile rows from parts with one row per column; quantiles are values whose rank is within the stated error."""
    numbers = F.col("known_count") - F.col("nan_count")
    return parts.select(
        "column", "row_count", (F.col("row_count") - F.col("known_count")).alias("null_count"),
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"), F.col("low").alias("min"), F.col("high").alias("max"),
        F.col("first").alias("min_text"), F.col("last").alias("max_text"),
        F.when(F.col("ranks").isNotNull(), F.try_divide("total", numbers)).alias("mean"),
        *[_quantile(F.col("ranks"), q).alias(f"p{round(100 * q)}") for q in QUANTILES],
    )


def rank_around(value: Column, point: Column) -> Column:
    """How many values lie below and up to ``point`` and the nearest ones on both sides: one aggregate of fixed width."""
    return F.struct(
        F.count(value).alias("n"), F.count_if(value < point).alias("below"), F.count_if(value <= point).alias("upto"),
        F.max(F.when(value < point, value)).alias("before"), F.min(F.when(value > point, value)).alias("after"),
    )


def within_ranks(around: Column, point: Column, low: float, high: float) -> Column:
    """Whether ``point`` lies between the exact percentiles ``low`` and ``high`` of the values it was counted against.

    A percentile is put together from the two values at its place. Only their order against ``point`` matters, so any
    value further away than the nearest one may stand for it, and no task ever holds the values themselves.
    """
    def percentile(share: float) -> Column:
        place = (around["n"] - 1) * F.lit(share)
        lower, upper = F.floor(place), F.ceil(place)
        at = [F.when(i < around["below"], around["before"]).when(i < around["upto"], point).otherwise(around["after"]) for i in (lower, upper)]
        return F.when(at[0] == at[1], at[0]).otherwise((upper - place) * at[0] + (place - lower) * at[1])

    return point.between(percentile(low), percentile(high))
