"""Row-volume anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import day_start

BASELINE_DAYS = 14
LEAST_DAYS = 7
THRESHOLD = 3.0


def volume_anomaly(
    df: DataFrame, ts: str, days: int = BASELINE_DAYS, least: int = LEAST_DAYS, threshold: float = THRESHOLD,
    where: Column | None = None,
) -> DataFrame:
    """Daily row counts with their z-score against the previous days.

    Days without rows count as zero. A day with fewer than ``least`` days
    before it, or whose past days were all alike, has no score and is not flagged.
    ``where`` chooses the rows that count, such as those of the last days.
    After the first aggregate there is one row per calendar day.
    """
    rows = df.where(F.col(ts).isNotNull())
    counted = (rows if where is None else rows.where(where)).groupBy(day_start(ts).alias("first")).agg(F.count("*").alias("n"))
    # Every day with rows also stands for the empty ones up to the next, so the counts are read once.
    one_day = F.expr("interval 1 day")
    last = F.coalesce(F.lead("first").over(Window.orderBy("first")) - one_day, "first")
    spread = counted.withColumn("last", last).withColumn("day", F.explode(F.sequence("first", "last", one_day)))
    daily = spread.select("day", F.when(F.col("day") == F.col("first"), F.col("n")).otherwise(0).alias("row_count"))
    past = Window.orderBy("day").rowsBetween(-days, -1)
    scored = daily.select(
        "day",
        "row_count",
        F.count("*").over(past).alias("baseline_days"),
        F.avg("row_count").over(past).alias("mean"),
        F.stddev_samp("row_count").over(past).alias("deviation"),
    )
    z = F.when(
        (F.col("baseline_days") >= least) & (F.col("deviation") > 0),
        (F.col("row_count") - F.col("mean")) / F.col("deviation"),
    )
    return scored.withColumn("z_score", z).select(
        "day", "row_count", "baseline_days", "z_score",
        F.coalesce(F.abs("z_score") > threshold, F.lit(False)).alias("is_anomaly"),
    )
