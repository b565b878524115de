"""Analytic models over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import pg_round
from stratus.operators.ranking import Rank, global_ranks

RANKS = (
    Rank("temp_rank_warmest", "avg_temperature_celsius", descending=True),
    Rank("temp_rank_coldest", "avg_temperature_celsius", descending=False),
    Rank("humidity_rank", "avg_humidity_percent", descending=True),
    Rank("wind_rank", "avg_wind_speed_ms", descending=True),
    Rank("data_completeness_rank", "total_observations", descending=True),
)
RANKED_COLUMNS = (
    "city_name", "country_code", "avg_temperature_celsius", "avg_humidity_percent",
    "avg_wind_speed_ms", "total_observations", "first_observation", "last_observation",
)


def value_vs_mean(stats: DataFrame, column: str, name: str) -> DataFrame:
    """Difference of each row to the unweighted mean over all rows, as a scalar subquery."""
    return stats.withColumn(name, F.col(column) - stats.select(F.avg(column)).scalar())


def city_comparison_ranking(metrics: DataFrame) -> DataFrame:
    """Five ranks over all cities and the difference to the mean.

    ``metrics`` feeds several branches and should be a stored mart.
    """
    stats = metrics.select(*RANKED_COLUMNS)
    return value_vs_mean(global_ranks(stats, "city_name", RANKS), "avg_temperature_celsius", "temp_vs_mean")


def weather_trend_analysis(daily: DataFrame, days: int = 7) -> DataFrame:
    """Rolling means over the last ``days`` rows and the change to the row before.

    Rows, not calendar days: a missing day does not shorten the reach. A
    city's group holds one row per day, so its size is bounded by the calendar.
    """
    by_day = Window.partitionBy("city_name").orderBy(F.col("date_day").asc_nulls_last())
    recent = by_day.rowsBetween(-(days - 1), Window.currentRow)
    return daily.select(
        "city_name",
        "date_day",
        "avg_temperature_celsius",
        "avg_humidity_percent",
        "avg_wind_speed_ms",
        "observation_count",
        pg_round(F.avg("avg_temperature_celsius").over(recent), 1).alias(f"temp_{days}d_moving_avg"),
        pg_round(F.avg("avg_humidity_percent").over(recent), 1).alias(f"humidity_{days}d_moving_avg"),
        pg_round(F.avg("avg_wind_speed_ms").over(recent), 2).alias(f"wind_{days}d_moving_avg"),
        (F.col("avg_temperature_celsius") - F.lag("avg_temperature_celsius", 1).over(by_day)).alias(
            "temp_day_over_day_change"
        ),
    )
