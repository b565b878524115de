"""The layered build: which model needs which, and how each is stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from stratus.operators.quality import SUITES, Suite, WhileStoring, run_suites
from stratus.plans import analytic, core, marts


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]


# In dependency order. Staging relations come from the caller and stay lazy views.
MODELS = (
    Model("dim_city", "core", ("stg_weather_current",), core.dim_city),
    Model("fct_weather_observation", "core", ("stg_weather_current",), core.fct_weather_observation),
    Model(
        "weather_daily_summary", "mart", ("stg_weather_current", "stg_weather_forecast"),
        lambda current, forecast: marts.weather_daily_summary(marts.union_sources(current, forecast)),
    ),
    Model("city_weather_metrics", "mart", ("stg_weather_current",), marts.city_weather_metrics),
    Model("city_comparison_ranking", "analytic", ("city_weather_metrics",), analytic.city_comparison_ranking),
    Model("weather_trend_analysis", "analytic", ("weather_daily_summary",), analytic.weather_trend_analysis),
)


def build_layers(
    spark: SparkSession, current: DataFrame, forecast: DataFrame, root: str, models: tuple[Model, ...] = MODELS
) -> dict[str, DataFrame]:
    """Build every model below ``root`` and return all relations by name.

    Staging relations become temporary views; core, mart and analytic models
    are replaced as Parquet tables, and later models read those tables, not
    the plans behind them.
    """
    return build_checked_layers(spark, current, forecast, root, models, ())[0]


def build_checked_layers(
    spark: SparkSession, current: DataFrame, forecast: DataFrame, root: str, models: tuple[Model, ...] = MODELS,
    suites: tuple[Suite, ...] = SUITES, now: Any = None,
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """``build_layers`` with the check rows of all suites, as ``run_suites`` gives them.

    The checks of a stored model are gathered while it is written. Those of the staging views, which are not stored, share
    one scan of each. Suites of tables that are not built give failed rows.
    """
    relations = {"stg_weather_current": current, "stg_weather_forecast": forecast}
    for name, df in relations.items():
        df.createOrReplaceTempView(name)
    chosen = tuple(s for s in suites if s.table not in {m.name for m in models})
    results = [run_suites(dict(relations), suites=chosen, now=now)] if chosen else []
    for model in models:
        path = f"{root}/{model.layer}/{model.name}"
        built = WhileStoring(model.build(*[relations[n] for n in model.needs]), model.name, suites, now)
        built.frame.write.mode("overwrite").parquet(path)
        relations[model.name] = spark.read.schema(built.frame.schema).parquet(path)
        relations[model.name].createOrReplaceTempView(model.name)
        results += [rows for rows in [built.results(relations[model.name])] if rows is not None]
    return relations, reduce(DataFrame.unionByName, results) if results else None
