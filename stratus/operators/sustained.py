"""Conditions that must hold for a while, and state timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import seconds_between
from stratus.operators.slices import run_lengths


def sustained_condition(
    samples: DataFrame, keys: list[str], condition: Column, hold_seconds: float,
    ts: str = "ts", tiebreak: str = "event_id", slice_seconds: float | None = None, slices: int | None = None,
) -> DataFrame:
    """Periods in which the condition held without a break for at least ``hold_seconds``.

    A period spans its first to its last consecutive true sample. A missing
    value breaks a period. With 0 seconds a single true sample is enough. Series
    are cut into slices of about equally many rows, or by time if a width is given.
    """
    truth = F.coalesce(condition, F.lit(False))
    runs = run_lengths(samples, keys, ts, truth, tiebreak, slice_seconds, slices)
    held = seconds_between("started_at", "ended_at")
    fires = F.timestamp_micros(
        F.unix_micros(F.col("started_at").cast("timestamp")) + F.lit(int(hold_seconds * 1_000_000))
    ).cast("timestamp_ntz")
    return (
        runs.where(F.col("state") & (held >= hold_seconds))
        .drop("state")
        .withColumn("held_seconds", held)
        .withColumn("fires_from", fires)
    )


def availability_timeline(
    samples: DataFrame, keys: list[str], state: Column,
    ts: str = "ts", tiebreak: str = "event_id", slice_seconds: float | None = None, slices: int | None = None,
) -> DataFrame:
    """One row per state change: the new state, since when, its last sample and sample count."""
    return run_lengths(samples, keys, ts, state, tiebreak, slice_seconds, slices)
