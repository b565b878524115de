"""Time helpers. ``now`` is always an argument so that every result can be reproduced."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_instant(now: Column | datetime | str | None) -> Column:
    """Literal evaluation instant; the wall clock when none is given."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp_ntz")


def epoch_to_timestamp(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def day_start(ts: Column | str) -> Column:
    """Midnight of the row's day. Goes through ``date``, which needs no time zone."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Exact seconds from ``start`` to ``end`` as double."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(1e6)


def elapsed_seconds(start: Column | str, end: Column | str, now: Column) -> Column:
    """Whole seconds a run took; an open run is measured to ``now``."""
    return F.round(seconds_between(start, F.coalesce(_col(end).cast("timestamp"), now.cast("timestamp")))).cast(
        "bigint"
    )
