"""Derived measures of container samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Health text to number; any other text, or none, is -1.
HEALTH_CODES = {"healthy": 1.0, "starting": 0.5, "unhealthy": 0.0}
UNKNOWN_HEALTH = -1.0

# Fixed value: start instant reported for a container that never started.
NEVER_STARTED = "0001-01-01T00:00:00Z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def health_code(status: Column | str) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in HEALTH_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, _col(status)), F.lit(UNKNOWN_HEALTH))


def running_flag(state: Column | str) -> Column:
    return F.when(_col(state) == "running", 1).otherwise(0)


def cpu_percent(
    cpu: Column | str, previous_cpu: Column | str,
    system: Column | str, previous_system: Column | str,
    cpus: Column | str,
) -> Column:
    """CPU share over the two cumulative samples a row carries, in percent.

    0 when the system counter did not move or any counter is missing; one CPU
    is assumed when the count is missing.
    """
    busy = _col(cpu) - _col(previous_cpu)
    total = _col(system) - _col(previous_system)
    share = F.try_divide(busy.cast("double"), total.cast("double")) * F.coalesce(_col(cpus), F.lit(1)) * 100
    return F.coalesce(F.when(total > 0, share), F.lit(0.0))


def network_total(networks: Column | str, field: str) -> Column:
    """Sum of one counter over all interfaces; 0 for none."""
    total = F.aggregate(
        F.map_values(_col(networks)), F.lit(0).cast("bigint"),
        lambda acc, item: acc + F.coalesce(item.getField(field), F.lit(0)),
    )
    return F.coalesce(total, F.lit(0).cast("bigint"))


def start_epoch(started_at: Column | str) -> Column:
    """Epoch seconds of an ISO start instant; NULL for empty, malformed or never started."""
    text = F.nullif(F.nullif(_col(started_at), F.lit("")), F.lit(NEVER_STARTED))
    return F.unix_timestamp(F.try_to_timestamp(text))


def uptime_seconds(started_at: Column | str, state: Column | str, now: Column) -> Column:
    """Seconds since start, for running containers only."""
    age = F.unix_timestamp(now.cast("timestamp")) - start_epoch(started_at)
    return F.when(_col(state) == "running", age)
