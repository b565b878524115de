"""Column functions. Everything here stays inside Catalyst; there are no Python UDFs."""

from stratus.functions.nested import first_element, json_array_items, nested_or_default, row_json
from stratus.functions.rounding import pg_round, register_sql_functions
from stratus.functions.text import (
    error_prefix,
    label_matches,
    log_line,
    matches_log_errors,
    object_key,
    relabel,
    split_trim,
)
from stratus.functions.timing import (
    as_instant,
    day_start,
    elapsed_seconds,
    epoch_micros,
    epoch_to_timestamp,
    seconds_between,
)

__all__ = [
    "as_instant",
    "day_start",
    "elapsed_seconds",
    "epoch_micros",
    "epoch_to_timestamp",
    "error_prefix",
    "first_element",
    "json_array_items",
    "label_matches",
    "log_line",
    "matches_log_errors",
    "nested_or_default",
    "object_key",
    "pg_round",
    "register_sql_functions",
    "relabel",
    "row_json",
    "seconds_between",
    "split_trim",
]
