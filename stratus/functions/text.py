"""Text helpers for keys, labels and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words whose presence marks a log line as an error line.
LOG_ERROR_WORDS = (
    "error", "exception", "traceback", "warning", "import",
    "module", "no module", "syntaxerror", "cannot",
)
LOG_ERROR_PATTERN = "(?i)(" + "|".join(LOG_ERROR_WORDS) + ")"

# Fixed value: longest error text shown in a report.
ERROR_TEXT_LENGTH = 500


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_trim(text: Column | str, separator: str = ",") -> Column:
    """Items of a separated list, trimmed, empty ones removed."""
    pieces = F.split(_col(text), separator)
    return F.filter(F.transform(pieces, lambda item: F.trim(item)), lambda item: item != "")


def object_key(source: Column | str, city: Column | str, at: Column | str) -> Column:
    """Storage key ``raw/<source>/year=/month=/day=/<source>_<city>_<epoch>.parquet``."""
    source, city, at = _col(source), _col(city), _col(at)
    return F.concat(
        F.lit("raw/"), source,
        F.date_format(at, "'/year='yyyy'/month='MM'/day='dd'/'"),
        F.concat_ws("_", source, F.lower(city), F.unix_timestamp(at.cast("timestamp")).cast("string")),
        F.lit(".parquet"),
    )


def error_prefix(text: Column | str, length: int = ERROR_TEXT_LENGTH) -> Column:
    return F.left(_col(text), F.lit(length))


def relabel(name: Column | str) -> Column:
    """Container name without its leading slash; a name not of that form is left out as ''."""
    return F.regexp_extract(_col(name), "^/(.*)$", 1)


def label_matches(label: Column | str, pattern: str, negate: bool = False) -> Column:
    """Fully anchored label match. A missing label counts as the empty string."""
    hit = F.coalesce(_col(label), F.lit("")).rlike(f"^(?:{pattern})$")
    return ~hit if negate else hit


def matches_log_errors(line: Column | str) -> Column:
    return _col(line).rlike(LOG_ERROR_PATTERN)


def log_line(container: Column | str, line: Column | str) -> Column:
    return F.concat(F.lit("["), _col(container), F.lit("] "), _col(line))
