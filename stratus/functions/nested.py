"""Access into nested payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nested_or_default(variant: Column | str, path: str, as_type: str, default=None) -> Column:
    """Typed value at a JSON path; ``default`` when the path is absent or not of that type."""
    variant = F.col(variant) if isinstance(variant, str) else variant
    value = F.try_variant_get(variant, path, as_type)
    return value if default is None else F.coalesce(value, F.lit(default))


def first_element(array: Column | str, field: str | None = None) -> Column:
    """First array element, or one of its fields; NULL for an empty array."""
    array = F.col(array) if isinstance(array, str) else array
    item = F.get(array, F.lit(0))
    return item.getField(field) if field else item


def json_array_items(variant: Column | str, path: str) -> Column:
    variant = F.col(variant) if isinstance(variant, str) else variant
    return F.try_variant_get(variant, path, "array<variant>")


def row_json(*columns: str) -> Column:
    """The named columns as one JSON text; NULL fields stay present, non-ASCII stays as is."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
