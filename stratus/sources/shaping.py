"""Nested data to relations: flatten, unnest, merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, separator: str = "__") -> DataFrame:
    """Replace every nested field by a column named after its path."""

    def leaves(fields: list[T.StructField], parent: Column | None, prefix: str) -> list[Column]:
        found: list[Column] = []
        for field in fields:
            here = parent.getField(field.name) if parent is not None else F.col(f"`{field.name}`")
            name = prefix + field.name
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType.fields, here, name + separator)
            else:
                found.append(here.alias(name))
        return found

    return df.select(*leaves(df.schema.fields, None, ""))


def unnest_child(df: DataFrame, array: str, parent_id: str) -> DataFrame:
    """Child relation of an array of objects, one row per element.

    Carries the parent id, the position and an own id derived from both. A
    parent with an empty or missing array has no child rows. No shuffle.
    """
    child = df.select(
        F.col(parent_id).alias("_parent_id"), F.posexplode(array).alias("_position", "_item")
    )
    row_id = F.sha2(F.concat_ws("/", F.col("_parent_id").cast("string"), F.col("_position").cast("string")), 256)
    return child.withColumn("_row_id", row_id).select("_row_id", "_parent_id", "_position", "_item.*")


def merge_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column one side lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
