"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A lambda that refers to an expression computes it again for every element; as the element of a one-element
    array it is a variable of the lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
