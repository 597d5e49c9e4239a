"""Left joins to a side that holds one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``, unique in ``right``.

    How is left to the optimiser: it knows the size of a stored side, and splits hot keys of the left
    side of a merge join at run time.
    """
    return left.join(right, key, "left")


def equal_as_blank(left: Column, right: Column) -> Column:
    """Equality with NULL counting as ``''``."""
    return F.coalesce(left, F.lit("")) == F.coalesce(right, F.lit(""))
