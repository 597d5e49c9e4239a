"""Samples of a wanted size that need no sorting and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 1 << 31


def hashed_share(column: str, wanted: int, rows: int, without: str | None = None) -> Column:
    """Holds for about ``wanted`` of ``rows`` rows: those whose hashed column is below that share.

    Rows of equal value go together; all rows are in if they are not more than wanted. Where the column is
    null, column ``without`` is hashed.
    """
    place = F.xxhash64(column)
    if without is not None:
        place = F.when(F.col(column).isNull(), F.xxhash64(without)).otherwise(place)
    share = min(1.0, wanted / max(1, rows))
    return F.pmod(place, F.lit(PLACES)) < int(share * PLACES)
