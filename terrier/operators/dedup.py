"""Duplicate removal by aggregation: copies collapse on the map side, before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from terrier.session import written

# Hashes shared by several rows that are broadcast at most, about 40 bytes each.
MAX_SHARED = 1 << 20


def distinct_blank_insensitive(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per combination of ``columns``, NULL and ``''`` counting as the same value.

    The surviving row is the first in ascending order with NULLs last. Rows of one group differ
    only in which blanks are NULL, so a bit mask of the NULLs orders them, and the whole step is a
    hash aggregation with an integer buffer.
    """
    weights = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    nulls = sum(
        (F.when(F.col(c).isNull(), F.lit(w)).otherwise(F.lit(0)) for c, w in weights.items()),
        F.lit(0),
    )
    return (
        df.groupBy(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns))
        .agg(F.min(nulls).alias("_nulls"))
        .select(
            *(
                F.when(F.col("_nulls").bitwiseAND(w) == 0, F.col(c)).alias(c)
                for c, w in weights.items()
            )
        )
    )


def counted_rows(df: DataFrame, n: str, max_shared: int = MAX_SHARED) -> DataFrame:
    """The distinct rows of ``df``, NULLs being equal, with their number ``n``.

    For wide rows that seldom repeat: their hashes are counted first. A row whose hash no other row has
    stands alone and is not moved; the others are grouped by all columns. Beyond ``max_shared`` repeated
    hashes all rows are grouped. ``df`` is read three times, so it should be a stored table.
    """
    columns = df.columns
    hashed = df.withColumn("_hash", F.xxhash64(*columns))
    several = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    several = written(several, "shared-hashes")
    grouped = (lambda rows: rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(n)))
    if several.count() > max_shared:
        return grouped(df)
    shared = F.broadcast(several)  # at most ``max_shared`` numbers
    alone = hashed.join(shared, "_hash", "left_anti").select(*columns, F.lit(1).cast("bigint").alias(n))
    return alone.unionByName(grouped(hashed.join(shared, "_hash", "left_semi")))


def first_per_key(
    df: DataFrame, key: list[str], order: list[str], keep: list[str]
) -> DataFrame:
    """The first of ``keep`` per key, in ascending order of ``order`` with NULLs last.

    Exact copies are removed by a hash aggregation before anything is sorted.
    """
    distinct = df.select(*dict.fromkeys([*key, *order, *keep])).distinct()
    window = Window.partitionBy(*key).orderBy(*(F.asc_nulls_last(c) for c in order))
    return _first_row(distinct, window).select(*key, *keep)


def best_per_key(df: DataFrame, key: str, payload: Column, order: list[Column]) -> DataFrame:
    """``payload`` of the first row per key in the given order, as ``(key, payload)``.

    The optimiser keeps one row per key and map task, so a hot key arrives as a few rows.
    """
    ranks = {f"_o{i}": c for i, c in enumerate(order)}
    rows = df.select(key, payload.alias("payload"), *(c.alias(n) for n, c in ranks.items()))
    window = Window.partitionBy(key).orderBy(*(F.asc_nulls_last(n) for n in ranks))
    return _first_row(rows, window).select(key, "payload")


def _first_row(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumn("_row", F.row_number().over(window)).where(F.col("_row") == 1)
