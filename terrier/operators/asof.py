"""Joining events to the version of their key that was valid at the time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(
    events: DataFrame, versions: DataFrame, keys: list[str], at: str, columns: list[str],
    valid_from: str = "VALID_FROM", valid_to: str = "VALID_TO", period: str = "month",
) -> DataFrame:
    """Every event with ``columns`` of the version of its key that is valid at ``at``, or NULLs.

    A version is valid from ``valid_from`` on and before ``valid_to`` (NULL: without end); of several that
    have started the last one counts. Events and versions are sorted together and the last version is
    carried forward, so no pair of rows is formed. A hot key is split by ``period``: each of its
    periods begins with the version carried into it, which a first, small pass finds for the distinct pairs
    of key and period. NULL is an ordinary key; an event without a time has no version.
    """
    taken = F.struct(*columns, F.col(valid_to).alias("_until"))
    starts = versions.where(F.col(valid_from).isNotNull()).select(
        *keys, F.col(valid_from).cast("timestamp").alias("_t"), taken.alias("_version"))
    begin = F.date_trunc(period, F.col("_t"))

    dated = events.select(*keys, F.col(at).cast("timestamp").alias("_t"), F.struct("*").alias("_event"))
    periods = dated.where("_t is not null").select(*keys, begin.alias("_t")).distinct()
    carried = _last_version(
        _tagged(starts, 0).unionByName(_tagged(periods, 1), allowMissingColumns=True), keys,
    ).where("_kind = 1 and _version is not null")

    placed = [_tagged(carried.select(*keys, "_t", "_version"), 0), _tagged(starts, 1), _tagged(dated, 2)]
    rows = placed[0].unionByName(placed[1]).unionByName(placed[2], allowMissingColumns=True)
    found = _last_version(rows.withColumn("_period", begin), [*keys, "_period"]).where("_kind = 2")
    valid = F.col("_version._until").isNull() | (F.col("_t") < F.col("_version._until").cast("timestamp"))
    valid &= F.col("_t").isNotNull()
    return found.select("_event.*", *(F.when(valid, F.col(f"_version.{c}")).alias(c) for c in columns))


def _tagged(df: DataFrame, kind: int) -> DataFrame:
    """``kind`` orders rows of the same time."""
    return df.withColumn("_kind", F.lit(kind))


def _last_version(rows: DataFrame, by: list[str]) -> DataFrame:
    window = Window.partitionBy(*by).orderBy("_t", "_kind", _open_last(F.col("_version")))
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_version", F.last("_version", ignorenulls=True).over(upto))


def _open_last(version: Column) -> Column:
    """Of versions that start together the one that ends last, then a fixed one."""
    return F.struct(version["_until"].isNull(), version["_until"], version)
