"""Changes between two loads of a table."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_FROM, VALID_TO, IS_CURRENT = "VALID_FROM", "VALID_TO", "IS_CURRENT"


def new_rows(current: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the stored table does not hold; NULL is an ordinary key value."""
    known = stored.select(*(F.col(k).alias(f"_k_{k}") for k in keys)).distinct()
    return current.join(known, _same_key(keys), "left_anti")


def _same_key(keys: list[str]) -> Column:
    """Key of one side equal to the ``_k_`` key of the other, NULLs being equal."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))


def loaded_since(df: DataFrame, last_run: dt.datetime) -> DataFrame:
    """Rows of a stored table that were written after the last run."""
    return df.where(F.col("CREATED_AT") > F.lit(last_run))


def _fingerprint(columns: list[str]) -> Column:
    """Hash that tells NULL from blank."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def start_history(snapshot: DataFrame, as_of: dt.date) -> DataFrame:
    """The first load of a history: every row is current."""
    return snapshot.select(
        "*",
        F.lit(as_of).alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
    )


def merge_history(
    history: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str], as_of: dt.date
) -> DataFrame:
    """Type-2 history after a new snapshot.

    Rows whose tracked columns changed are closed at ``as_of`` and followed by a new version; keys
    missing from the snapshot are closed; unknown keys start. One full join on the key, in which
    NULL is an ordinary value.
    """
    columns = [*keys, *tracked]
    current = history.where(F.col(IS_CURRENT)).select(
        *keys, F.struct(*tracked).alias("_old"), _fingerprint(tracked).alias("_old_hash"),
        F.col(VALID_FROM).alias("_from"),
    )
    incoming = snapshot.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys),
        F.struct(*tracked).alias("_new"),
        _fingerprint(tracked).alias("_new_hash"),
    )
    both = current.join(incoming, _same_key(keys), "full")
    known = F.col("_old_hash").isNotNull()
    unchanged = F.coalesce(F.col("_old_hash") == F.col("_new_hash"), F.lit(False))

    def version(row: str, start: Column, end: Column, open_: Column, when: Column) -> Column:
        return F.when(
            when,
            F.struct(
                *(F.col(f"{row}.{c}").alias(c) for c in tracked),
                start.alias(VALID_FROM), end.alias(VALID_TO), open_.alias(IS_CURRENT),
            ),
        )

    never = F.lit(None).cast("date")
    kept = version(
        "_old", F.col("_from"), F.when(~unchanged, F.lit(as_of)), unchanged,
        known,
    )
    started = version(
        "_new", F.lit(as_of), never, F.lit(True), F.col("_new_hash").isNotNull() & ~unchanged
    )
    key = [F.when(known, F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys]
    versions = both.select(*key, F.inline(F.array_compact(F.array(kept, started))))
    closed = history.where(~F.col(IS_CURRENT)).select(*columns, VALID_FROM, VALID_TO, IS_CURRENT)
    return closed.unionByName(versions.select(*columns, VALID_FROM, VALID_TO, IS_CURRENT))
