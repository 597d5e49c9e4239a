"""Tables stored in buckets of a key, for joins that move no rows.

Two tables with the same number of buckets of the join key are joined bucket by bucket, in place. A bucketed
table is known to the session's catalog; the files lie where the caller says, and another session declares
them by :func:`open_bucketed`. The number of buckets is part of the layout: choose it so that a bucket of
the largest table fits a task, and keep it for all tables that are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Bytes of a bucket that a task reads well.
BUCKET_BYTES = 256 << 20


def buckets_for(n_bytes: int) -> int:
    """Power of two of buckets for a table of that size."""
    return 1 << max(3, (-(-n_bytes // BUCKET_BYTES) - 1).bit_length())


def store_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int, partition_by: list[str] | None = None
) -> DataFrame:
    """Writes ``df`` to ``path`` as the table ``name``, in sorted buckets of ``key``; returns the table.

    Each bucket is gathered into one task before it is written, so it is one file (and one for each
    value of ``partition_by``).
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", path).mode("errorifexists").saveAsTable(name)
    return spark.table(name)


def open_bucketed(
    spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Declares a stored table to this session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    split = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet {split} "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE `{name}`")
    return spark.table(name)
