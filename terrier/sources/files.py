"""Loading of raw CSV files and storing of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources.bronze import SALES_SCHEMA, read_raw


def sale_year() -> Column:
    """Year of a raw ``DD/MM/YYYY`` date, as text."""
    return F.substring("DATE_MUTATION", 7, 4)


def ingest_csv(
    spark: SparkSession,
    paths: str | list[str],
    target: str,
    schema: T.StructType = SALES_SCHEMA,
    sep: str = ",",
    encoding: str = "UTF-8",
    null_text: str = "",
    partitions: dict[str, Column] | None = None,
) -> int:
    """Load raw CSV files into a partitioned bronze table; returns the number of rows loaded.

    Sales are split by year and département unless told otherwise. The rebalance hint gathers the
    rows of a partition into few files and splits partitions that would be too large. The count is
    taken while writing.
    """
    if partitions is None:
        partitions = {"annee": sale_year(), "departement": F.col("CODE_DEPARTEMENT")}
    loaded = Observation("ingest")
    rows = read_raw(spark, paths, schema, "csv", sep, encoding, null_text)
    rows = rows.observe(loaded, F.count(F.lit(1)).alias("rows"))
    if partitions:
        rows = rows.withColumns(partitions).hint("rebalance", *partitions)
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(target)
    return loaded.get["rows"]


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """A partitioned bronze table; keys stay text (``01`` is not ``1``)."""
    full = T.StructType([*schema.fields, *(T.StructField(k, T.StringType()) for k in keys)])
    return spark.read.schema(full).parquet(path)


def export_csv(
    df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", null_text: str = "",
    compression: str = "none",
) -> None:
    df.write.mode("overwrite").csv(
        path, header=True, sep=sep, encoding=encoding, quote='"', escape='"',
        nullValue=null_text, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        compression=compression,
    )


def schema_name(default: str, custom: str | None = None) -> str:
    """A table's own schema if it names one, else the schema of the target."""
    return custom.strip() if custom else default


def table_name(name: str, default_schema: str, schema: str | None = None, catalog: str = "") -> str:
    parts = [catalog, schema_name(default_schema, schema), name]
    return ".".join(p for p in parts if p)


def create_view(df: DataFrame, name: str) -> None:
    """Silver tables are views: nothing is stored."""
    df.createOrReplaceTempView(name)


def table_path(root: str, name: str, default_schema: str, schema: str | None = None) -> str:
    """Folder of a table below ``root``, named like the table."""
    return "/".join([root.rstrip("/"), *table_name(name, default_schema, schema).split(".")])


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions of a table, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    done = hadoop.Path(f"{path}/v*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(f.getPath().getParent().toString() for f in found)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest complete version of a stored table."""
    newest = _versions(spark, path)[-1]
    return (spark.read.schema(schema) if schema else spark.read).parquet(newest)


def overwrite_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, keep: int = 2
) -> DataFrame:
    """Gold tables are rebuilt in full; returns the stored table.

    A rebuild goes to a new version folder, which counts once it is complete: readers of the version
    before go on, and a failed run leaves it in place. Two runs at once cannot mix, as the second
    finds its folder taken. Only the newest ``keep`` versions stay.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    number = int(versions[-1].rpartition("/v")[2]) + 1 if versions else 1
    target = f"{path}/v{number:08d}"
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(target)
    else:
        df.write.parquet(target)
    for old in _versions(spark, path)[:-keep]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema(df.schema).parquet(target)
