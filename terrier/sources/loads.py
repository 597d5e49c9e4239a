"""Loads of raw CSV files that keep bad rows apart and can be repeated.

The files are parsed once, into a scratch table split by outcome. Good rows replace the partitions (year and
département) that the files hold rows of; bad rows are stored under their file with the reason, in place of
those that an earlier load of the file stored. So a load that is run again changes nothing.

Disk: good rows are gathered by partition in slices of a hash of the partition, and what a slice shuffled is
deleted before the next one. Bad rows are not shuffled, as a file's lie where its lines were parsed. The scratch
table goes with the load. Both tables keep two versions, compressed by zstd, until they are vacuumed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.session import written, written_meanwhile
from terrier.sources.bronze import SALES_SCHEMA
from terrier.sources.files import sale_year
from terrier.sources.manifest import PartitionedTable

CORRUPT, FILE, REASON, LINE = "_corrupt_record", "FICHIER", "MOTIF", "LIGNE"
_FILE_KEY = "FICHIER_ID"  # names of files need not be fit for folders
_SLICE, _BAD = "_slice", -1
# Bytes of files whose good rows are gathered at a time, in at most so many slices: the parse has a writer open
# for each, which costs it a tenth of its time with four. Larger loads have larger slices; what a quarter shuffles
# is about as large as the second version of the tables, for which there must be room in any case.
SLICE_BYTES, SLICES, CODEC = 64 << 20, 4, "zstd"


@dataclass
class Load:
    """What a load did: one row per file with the rows ``CHARGEES`` and ``REJETEES``."""

    files: DataFrame
    accepted: PartitionedTable
    rejected: PartitionedTable


def sale_faults() -> dict[str, Column]:
    """What makes a raw sale line useless, by reason; the first that holds counts."""
    day = F.col("DATE_MUTATION")
    amount = F.nullif(F.trim("VALEUR_FONCIERE"), F.lit(""))
    return {
        "COLONNES": F.col(CORRUPT).isNotNull(),
        "DATE": day.isNull() | ~day.rlike(r"^\d{2}/\d{2}/\d{4}$") | F.try_to_date(day, "dd/MM/yyyy").isNull(),
        "MONTANT": amount.isNotNull() & ~amount.rlike(r"^\d+([,.]\d+)?$"),
        "DEPARTEMENT": F.coalesce(F.trim("CODE_DEPARTEMENT"), F.lit("")) == "",
    }


def _bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of the files that ``paths``, which may be folders or hold wildcards, stand for."""
    found = 0
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found += sum(system.getContentSummary(x.getPath()).getLength() for x in system.globStatus(path) or [])
    return found


def load_csv(
    spark: SparkSession, paths: str | list[str], target: str, rejected: str,
    schema: T.StructType = SALES_SCHEMA, sep: str = ",", encoding: str = "UTF-8", null_text: str = "",
    faults: dict[str, Column] | None = None, partitions: dict[str, Column] | None = None, header: bool = True,
) -> Load:
    """Loads raw CSV files into the table ``target``; rows with a fault go to the table ``rejected``.

    A line with too few or too many columns is a fault as well. A file is known by its name. ``partitions`` are the columns that the
    target is split by; every partition that the files hold a good row of is replaced as a whole.
    """
    reasons = sale_faults() if faults is None else faults
    split = partitions or {"annee": sale_year(), "departement": F.trim("CODE_DEPARTEMENT")}
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(full).csv(
        paths, header=header, sep=sep, encoding=encoding, quote='"', escape='"', nullValue=null_text,
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    reason = F.lit(None).cast("string")
    for name, fault in reversed(reasons.items()):
        reason = F.when(fault, F.lit(name)).otherwise(reason)
    size = _bytes(spark, [paths] if isinstance(paths, str) else paths)
    slices = max(1, min(SLICES, math.ceil(size / SLICE_BYTES)))
    place = F.when(F.col(REASON).isNotNull(), _BAD).otherwise(F.pmod(F.hash(*split.values()), F.lit(slices)))
    rows = raw.select(
        "*", F.substring_index("_metadata.file_path", "/", -1).alias(FILE), reason.alias(REASON)
    ).withColumn(_SLICE, place)
    with written_meanwhile(rows, "csv-load", split_by=_SLICE, even=True, codec=CODEC) as parsed:
        good = [parsed.where(F.col(_SLICE) == n).select(*schema.names).withColumns(split) for n in range(slices)]
        accepted = PartitionedTable(spark, target, list(split), CODEC)
        accepted.replace(good)
        # A line that does not fit the columns is kept as it stands, others as their columns.
        line = F.coalesce(CORRUPT, F.to_csv(F.struct(*schema.names), {"sep": sep}))
        bad = parsed.where(F.col(_SLICE) == _BAD).select(FILE, REASON, line.alias(LINE), F.md5(FILE).alias(_FILE_KEY))
        kept_bad = PartitionedTable(spark, rejected, [_FILE_KEY], CODEC)
        files = written(parsed.groupBy(FILE).agg(
            F.count_if(F.col(REASON).isNull()).alias("CHARGEES"),
            F.count_if(F.col(REASON).isNotNull()).alias("REJETEES")), "load-log")
        names = [r[0] for r in files.select(F.md5(FILE)).collect()]  # one row a file
        kept_bad.replace(bad, [f"{_FILE_KEY}={name}" for name in names], gathered=True)
    return Load(files, accepted, kept_bad)
