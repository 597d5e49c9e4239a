"""Gives the executors this package, which they need not have installed."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import terrier
from terrier.session import scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once a session: an archive of the package in the shared folder, from where tasks import it."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(terrier.__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    path = f"{scratch_path(spark, 'package')}/terrier.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)
