"""Tables split by keys whose partitions are replaced one by one, under a manifest.

A load writes new files for the partitions it touches and nothing else, then commits one manifest that
names the folders of every partition. Readers take the newest whole manifest, so they see all of a
load or nothing of it; a failed load leaves files that no manifest names. Of two loads at the same
time the one that commits second fails, because its manifest number is taken.

    path/data/load=<id>/ANNEE=1998/part-...     files of one load
    path/manifests/00000007.json                folders by partition, schema, rows of the load
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrier.session import shuffles_dropped, unsorted_split

LOAD = "load"


class ConcurrentLoad(RuntimeError):
    """Another load was committed since this one began."""


class PartitionedTable:
    """A table below ``path``, split by the columns ``keys``; ``codec`` is how new files are compressed."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], codec: str | None = None):
        self.spark, self.path, self.keys, self.codec = spark, path.rstrip("/"), keys, codec

    # ------------------------------------------------------------ manifests

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        """Names of what a folder holds; an absent folder holds nothing."""
        folder, system = self._folder(path)
        if not system.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(folder))

    def _manifest(self, name: str) -> dict | None:
        """A manifest, or None if its writer did not finish."""
        path, system = self._folder(f"{self.path}/manifests/{name}")
        stream = system.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def _manifests(self) -> list[tuple[str, dict]]:
        named = ((n, self._manifest(n)) for n in self._names(f"{self.path}/manifests") if n.endswith(".json"))
        return [(n, m) for n, m in named if m is not None]

    def manifest(self) -> dict:
        """The newest committed state: ``partitions``, ``schema`` and ``rows`` of its load."""
        for name in reversed(self._names(f"{self.path}/manifests")):
            found = self._manifest(name) if name.endswith(".json") else None
            if found is not None:
                return found
        return {"partitions": {}, "schema": None, "rows": 0}

    def _commit(self, number: int, manifest: dict) -> None:
        path, system = self._folder(f"{self.path}/manifests/{number:08d}.json")
        try:
            stream = system.create(path, False)
        except Exception as error:
            raise ConcurrentLoad(f"{path} is taken") from error
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()

    # ------------------------------------------------------------ loads

    def replace(
        self, df: DataFrame | list[DataFrame], touched: Iterable[str] = (), gathered: bool = False
    ) -> int:
        """Replaces the partitions that ``df`` has rows of, and those ``touched`` names.

        ``touched`` holds partition names such as ``ANNEE=1998``; one without rows becomes empty. Returns
        the number of rows written. The rows of a partition are gathered into few files by a shuffle, unless
        they are ``gathered`` in few tasks. A list of frames, best without a partition in common, is written one
        after the other and committed at once, so that only the shuffle of one lies on disk.
        """
        return self._load(df if isinstance(df, list) else [df], set(touched), False, gathered)

    def append(self, df: DataFrame) -> int:
        """Adds rows; no partition loses any."""
        return self._load([df], set(), keep_old=True)

    def _load(self, parts: list[DataFrame], touched: set[str], keep_old: bool, gathered: bool = False) -> int:
        committed = self._names(f"{self.path}/manifests")
        number = int(committed[-1].split(".")[0]) + 1 if committed else 1
        before = self.manifest()
        load = f"{LOAD}={uuid.uuid4().hex}"
        folder = f"{self.path}/data/{load}"
        for df in parts:
            self._write(df, folder, gathered)
        written = self._partitions(folder, len(self.keys))
        partitions = {k: list(v) for k, v in before["partitions"].items() if keep_old or k not in touched}
        for name in written:
            partitions[name] = [*(partitions.get(name, []) if keep_old else []), load]
        # The footers of the new files tell how many rows they hold.
        schema = parts[0].schema
        loaded = self.spark.read.schema(schema).parquet(folder).count() if written else 0
        self._commit(number, {"partitions": partitions, "schema": schema.json(), "rows": loaded})
        return loaded

    def _write(self, df: DataFrame, folder: str, gathered: bool) -> None:
        options = {"compression": self.codec} if self.codec else {}
        with unsorted_split(self.spark) if gathered else shuffles_dropped(self.spark):
            rows = df if gathered else df.hint("rebalance", *self.keys)
            rows.write.options(**options).mode("append").partitionBy(*self.keys).parquet(folder)

    def _partitions(self, folder: str, depth: int) -> list[str]:
        names = [n for n in self._names(folder) if "=" in n]
        if depth == 1:
            return names
        return [f"{n}/{rest}" for n in names for rest in self._partitions(f"{folder}/{n}", depth - 1)]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes older manifests and the folders that only they name; returns those folders.

        Folders of loads that are still being written are named by no manifest and stay.
        """
        manifests = self._manifests()
        old, kept = manifests[:-keep], manifests[-keep:]
        used = {(k, load) for _, m in kept for k, loads in m["partitions"].items() for load in loads}
        gone = sorted({(k, load) for _, m in old for k, loads in m["partitions"].items() for load in loads} - used)
        for name, load in gone:
            folder, system = self._folder(f"{self.path}/data/{load}/{name}")
            system.delete(folder, True)
        for name, _ in old:
            manifest, system = self._folder(f"{self.path}/manifests/{name}")
            system.delete(manifest, False)
        return [f"{load}/{name}" for name, load in gone]

    # ------------------------------------------------------------ reading

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The rows of the newest manifest; before the first load an empty table of ``schema``."""
        now = self.manifest()
        if now["schema"] is not None:
            schema = T.StructType.fromJson(json.loads(now["schema"]))
        if schema is None:
            raise ValueError(f"{self.path} holds no load")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        folders = [f"{self.path}/data/{load}/{name}"
                   for name, loads in sorted(now["partitions"].items()) for load in loads]
        if not folders:
            return self.spark.createDataFrame([], schema)
        with_load = T.StructType([*schema, T.StructField(LOAD, T.StringType())])
        rows = self.spark.read.schema(with_load).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*schema.names)

    def names(self) -> set[str]:
        """Partitions that hold rows."""
        return set(self.manifest()["partitions"])
