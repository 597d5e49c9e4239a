"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning carries much of the skew handling: it splits hot partitions of a join and
# turns a shuffled join into a broadcast one only after measuring the small side.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(app: str = "terrier", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans count on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="terrier-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/terrier-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other call has been given."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _SCOPES:
        paths.append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving what was written to the scratch folder meanwhile.

    For builds whose results are stored elsewhere: tables read back from the scratch folder are gone.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Folders that one task may write to at the same time.
WRITERS = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_writing, _writing_lock = [], threading.Lock()


@contextmanager
def unsorted_split(spark: SparkSession) -> Iterator[None]:
    """Writes to few folders need no sort meanwhile: a task keeps a writer open for each.

    Else Spark sorts the rows of every task by folder, in memory that grows with the rows of a task. From
    the 17th folder of a task on it does so again. A setting of the session's owner stays.
    """
    with _writing_lock:
        if not _writing and spark.conf.get(_WRITERS) != "0":
            own = False
        else:
            own = True
            _writing.append(1)
            spark.conf.set(_WRITERS, WRITERS)
    try:
        yield
    finally:
        with _writing_lock:
            if own:
                _writing.pop()
                if not _writing:
                    spark.conf.unset(_WRITERS)


class _Meanwhile:
    """Settings that hold while any thread asks for them. A setting of the session's owner stays."""

    def __init__(self) -> None:
        self.lock, self.users, self.own = threading.Lock(), 0, []

    @contextmanager
    def hold(self, spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
        with self.lock:
            if not self.users:
                self.own = [(spark, key) for key in settings if spark.conf.get(key, None) is None]
                for _, key in self.own:
                    spark.conf.set(key, settings[key])
            self.users += 1
        try:
            yield
        finally:
            with self.lock:
                self.users -= 1
                if not self.users:
                    for first, key in self.own:
                        first.conf.unset(key)


# Tasks that a write is cut into at least, for each core, as far as its input has a few MB for each of them.
TASKS_A_CORE = 3
_TASKS = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
_cutting, _dropping = _Meanwhile(), _Meanwhile()


@contextmanager
def even_tasks(spark: SparkSession) -> Iterator[None]:
    """Writes are cut into several tasks a core meanwhile, both where they read files and after a shuffle.

    Spark aims at one task a core and, as whole files are dealt out, makes a few more: these run alone while
    most cores wait, and their files hand the same number of tasks to the next reader. A setting of the
    session's owner stays.
    """
    tasks = str(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    with _cutting.hold(spark, dict.fromkeys(_TASKS, tasks)):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What the writes started meanwhile shuffle is deleted as soon as each of them ends.

    Else it lies on the executors' disks until the driver collects garbage, beside that of later writes. For
    frames written once: to run the same frame object again would shuffle again. A setting of the session's
    owner stays.
    """
    with _dropping.hold(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def written(df: DataFrame, name: str, split_by: str | None = None, even: bool = False) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage at a durable table, so a lost executor costs no recomputation, and gives the
    optimiser the real size of the result; with ``split_by``, a column of few values, also that of each
    value's rows. ``even`` cuts the work into several tasks a core (:func:`even_tasks`).
    """
    return _written_to(scratch_path(df.sparkSession, name), df, split_by, even)


@contextmanager
def written_meanwhile(
    df: DataFrame, name: str, split_by: str | None = None, even: bool = False, codec: str | None = None
) -> Iterator[DataFrame]:
    """:func:`written` for a table that is deleted on leaving; ``codec`` is how its files are compressed."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _written_to(path, df, split_by, even, codec)
    finally:
        _delete(df.sparkSession, path)


def _written_to(
    path: str, df: DataFrame, split_by: str | None, even: bool, codec: str | None = None
) -> DataFrame:
    spark = df.sparkSession
    writer = df.write.option("compression", codec) if codec else df.write
    with even_tasks(spark) if even else nullcontext():
        if split_by:
            with unsorted_split(spark):
                writer.partitionBy(split_by).parquet(path)
        else:
            writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
