"""What grows with the input: shuffled, written and sorted rows."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terrier.operators import dedup
from terrier.plans.incremental import _may_be_of
from terrier.registry.core import Context
from terrier.registry.loads import _bad_rows
from terrier.session import TASKS_A_CORE, even_tasks, scratch_root, shuffles_dropped, unsorted_split, written
from terrier.sources import bronze
from terrier.sources.manifest import PartitionedTable
from test_plans import plan


def base_tables(spark, folder):
    """Lines, orders and customers with missing, repeated and unmatched keys."""
    frames = {
        "nation": spark.createDataFrame([(0, "FRANCE"), (1, "PERU")], "n_nationkey int, n_name string"),
        "customer": spark.createDataFrame(
            [(1, 0), (2, 1), (2, 1), (3, 7), (None, 0), (4, None)], "c_custkey long, c_nationkey int"),
        "orders": spark.createDataFrame(
            [(10, 1, dt.date(1995, 3, 4), "F"), (11, 2, dt.date(1996, 11, 30), "P"), (12, 3, None, "O"), (11, 2, None, "O"),
             (None, 1, None, "O"), (13, None, None, "O")],
            "o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string"),
        "lineitem": spark.createDataFrame(
            [(k, p, s, n, 3.0, 30000.5 + n, "unused") for k in (10, 11, 12, 13, 100, None) for p, s, n in ((1, 2, 1), (50, 3, 7), (None, None, 2))],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_comment string"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return frames


def test_sales_are_derived_in_another_order_with_the_same_rows(spark, tmp_path):
    """Lines are dealt once, as numbers; the text rows made of them are not."""
    tables = base_tables(spark, tmp_path)
    got, wanted = bronze.derived_sales(spark, str(tmp_path)), spark.sql(bronze.DERIVED_SALES_SQL, **tables)
    assert got.columns == wanted.columns and got.dtypes == wanted.dtypes
    assert got.count() == wanted.count() > 0
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    details = [x for x in plan(got).split("\n\n") if "Arguments: hashpartitioning" in x]
    assert len(details) == 1 and "hashpartitioning(l_orderkey" in details[0] and "l_comment" not in details[0]


def test_a_split_table_is_written_without_a_sort(spark):
    """A task keeps a writer open for each of a few folders; its rows are not sorted in memory."""
    rows = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 5 + 1990).cast("int").alias("year"))
    seen = []
    with unsorted_split(spark):
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        with unsorted_split(spark):
            pass
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
    assert seen == ["16", "16"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    stored = written(rows, "split", split_by="year")
    assert stored.exceptAll(rows).isEmpty() and stored.count() == 1000
    # More folders than writers still work.
    many = written(rows.withColumn("year", F.col("id") % 40), "many", split_by="year")
    assert many.count() == 1000 and many.select("year").distinct().count() == 40


def test_an_owner_of_the_session_keeps_its_setting(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(name, "3")
    try:
        with unsorted_split(spark):
            assert spark.conf.get(name) == "3"
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.unset(name)


ROWS = [("a", None), (None, "a"), ("a", None), ("b", "c"), (None, None), (None, None), ("", None), ("x", "y")]


@pytest.mark.parametrize("max_shared", [0, 100])
def test_rows_are_counted_whether_they_repeat_or_not(spark, max_shared):
    df = spark.createDataFrame(ROWS, "a string, b string")
    wanted = df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    got = dedup.counted_rows(df, "n", max_shared)
    assert got.dtypes == wanted.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_single_rows_are_not_shuffled(spark):
    """Only rows that share their hash are grouped: one exchange, behind the semi join."""
    df = written(spark.createDataFrame(ROWS, "a string, b string"), "rows")
    tree = plan(dedup.counted_rows(df, "n")).split("\n\n")[0]
    assert tree.count("Exchange") - tree.count("BroadcastExchange") - tree.count("ReusedExchange") == 1
    assert "LeftSemi" in tree and "LeftAnti" in tree


def test_a_load_parses_the_rows_of_its_years(spark):
    dates = ["31/12/1997", "01/01/1998", "1/1/98", "01/01/01998", None, "01-01-1997"]
    df = spark.createDataFrame([(d,) for d in dates], "DATE_MUTATION string")
    kept = {r[0] for r in df.where(_may_be_of([1998])).collect()}
    assert kept == set(dates) - {"31/12/1997"}  # what is not plainly dated is left to the strict parse


def test_a_write_is_cut_into_several_tasks_a_core(spark, tmp_path):
    """As many as cores and a few more would leave most cores waiting for the last ones."""
    keys = ["spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum"]
    cores = spark.sparkContext.defaultParallelism
    n = TASKS_A_CORE * cores
    spark.range(n * 10).repartition(n).write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    stored = written(source, "even", even=True)
    assert len(stored.inputFiles()) > 2 * cores and stored.count() == n * 10
    assert [spark.conf.get(k, None) for k in keys] == [None, None]
    try:  # a setting of the session's owner stays
        spark.conf.set(keys[0], "1")
        with even_tasks(spark), even_tasks(spark):
            assert [spark.conf.get(k) for k in keys] == ["1", str(n)]
        assert [spark.conf.get(k, None) for k in keys] == ["1", None]
        assert len(written(source, "whole", even=True).inputFiles()) <= cores
    finally:
        spark.conf.unset(keys[0])


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {Path(f) for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data")}


def left_over(spark, before, most=0):
    """Bytes of shuffle files that came since and stay; they are deleted in the background."""
    for _ in range(100):
        found = sum(f.stat().st_size for f in shuffle_files(spark) - before if f.exists())
        if found <= most:
            break
        time.sleep(0.1)
    return found


def test_a_shuffle_goes_with_the_write_that_needed_it(spark, tmp_path):
    base_tables(spark, tmp_path)
    before = shuffle_files(spark)
    sales = Context(spark, str(tmp_path)).bronze_dvf
    assert left_over(spark, before) == 0 and sales.count() > 0
    before = shuffle_files(spark)
    table = PartitionedTable(spark, str(tmp_path / "t"), ["y"])
    rows = spark.range(20_000).selectExpr("md5(string(id)) AS v", "id % 3 AS y")
    table.replace(rows)
    table.append(rows)
    assert left_over(spark, before, 50_000) <= 50_000  # that of the count of rows
    assert table.read().count() == 40_000


def test_dropping_shuffles_is_over_after_the_write(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with shuffles_dropped(spark), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) is None
    try:  # a setting of the session's owner stays
        spark.conf.set(name, "false")
        with shuffles_dropped(spark):
            assert spark.conf.get(name) == "false"
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)


def test_rows_that_lie_together_are_written_where_they_lie(spark, tmp_path):
    df = spark.range(0, 40, 1, 2).selectExpr("id", "id % 2 AS y")
    for gathered, n in ((False, 2), (True, 4)):
        table = PartitionedTable(spark, str(tmp_path / f"t{n}"), ["y"])
        assert table.replace(df, gathered=gathered) == 40
        assert len(table.read().inputFiles()) == n and table.read().distinct().count() == 40


def test_lines_with_faults_are_stored_compressed_and_scratch_goes_with_the_load(spark, tmp_path):
    base_tables(spark, tmp_path)
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.glob("*"))
    c = Context(spark, str(tmp_path))
    rows = _bad_rows(c).collect()
    assert {r.motif for r in rows} > {"OK"} and sum(r.n for r in rows) == c.bronze_dvf.count()
    made = {p.name.rpartition("-")[0]: p for p in set(root.glob("*")) - before}
    assert "csv-load" not in made and made.keys() >= {"lines", "loaded", "rejected"}
    assert {p.suffix for p in made["lines"].glob("part-*")} == {".gz"}
