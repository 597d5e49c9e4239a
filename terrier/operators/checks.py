"""Data-quality checks. Each returns the failing rows; :func:`run_checks` counts them all."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str,
    where: Column | None = None,
) -> DataFrame:
    """Child rows whose non-NULL key has no partner, optionally among some rows only."""
    rows = child if where is None else child.where(where)
    keys = parent.select(F.col(parent_column).alias(column))
    return rows.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def positive_median(df: DataFrame, column: str) -> DataFrame:
    """Rows whose present value is not positive."""
    return df.where(F.col(column) <= 0)


def positive_price(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("VALEUR_FONCIERE") <= 0)


def coordinates_outside(
    df: DataFrame, latitude: tuple[float, float], longitude: tuple[float, float]
) -> DataFrame:
    """Located rows outside a box, bounds being inside."""
    outside = ~F.col("LATITUDE").between(*latitude) | ~F.col("LONGITUDE").between(*longitude)
    return df.where(F.col("LATITUDE").isNotNull() & outside)


# Checks that need more than one row to tell.
KEY_CHECKS = ("unique", "relationships")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple = ()
    to: str = ""
    where: str = ""


def _row_failure(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*check.values)
    if check.kind == "prix_median_positif":
        return c <= 0
    raise ValueError(f"not a row-level check: {check.kind}")


def watched(
    name: str, df: DataFrame, checks: Sequence[Check]
) -> tuple[DataFrame, Callable[[], dict[Check, int]]]:
    """``df`` with its row checks counted by whatever writes it, and the counts to ask for afterwards.

    Counted are the checks of model ``name`` that look at single rows; the write needs no second scan.
    """
    own = [c for c in dict.fromkeys(checks) if c.model == name and c.kind not in KEY_CHECKS]
    if not own:
        return df, dict
    seen = Observation(f"checks-{name}-{uuid.uuid4().hex}")
    counts = [F.count_if(_row_failure(c)).alias(f"c{i}") for i, c in enumerate(own)]

    def failures() -> dict[Check, int]:
        try:
            found = seen.get
        except Py4JJavaError:  # the planner knew the table to be empty and counted nothing
            found = {}
        return {c: found.get(f"c{i}", 0) for i, c in enumerate(own)}

    return df.observe(seen, *counts), failures


def _found(table: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """One pass over a table: failing rows per row check, rows per key for checks on keys."""
    cases = []
    for i, check in checks:
        if check.kind in KEY_CHECKS:
            key = F.col(check.column)
            wanted = key.isNotNull() & F.expr(check.where) if check.where else key.isNotNull()
        else:
            key, wanted = F.lit(None), _row_failure(check)
        cases.append(F.when(wanted, F.struct(F.lit(i).alias("check"), key.cast("string").alias("key"))))
    each = table.select(F.explode(F.array_compact(F.array(*cases))).alias("_c")).select("_c.*")
    return each.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))


def run_checks(
    table: Callable[[str], DataFrame], checks: Sequence[Check],
    counted: Callable[[str], dict[Check, int]] | None = None,
) -> DataFrame:
    """One row per check: model, column, kind and number of failures.

    ``counted(model)`` gives what was counted when the table was written (:func:`watched`). For the other
    checks every model is read once, and the parent of every relationship once more for its keys.
    """
    numbered = list(enumerate(checks))
    known: dict[int, int] = {}
    if counted is not None:
        of_model = {model: counted(model) for model in dict.fromkeys(c.model for c in checks)}
        known = {i: of_model[c.model][c] for i, c in numbered if c in of_model[c.model]}
    open_ = [(i, c) for i, c in numbered if i not in known]
    spark = SparkSession.active()
    if not open_:
        return _named(spark, numbered, known).select(*RESULT, F.col("known").alias("failures"))
    found = reduce(DataFrame.unionByName, (
        _found(table(model), [(i, c) for i, c in open_ if c.model == model])
        for model in dict.fromkeys(c.model for _, c in open_)
    ))
    related = [(i, c) for i, c in open_ if c.kind == "relationships"]
    if related:
        parents = reduce(DataFrame.unionByName, (
            table(c.to).select(F.lit(i).alias("check"), F.col(c.column).cast("string").alias("key"))
            for i, c in related
        ))
        held = parents.distinct().withColumn("held", F.lit(True))
        found = found.join(held, ["check", "key"], "left")
    else:
        found = found.withColumn("held", F.lit(None).cast("boolean"))
    unique_ones = [i for i, c in numbered if c.kind == "unique"]
    failing = F.when(F.col("check").isin(unique_ones), (F.col("n") > 1).cast("bigint")).when(
        F.col("held").isNull(), F.col("n"))
    totals = found.groupBy("check").agg(F.sum(failing).alias("failures"))
    return _named(spark, numbered, known).join(totals, "check", "left").select(
        *RESULT, F.coalesce("known", "failures", F.lit(0)).cast("bigint").alias("failures"))


RESULT = ("model", "column_name", "check_name")


def _named(spark: SparkSession, numbered: list[tuple[int, Check]], known: dict[int, int]) -> DataFrame:
    return spark.createDataFrame(
        [(i, c.model, c.column, c.kind, known.get(i)) for i, c in numbered],
        "check int, model string, column_name string, check_name string, known long")
