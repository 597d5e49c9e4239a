"""Registered queries: what runs on Spark, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.operators.checks import Check, watched
from terrier.plans.declared_checks import declared_checks
from terrier.plans.fact import YEAR_COLUMN
from terrier.plans.incremental import Warehouse
from terrier.plans.warehouse import YEARLY, Star, with_audit
from terrier.registry.oracle_tables import oracle
from terrier.session import scratch_path, shuffles_dropped, written
from terrier.sources.bronze import derived_register, derived_sales
from terrier.sources.files import sale_year

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Context:
    """Tables over one folder of input data, shared by the queries of a session.

    The raw sources and the gold tables are stored once, as a warehouse does, and ``gold`` gives
    those tables. ``lazy`` gives every table as a new plan over the raw sources.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.row_failures: dict[str, Callable[[], dict[Check, int]]] = {}

    @cached_property
    def bronze_dvf(self) -> DataFrame:
        with shuffles_dropped(self.spark):
            return written(derived_sales(self.spark, self.folder), "bronze_dvf", even=True)

    @cached_property
    def bronze_ban(self) -> DataFrame:
        # Rebalanced: a raw table at rest should not inherit the row groups of the test files.
        return written(derived_register(self.spark, self.folder).hint("rebalance"), "bronze_ban", even=True)

    @property
    def lazy(self) -> Star:
        return Star(self.bronze_dvf, self.bronze_ban)

    @cached_property
    def gold(self) -> Star:
        return Star(self.bronze_dvf, self.bronze_ban, self._checked)

    @cached_property
    def gold_scale0(self) -> Star:
        """The same star with whole amounts and coordinates."""
        return Star(self.bronze_dvf, self.bronze_ban, self._stored, scale0=True)

    def _checked(self, name: str, df: DataFrame) -> DataFrame:
        """Stores a table; its write counts the row checks that it fails."""
        return self._stored(name, df, watch=True)

    def _stored(self, name: str, df: DataFrame, watch: bool = False) -> DataFrame:
        rows = with_audit(name, df)
        if watch:
            rows, self.row_failures[name] = watched(name, rows, declared_checks())
        if name not in YEARLY:
            return written(rows, name, even=True)
        return written(YEARLY[name](rows), name, split_by=YEAR_COLUMN, even=True)

    def counted(self, name: str) -> dict[Check, int]:
        """Row checks counted when a gold table was written; silver tables are never written."""
        if name.startswith("stg_"):
            return {}
        self.gold.table(name)
        return self.row_failures[name]()

    @cached_property
    def loaded_by_year(self) -> Warehouse:
        """Tables of three loads: older years, half of the last year, then the whole last year."""
        sales = self.bronze_dvf
        years = [int(r[0]) for r in sales.select(sale_year()).distinct().collect()]
        last = max(years)
        half = sales.where(F.substring("DATE_MUTATION", 4, 2) <= "06")
        warehouse = Warehouse(self.spark, scratch_path(self.spark, "warehouse"))
        warehouse.load(sales, self.bronze_ban, [y for y in years if y < last])
        warehouse.load(half, None, [last])
        warehouse.load(sales, self.bronze_ban, [last])
        return warehouse

    @property
    def indicators(self) -> Star:
        """Indicators computed anew, over the stored price cells and dimensions."""
        star = Star(self.bronze_dvf, self.bronze_ban)
        for name in ("dim_address_enriched", "dim_code_postal", "dim_commune", "fct_mutation",
                     "price_cells"):
            setattr(star, name, self.gold.table(name))
        return star

    def checked_table(self, name: str) -> DataFrame:
        """A table with its load time, silver ones as plans and gold ones as stored."""
        if name.startswith("stg_"):
            return with_audit(name, self.lazy.table(name))
        return self.gold.table(name)


_CONTEXTS: dict[tuple[str, str], Context] = {}


def context(spark: SparkSession, folder: str) -> Context:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Context(spark, folder)
    return _CONTEXTS[key]


def register(
    key: str, run: Callable[[Context], DataFrame], sql: str | None = None, scale0: bool = False
) -> None:
    if key in QUERIES:
        raise ValueError(f"registered twice: {key}")
    QUERIES[key] = lambda spark, folder: run(context(spark, folder))
    if sql is not None:
        ORACLES[key] = oracle(sql, scale0)


def register_like(key: str, run: Callable[[Context], DataFrame], other: str) -> None:
    """A further way to the rows of a registered query."""
    register(key, run)
    ORACLES[key] = ORACLES[other]


def outcomes(df: DataFrame, **columns: Column) -> DataFrame:
    """Every distinct outcome of some column expressions, with its number of rows."""
    return df.groupBy(*(c.alias(n) for n, c in columns.items())).agg(
        F.count(F.lit(1)).alias("n")
    )


def outcomes_sql(table: str, where: str = "", **columns: str) -> str:
    selected = ", ".join(f"{c} AS {n}" for n, c in columns.items())
    condition = f" WHERE {where}" if where else ""
    return f"SELECT {selected}, count(*) AS n FROM {table}{condition} GROUP BY ALL"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order in the last bits: compare them to six digits.

    The offset keeps exact halves, which those bits would push either way, on the upper side.
    """
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-9), 6) for c in columns})


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
