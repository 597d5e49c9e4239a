"""The star schema as a graph of tables, lazy or stored."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.operators.checks import Check, watched
from terrier.plans import dims, fact, geocode, kpi, silver
from terrier.session import written
from terrier.sources.files import overwrite_table, table_path
from terrier.sources.seeds import ref_departements

SALE_COLUMNS = (*geocode.ADDRESS_COLUMNS, *dims.PARCEL_COLUMNS, "TYPE_LOCAL", *fact.MEASURES)

# Tables that may be built at the same time, in order of dependency.
BUILD_STEPS = (
    ("dim_address", "dim_address_enriched", "dim_code_postal", "dim_parcelle", "dim_type_local"),
    ("dim_commune", "fct_mutation"),
    ("price_cells",),
    ("gold_kpi_france", "gold_kpi_departement", "gold_kpi_commune", "gold_kpi_code_postal"),
)
GOLD_TABLES = (
    "dim_address", "dim_address_enriched", "dim_code_postal", "dim_commune", "dim_parcelle",
    "dim_type_local", "fct_mutation", "gold_kpi_france", "gold_kpi_departement",
    "gold_kpi_commune", "gold_kpi_code_postal",
)
# Tables stored by year, and how they come by their year.
YEARLY = {"fct_mutation": fact.by_year, "price_cells": lambda cells: cells}
AUDIT_COLUMNS = {
    "stg_ban_addresses": ("CREATED_AT",),
    "stg_ban_addresses_normalized": ("CREATED_AT",),
    "dim_address": ("CREATED_AT",),
    "dim_address_enriched": ("CREATED_AT", "UPDATED_AT"),
    "dim_code_postal": ("CREATED_AT",),
    "dim_commune": ("CREATED_AT",),
    "dim_parcelle": ("CREATED_AT",),
    "dim_type_local": ("CREATED_AT",),
    "fct_mutation": ("CREATED_AT",),
}


def with_audit(name: str, df: DataFrame) -> DataFrame:
    """Add the load time columns of a table."""
    return df.select("*", *(F.current_timestamp().alias(c) for c in AUDIT_COLUMNS.get(name, ())))


def parquet_store(
    root: str, schema: str = "gold", schemas: dict[str, str] | None = None,
    checks: Sequence[Check] = (), failures: dict[Check, int] | None = None,
) -> Callable[[str, DataFrame], DataFrame]:
    """Full refresh of every gold table below ``root``; the fact and its price cells are split by year.

    A table goes to ``schema``, or to the schema of its own that ``schemas`` names. Row checks among
    ``checks`` are counted by the write, and their numbers put into ``failures``.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        path = table_path(root, name, schema, (schemas or {}).get(name))
        rows, counted = watched(name, with_audit(name, df), checks)
        if name in YEARLY:
            stored = overwrite_table(YEARLY[name](rows), path, [fact.YEAR_COLUMN])
        else:
            stored = overwrite_table(rows, path)
        if failures is not None:
            failures.update(counted())
        return stored

    return store


class Star:
    """Tables of the star schema over two raw sources, each built on first use.

    ``store(name, df)`` keeps a gold table and returns what later tables read; without it every
    table stays a lazy plan over the raw sources. Silver tables are never stored, but a star that
    stores its gold tables parses the raw sales once: six tables read them.
    """

    def __init__(
        self,
        bronze_dvf: DataFrame,
        bronze_ban: DataFrame,
        store: Callable[[str, DataFrame], DataFrame] | None = None,
        scale0: bool = False,
    ):
        self.bronze_dvf = bronze_dvf
        self.bronze_ban = bronze_ban
        self.scale0 = scale0
        self._stores = store is not None
        self._store = store or (lambda name, df: df)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _gold(self, name: str, df: DataFrame) -> DataFrame:
        return self._store(name, df)

    @cached_property
    def ref_departements(self) -> DataFrame:
        return ref_departements(self.bronze_dvf.sparkSession)

    @cached_property
    def stg_dvf_transactions(self) -> DataFrame:
        return silver.stg_dvf_transactions(self.bronze_dvf, self.scale0)

    @cached_property
    def sales(self) -> DataFrame:
        """The staged sales that gold tables are built from, with the columns these need."""
        staged = self.stg_dvf_transactions.select(*SALE_COLUMNS)
        return written(staged, "sales", even=True) if self._stores else staged

    @cached_property
    def stg_ban_addresses(self) -> DataFrame:
        return silver.stg_ban_addresses(self.bronze_ban, self.scale0)

    @cached_property
    def stg_ban_addresses_normalized(self) -> DataFrame:
        return silver.stg_ban_addresses_normalized(self.bronze_ban, self.scale0)

    @cached_property
    def dim_address(self) -> DataFrame:
        return self._gold("dim_address", dims.dim_address(self.sales))

    @cached_property
    def dim_address_enriched(self) -> DataFrame:
        enriched = geocode.dim_address_enriched(
            self.sales, self.stg_ban_addresses_normalized
        )
        return self._gold("dim_address_enriched", enriched)

    @cached_property
    def dim_code_postal(self) -> DataFrame:
        return self._gold("dim_code_postal", dims.dim_code_postal(self.sales))

    @cached_property
    def dim_commune(self) -> DataFrame:
        return self._gold("dim_commune", dims.dim_commune(self.dim_address))

    @cached_property
    def dim_parcelle(self) -> DataFrame:
        return self._gold("dim_parcelle", dims.dim_parcelle(self.sales))

    @cached_property
    def dim_type_local(self) -> DataFrame:
        return self._gold("dim_type_local", dims.dim_type_local(self.sales))

    @cached_property
    def fct_mutation(self) -> DataFrame:
        sales = fact.fct_mutation(self.sales, self.dim_address_enriched)
        return self._gold("fct_mutation", sales)

    @cached_property
    def price_cells(self) -> DataFrame:
        return self._gold("price_cells", kpi.price_cells(self.fct_mutation))

    @cached_property
    def gold_kpi_france(self) -> DataFrame:
        return self._gold("gold_kpi_france", kpi.gold_kpi_france(self.price_cells))

    @cached_property
    def gold_kpi_departement(self) -> DataFrame:
        kpis = kpi.gold_kpi_departement(
            self.price_cells, self.dim_commune, self.ref_departements
        )
        return self._gold("gold_kpi_departement", kpis)

    @cached_property
    def gold_kpi_commune(self) -> DataFrame:
        return self._gold(
            "gold_kpi_commune", kpi.gold_kpi_commune(self.price_cells, self.dim_commune)
        )

    @cached_property
    def gold_kpi_code_postal(self) -> DataFrame:
        return self._gold(
            "gold_kpi_code_postal",
            kpi.gold_kpi_code_postal(self.price_cells, self.dim_code_postal),
        )


def build_all(star: Star, threads: int = 4) -> dict[str, DataFrame]:
    """Build every gold table in dependency order, independent ones at the same time."""
    for shared in ("sales", "stg_ban_addresses_normalized", "ref_departements"):
        star.table(shared)
    with ThreadPoolExecutor(threads) as pool:
        for step in BUILD_STEPS:
            list(pool.map(star.table, step))
    return {name: star.table(name) for name in GOLD_TABLES}
