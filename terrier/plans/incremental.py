"""A star schema that is kept up to date by loads of whole years.

A full refresh parses and geocodes everything. Here a load brings the raw sales of some years, and does the
work of those years only:

* typed sales, their distinct addresses, fact and price cells are split by year, and the load replaces its
  years under one manifest each (:mod:`terrier.sources.manifest`); files of other years are not touched;
* the cascade sees the addresses that no earlier load geocoded, and those whose register rows changed:
  rows of the register that came or went, told by a hash, name the match keys whose outcome may differ,
  and addresses that ask for such a key are geocoded again;
* years whose sales hold an address with another outcome are rebuilt from their stored typed sales;
* dimensions come from the typed sales, indicators from the price cells; neither parses or geocodes.

The tables equal those of a full build over the sales loaded last for every year. What a later load
compares with, the addresses by year and the register, is committed last: a load that failed half-way is
mended by running it again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.functions import keys
from terrier.operators.dedup import distinct_blank_insensitive
from terrier.plans import dims, fact, geocode, kpi, silver
from terrier.plans.geocode import ADDRESS_COLUMNS
from terrier.plans.warehouse import SALE_COLUMNS
from terrier.session import scratch_scope, written
from terrier.sources.files import sale_year
from terrier.sources.manifest import PartitionedTable
from terrier.sources.seeds import ref_departements

YEAR = fact.YEAR_COLUMN
_ID, _PART, _HASH = "ADDRESS_ID", "PART", "ROW_HASH"
_NO_PART = "NONE"

_ADDRESS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (_ID, *ADDRESS_COLUMNS, YEAR)])


def _identified(addresses: DataFrame) -> DataFrame:
    return addresses.withColumn(_ID, keys.address_id(*ADDRESS_COLUMNS))


def _same_address(left: DataFrame, right: DataFrame) -> Column:
    """Equality of all components, NULL and blank told apart as match keys do; the identifier leads."""
    return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[c]) for c in ADDRESS_COLUMNS), left[_ID] == right[_ID])


def _part(code: Column) -> Column:
    """A column to split a table by: never missing or empty."""
    return F.coalesce(F.nullif(code, F.lit("")), F.lit(_NO_PART))


def _may_be_of(years: list[int]) -> Column:
    """Raw rows that are not plainly of another year: only these are parsed."""
    plain = F.col("DATE_MUTATION").rlike(r"^\d{2}/\d{2}/\d{4}$")
    return F.coalesce(~plain | sale_year().isin([f"{year:04d}" for year in years]), F.lit(True))


def _names(years: list[int]) -> list[str]:
    return [f"{YEAR}={year}" for year in years]


class Warehouse:
    """Tables below ``root``, changed by :meth:`load`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.sales_table = PartitionedTable(spark, f"{root}/sales", [YEAR])
        self.address_table = PartitionedTable(spark, f"{root}/addresses", [YEAR])
        self.geocoded_table = PartitionedTable(spark, f"{root}/geocoded", [_PART])
        self.register_table = PartitionedTable(spark, f"{root}/register", [_PART])
        self.fact_table = PartitionedTable(spark, f"{root}/fct_mutation", [YEAR])
        self.cells_table = PartitionedTable(spark, f"{root}/price_cells", [YEAR])
        self.tables = (self.sales_table, self.geocoded_table, self.fact_table, self.cells_table,
                       self.register_table, self.address_table)
        # Of the last load: addresses that the cascade saw, and years that were rebuilt.
        self.geocoded_last = 0
        self.years_last: list[int] = []

    # ------------------------------------------------------------ loading

    def load(self, bronze_sales: DataFrame, bronze_register: DataFrame | None, years: list[int]) -> None:
        """Replaces the sales of ``years`` by those of these years in ``bronze_sales``.

        ``bronze_register`` is the whole register, or None if it has not changed since the last load.
        """
        with scratch_scope(self.spark):
            dated = bronze_sales.where(_may_be_of(years))
            staged = fact.by_year(silver.stg_dvf_transactions(dated).select(*SALE_COLUMNS))
            self.sales_table.replace(staged.where(F.col(YEAR).isin(*years)), _names(years))

            register, changed = self._register(bronze_register)
            before = self.address_table.read(_ADDRESS_SCHEMA)
            loaded = written(self._addresses_by_year(years), "year-addresses")
            after = before.where(~F.col(YEAR).isin(*map(str, years))).unionByName(loaded)
            picked = written(self._picked(after), "picked")

            again = self._asking_for(changed)
            self._geocode(picked, again, register)
            stale = self._other_outcome(self._picked(before), picked, again)
            self.years_last = sorted({*years, *self._years_of(after, stale)})
            self._store_fact(self.years_last, after, picked)

            if bronze_register is not None:
                self.register_table.replace(register, sorted(self.register_table.names()))
            self.address_table.replace(loaded, _names(years))
        for table in self.tables:
            table.vacuum()

    def _years(self, years: list[int]) -> DataFrame:
        return self.sales_table.read().where(F.col(YEAR).isin(*years)).drop(YEAR)

    def _addresses_by_year(self, years: list[int]) -> DataFrame:
        """The addresses of each year, one of those that differ in blanks only."""
        sold = geocode.geocodable(self.sales_table.read().where(F.col(YEAR).isin(*years)))
        dated = geocode.normalised_address(sold, F.col(YEAR).cast("string").alias(YEAR))
        return _identified(distinct_blank_insensitive(dated, [*ADDRESS_COLUMNS, YEAR])).select(
            *_ADDRESS_SCHEMA.names)

    @staticmethod
    def _picked(by_year: DataFrame) -> DataFrame:
        """The addresses of all years: the choice among blanks is that of a full build."""
        return _identified(distinct_blank_insensitive(by_year, ADDRESS_COLUMNS))

    def _register(self, bronze: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """The register to use, and the match keys of rows that came or went since the last load."""
        if bronze is None:
            return self.register_table.read(), None
        columns = geocode.MATCHED_COLUMNS
        rows = silver.stg_ban_addresses_normalized(bronze).select(
            *columns, F.xxhash64(*columns).alias(_HASH), _part(F.substring("CODE_INSEE", 1, 2)).alias(_PART))
        new = written(rows, "register")
        if not self.register_table.names():
            return new, None
        # Rows that both registers hold equally often cancel out before any key is looked at.
        level_keys = [_HASH, *geocode.LEVEL_KEYS.values()]
        both = self.register_table.read().select(*level_keys, F.lit(-1).alias("sign")).unionByName(
            new.select(*level_keys, F.lit(1).alias("sign")))
        moved = both.groupBy(*level_keys).agg(F.sum("sign").alias("n")).where("n != 0")
        named = F.array(*(F.struct(F.lit(level).alias("level"), F.col(key).alias("key"))
                          for level, key in geocode.LEVEL_KEYS.items()))
        changed = moved.select(F.explode(named).alias("k")).select("k.*").where("key is not null").distinct()
        return new, written(changed, "changed-keys")

    def _asking_for(self, changed: DataFrame | None) -> DataFrame | None:
        """Geocoded addresses that ask for a changed key."""
        if changed is None or changed.isEmpty():
            return None
        known = self.geocoded_table.read().select(_ID, *ADDRESS_COLUMNS)
        asks = reduce(DataFrame.unionByName, (
            known.withColumns({"level": F.lit(level), "key": key})
            for level, key in geocode.sale_match_keys().items()))
        asking = asks.join(changed, ["level", "key"], "left_semi").select(_ID, *ADDRESS_COLUMNS).distinct()
        return written(asking, "asking")

    def _geocode(self, picked: DataFrame, again: DataFrame | None, register: DataFrame) -> None:
        todo = picked
        if self.geocoded_table.names():
            known = self.geocoded_table.read()
            todo = picked.join(known, _same_address(picked, known), "left_anti")
        if again is not None:
            todo = todo.unionByName(again)
        todo = written(todo.select(*ADDRESS_COLUMNS), "to-geocode")
        self.geocoded_last = todo.count()
        if not self.geocoded_last:
            return
        found = _identified(geocode.geocoded(todo, register.select(*geocode.MATCHED_COLUMNS)))
        found = found.withColumn(_PART, _part(F.col("CODE_DEPARTEMENT")))
        if again is None:
            self.geocoded_table.append(found)
            return
        # Départements with an address geocoded again are replaced, the others only grow.
        found = written(found, "geocoded")
        touched = [r[0] for r in again.select(_part(F.col("CODE_DEPARTEMENT"))).distinct().collect()]
        old = self.geocoded_table.read().where(F.col(_PART).isin(*touched))
        kept = old.join(again, _same_address(old, again), "left_anti")
        self.geocoded_table.replace(kept.unionByName(found.where(F.col(_PART).isin(*touched)), allowMissingColumns=False))
        self.geocoded_table.append(found.where(~F.col(_PART).isin(*touched)))

    @staticmethod
    def _other_outcome(before: DataFrame, picked: DataFrame, again: DataFrame | None) -> DataFrame:
        """Identifiers whose addresses were geocoded again or are now written with other blanks."""
        same = _same_address(picked, before)
        other = picked.join(before, same, "left_anti").select(_ID).join(before.select(_ID), _ID, "left_semi")
        return other if again is None else other.unionByName(again.select(_ID))

    @staticmethod
    def _years_of(by_year: DataFrame, ids: DataFrame) -> list[int]:
        """Years with a sale at one of these addresses; one row a year reaches the driver."""
        rows = by_year.join(ids, _ID, "left_semi").select(YEAR).distinct().collect()
        return [int(r[0]) for r in rows]

    def _store_fact(self, years: list[int], by_year: DataFrame, picked: DataFrame) -> None:
        held = by_year.where(F.col(YEAR).isin(*map(str, years))).select(_ID).distinct()
        places = self._placed(picked.join(held, _ID, "left_semi"))
        self.fact_table.replace(fact.by_year(fact.fct_mutation(self._years(years), places)), _names(years))
        stored = self.fct_mutation.where(F.col(YEAR).isin(*years))
        self.cells_table.replace(kpi.price_cells(stored), _names(years))

    def _placed(self, addresses: DataFrame) -> DataFrame:
        """Enriched addresses, by the outcome that is stored for them."""
        known = self.geocoded_table.read()
        found = addresses.join(known, _same_address(addresses, known))
        return geocode.enriched(found.select(*(addresses[c] for c in ADDRESS_COLUMNS), "payload"))

    # ------------------------------------------------------------ tables

    @property
    def sales(self) -> DataFrame:
        """Typed sales of all years."""
        return self.sales_table.read().drop(YEAR)

    @property
    def fct_mutation(self) -> DataFrame:
        return self.fact_table.read()

    @property
    def price_cells(self) -> DataFrame:
        return self.cells_table.read()

    @property
    def dim_address_enriched(self) -> DataFrame:
        return self._placed(self._picked(self.address_table.read()))

    @property
    def dim_commune(self) -> DataFrame:
        return dims.dim_commune(dims.dim_address(self.sales))

    @property
    def dim_code_postal(self) -> DataFrame:
        return dims.dim_code_postal(self.sales)

    def indicators(self) -> dict[str, DataFrame]:
        """The four indicators, from the price cells."""
        cells = self.price_cells
        communes, postcodes = written(self.dim_commune, "communes"), written(self.dim_code_postal, "postcodes")
        return {
            "gold_kpi_france": kpi.gold_kpi_france(cells),
            "gold_kpi_departement": kpi.gold_kpi_departement(cells, communes, ref_departements(self.spark)),
            "gold_kpi_commune": kpi.gold_kpi_commune(cells, communes),
            "gold_kpi_code_postal": kpi.gold_kpi_code_postal(cells, postcodes),
        }
