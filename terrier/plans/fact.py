"""Sales fact table.

Two forms with equal results when all dimensions come from the same staged sales (a full refresh):

* :func:`fct_mutation` looks up only the geocoded address. The other foreign keys are functions of
  columns the sale line already has, so computing them saves four fact-sized joins.
* :func:`fct_mutation_joined` looks every key up, for dimensions from another load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions import keys, scoring, text
from terrier.functions.numbers import period, try_parse_count
from terrier.operators.lookup import equal_as_blank
from terrier.plans.dims import PARCEL_COLUMNS
from terrier.plans.geocode import ADDRESS_COLUMNS
from terrier.plans.silver import KEPT_NATURES

GEOCODED_COLUMNS = [
    "ADDRESS_ID", "BAN_ID", "CODE_INSEE", "LONGITUDE", "LATITUDE", "MATCH_LEVEL", "MATCH_SCORE",
]
MEASURES = [
    "DATE_MUTATION", "NATURE_MUTATION", "VALEUR_FONCIERE", "SURFACE_REELLE_BATI",
    "NOMBRE_PIECES_PRINCIPALES", "SURFACE_TERRAIN",
]
FACT_COLUMNS = [
    "ADDRESS_ID", "COMMUNE_ID", "PARCELLE_ID", "TYPE_LOCAL_ID", "CODE_POSTAL_ID", "BAN_ID",
    "CODE_INSEE", "LONGITUDE", "LATITUDE", "GEOCODING_MATCH_LEVEL", "GEOCODING_MATCH_SCORE",
    "ADDRESS_MATCH_STRATEGY", *MEASURES,
]


# Column by which the stored fact is split.
YEAR_COLUMN = "ANNEE"


def by_year(sales: DataFrame) -> DataFrame:
    """The fact with the year it is stored under."""
    return sales.withColumn(YEAR_COLUMN, F.year("DATE_MUTATION"))


def sold_between(sales: DataFrame, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Sales from ``start`` on and before ``end``.

    A stored fact is split by year: naming the years as well leaves the other folders unread.
    """
    wanted = F.col("DATE_MUTATION") >= F.lit(start)
    if end is not None:
        wanted &= F.col("DATE_MUTATION") < F.lit(end)
    if YEAR_COLUMN in sales.columns:
        wanted &= F.col(YEAR_COLUMN) >= start.year
        if end is not None:
            wanted &= F.col(YEAR_COLUMN) <= (end - dt.timedelta(days=1)).year
    return sales.where(wanted)


def sold_in(sales: DataFrame, year: int, quarter: int | None = None) -> DataFrame:
    return sold_between(sales, *period(year, quarter))


def clean_sales(staged: DataFrame) -> DataFrame:
    """Sale lines with normalised key columns and typed measures."""
    return staged.where(F.col("NATURE_MUTATION").isin(*KEPT_NATURES)).select(
        text.norm_upper("NO_VOIE").alias("NO_VOIE"),
        text.norm_upper("TYPE_DE_VOIE").alias("TYPE_DE_VOIE"),
        text.norm_text("VOIE").alias("VOIE"),
        text.norm_code("CODE_POSTAL").alias("CODE_POSTAL"),
        text.norm_text("COMMUNE").alias("COMMUNE"),
        text.norm_code("CODE_DEPARTEMENT").alias("CODE_DEPARTEMENT"),
        text.norm_upper("PREFIXE_DE_SECTION").alias("PREFIXE_DE_SECTION"),
        text.norm_upper("SECTION").alias("SECTION"),
        text.norm_code("NO_PLAN").alias("NO_PLAN"),
        text.norm_optional("NO_VOLUME").alias("NO_VOLUME"),
        text.premises_type("TYPE_LOCAL").alias("TYPE_LOCAL"),
        *(
            try_parse_count(c).alias(c) if c == "NOMBRE_PIECES_PRINCIPALES" else F.col(c)
            for c in MEASURES
        ),
    )


def computed_commune_id() -> Column:
    """Key of the commune, NULL where the commune dimension holds no such name.

    The dimension trims the collapsed name once more, so a name that still starts or ends with a
    blank has no partner there.
    """
    held = (text.norm_upper("COMMUNE") == F.col("COMMUNE")) & F.col("CODE_DEPARTEMENT").isNotNull()
    return F.when(held, keys.commune_id("COMMUNE", "CODE_DEPARTEMENT"))


def computed_parcel_id() -> Column:
    """Key of the parcel; prefix, section and plan must be present, the volume may be missing."""
    complete = F.col("PREFIXE_DE_SECTION").isNotNull() & F.col("SECTION").isNotNull()
    return F.when(complete & F.col("NO_PLAN").isNotNull(), keys.parcel_id(*PARCEL_COLUMNS))


def computed_postcode_id() -> Column:
    present = F.col("CODE_POSTAL").isNotNull() & F.col("CODE_DEPARTEMENT").isNotNull()
    return F.when(present, keys.postcode_id("CODE_POSTAL", "CODE_DEPARTEMENT"))


def sale_rows(clean: DataFrame) -> DataFrame:
    """Sale lines as narrow as the address join allows: components, two keys and measures."""
    return clean.select(
        *ADDRESS_COLUMNS,
        computed_parcel_id().alias("PARCELLE_ID"),
        keys.premises_id("TYPE_LOCAL").alias("TYPE_LOCAL_ID"),
        *MEASURES,
    )


def keyed_places(enriched: DataFrame) -> DataFrame:
    """Geocoded addresses with the keys that follow from their components.

    Hashing once per address is cheaper than once per sale, and keeps the keys out of the shuffle
    of the sales.
    """
    return enriched.select(
        *ADDRESS_COLUMNS, *GEOCODED_COLUMNS,
        computed_commune_id().alias("COMMUNE_ID"), computed_postcode_id().alias("CODE_POSTAL_ID"),
    )


def _address_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(F.coalesce(df[c], F.lit("")) for c in ADDRESS_COLUMNS))


def join_address(
    sales: DataFrame, places: DataFrame, columns: list[str] = GEOCODED_COLUMNS
) -> DataFrame:
    """Left join on six components, blank-insensitive for number, street type and street.

    The hash leads the join key: a merge join then sorts on one long instead of six strings of few
    distinct values. Equality of the components still decides.
    """
    right = places.select(*ADDRESS_COLUMNS, *columns)
    right = right.withColumn("_h", _address_hash(right)).alias("a")
    left = sales.withColumn("_h", _address_hash(sales)).alias("s")
    on = F.col("s._h") == F.col("a._h")
    for c in ADDRESS_COLUMNS[:3]:
        on &= equal_as_blank(F.col(f"s.{c}"), F.col(f"a.{c}"))
    for c in ADDRESS_COLUMNS[3:]:
        on &= F.col(f"s.{c}") == F.col(f"a.{c}")
    kept = [F.col(f"s.{c}") for c in sales.columns]
    return left.join(right, on, "left").select(*kept, *(f"a.{c}" for c in columns))


def join_commune(sales: DataFrame, communes: DataFrame) -> DataFrame:
    key = ["COMMUNE", "CODE_DEPARTEMENT"]
    return sales.join(communes.select(*key, "COMMUNE_ID"), key, "left")


def join_type_local(sales: DataFrame, types: DataFrame) -> DataFrame:
    named = types.select(text.premises_type("TYPE_LOCAL").alias("TYPE_LOCAL"), "TYPE_LOCAL_ID")
    return sales.join(named, "TYPE_LOCAL", "left")


def join_parcelle(sales: DataFrame, parcels: DataFrame) -> DataFrame:
    """Plain equality on prefix, section and plan; the missing volume of a parcel is ``''``."""
    right = parcels.select(
        *PARCEL_COLUMNS[:3], text.blank_if_null("NO_VOLUME").alias("NO_VOLUME"), "PARCELLE_ID"
    )
    return sales.join(right, PARCEL_COLUMNS, "left")


def join_code_postal(sales: DataFrame, postcodes: DataFrame) -> DataFrame:
    key = ["CODE_POSTAL", "CODE_DEPARTEMENT"]
    return sales.join(postcodes.select(*key, "CODE_POSTAL_ID"), key, "left")


def _fact_columns(linked: DataFrame) -> DataFrame:
    strategy = scoring.link_strategy(F.col("ADDRESS_ID"), F.col("COMMUNE_ID"))
    fallback = keys.fallback_address_id("COMMUNE", "CODE_DEPARTEMENT")
    computed = {
        "ADDRESS_ID": F.coalesce("ADDRESS_ID", fallback),
        "GEOCODING_MATCH_LEVEL": F.col("MATCH_LEVEL"),
        "GEOCODING_MATCH_SCORE": F.col("MATCH_SCORE"),
        "ADDRESS_MATCH_STRATEGY": strategy,
    }
    return linked.select(*(computed.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS))


def fct_mutation(staged: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row per staged sale line; dimensions from the same staged sales."""
    place_keys = {"COMMUNE_ID": computed_commune_id(), "CODE_POSTAL_ID": computed_postcode_id()}
    linked = join_address(
        sale_rows(clean_sales(staged)), keyed_places(enriched), [*GEOCODED_COLUMNS, *place_keys]
    )
    return _fact_columns(linked.withColumns({k: F.coalesce(k, c) for k, c in place_keys.items()}))


def fct_mutation_joined(
    staged: DataFrame,
    enriched: DataFrame,
    communes: DataFrame,
    parcels: DataFrame,
    types: DataFrame,
    postcodes: DataFrame,
) -> DataFrame:
    """One row per staged sale line; all keys looked up in the given dimensions."""
    linked = join_address(clean_sales(staged), enriched)
    linked = join_type_local(join_commune(linked, communes), types)
    linked = join_code_postal(join_parcelle(linked, parcels), postcodes)
    return _fact_columns(linked)
