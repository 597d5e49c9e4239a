"""Price indicators per zone and year, all from one stored table of price counts.

``price_cells`` reduces the fact to one row per year, commune, postcode, INSEE code, premises type and
exact price, with the number of sales and the sums of their positions. Cells of a year can be replaced or added
up, and every indicator is exact over them, so the fact is read once for the four of them, and a load of one
year counts that year only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.keys import premises_is
from terrier.functions.numbers import price_per_m2
from terrier.operators.quantiles import Quantile, Summary, summarise

# Premises types with own indicators; sales needed for a reliable indicator.
APARTMENT, HOUSE = "APPARTEMENT", "MAISON"
SUFFICIENT_SALES = 5


def eligible(fact: DataFrame) -> DataFrame:
    """Sales with a price and a positive surface, with their year and price per square metre."""
    return fact.where(
        F.col("VALEUR_FONCIERE").isNotNull() & (F.col("SURFACE_REELLE_BATI") > 0)
    ).withColumns(
        {
            "ANNEE": F.year("DATE_MUTATION"),
            "PRIX_M2": price_per_m2("VALEUR_FONCIERE", "SURFACE_REELLE_BATI"),
        }
    )


CELL_KEYS = ["ANNEE", "COMMUNE_ID", "CODE_POSTAL_ID", "CODE_INSEE", "TYPE_LOCAL_ID", "PRIX_M2"]
_POSITION = ("LATITUDE", "LONGITUDE")


def price_cells(fact: DataFrame) -> DataFrame:
    """Number of eligible sales and sums of their positions per zone keys, premises type and price."""
    sums = [F.sum(c).alias(f"{c}_SUM") for c in _POSITION]
    counts = [F.count(c).alias(f"{c}_N") for c in _POSITION]
    return eligible(fact).groupBy(*CELL_KEYS).agg(F.count(F.lit(1)).alias("NB_VENTES"), *sums, *counts)


def _spec(centroid: bool = False, counts_by_type: bool = False) -> Summary:
    counts: dict[str, Column | None] = {"NB_VENTES": None}
    if counts_by_type:
        counts["NB_VENTES_APPARTEMENT"] = premises_is(APARTMENT)
        counts["NB_VENTES_MAISON"] = premises_is(HOUSE)
    means = {f"{c}_CENTROID": (F.col(f"{c}_SUM"), F.col(f"{c}_N")) for c in _POSITION} if centroid else {}
    quantiles = {
        "PRIX_MEDIAN_M2": Quantile(),
        "PRIX_MEDIAN_APPARTEMENT": Quantile(when=premises_is(APARTMENT)),
        "PRIX_MEDIAN_MAISON": Quantile(when=premises_is(HOUSE)),
    }
    return Summary(F.col("PRIX_M2"), quantiles, counts, means, weight=F.col("NB_VENTES"))


def _zero_centroid_and_flag(kpis: DataFrame) -> DataFrame:
    centroid = {
        c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("LATITUDE_CENTROID", "LONGITUDE_CENTROID")
    }
    return kpis.withColumns(
        {**centroid, "HAS_SUFFICIENT_DATA": F.col("NB_VENTES") >= SUFFICIENT_SALES}
    )


def gold_kpi_france(cells: DataFrame) -> DataFrame:
    return summarise(cells, ["ANNEE"], _spec(counts_by_type=True)).select(
        "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES", "PRIX_MEDIAN_APPARTEMENT",
        "NB_VENTES_APPARTEMENT", "PRIX_MEDIAN_MAISON", "NB_VENTES_MAISON",
    )


def gold_kpi_departement(
    cells: DataFrame, communes: DataFrame, departements: DataFrame
) -> DataFrame:
    """Per département; name and centroid fall back to the reference list."""
    known = communes.where(F.col("CODE_DEPARTEMENT").isNotNull()).select("COMMUNE_ID", "CODE_DEPARTEMENT")
    spec = _spec(centroid=True, counts_by_type=True)
    kpis = summarise(cells.join(known, "COMMUNE_ID"), ["CODE_DEPARTEMENT", "ANNEE"], spec)
    joined = kpis.join(departements, "CODE_DEPARTEMENT", "left")
    return joined.select(
        "CODE_DEPARTEMENT",
        F.coalesce("NOM_DEPARTEMENT", "CODE_DEPARTEMENT").alias("NOM_DEPARTEMENT"),
        "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES", "PRIX_MEDIAN_APPARTEMENT",
        "NB_VENTES_APPARTEMENT", "PRIX_MEDIAN_MAISON", "NB_VENTES_MAISON",
        F.coalesce("LATITUDE_CENTROID", "LATITUDE").alias("LATITUDE_CENTROID"),
        F.coalesce("LONGITUDE_CENTROID", "LONGITUDE").alias("LONGITUDE_CENTROID"),
    )


def gold_kpi_commune(cells: DataFrame, communes: DataFrame) -> DataFrame:
    """Per INSEE code and commune.

    The sale carries the INSEE code of its address, and a commune key stands for one name: both are
    grouped on as they are, and the names joined to the finished groups.
    """
    coded = cells.where(F.col("CODE_INSEE").isNotNull())
    kpis = summarise(coded, ["CODE_INSEE", "COMMUNE_ID", "ANNEE"], _spec(centroid=True))
    named = kpis.join(communes, "COMMUNE_ID", "left")
    return _zero_centroid_and_flag(named).select(
        F.col("CODE_INSEE").alias("CODE_COMMUNE"), F.col("COMMUNE").alias("NOM_COMMUNE"),
        "CODE_DEPARTEMENT", "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES", "PRIX_MEDIAN_APPARTEMENT",
        "PRIX_MEDIAN_MAISON", "LATITUDE_CENTROID", "LONGITUDE_CENTROID", "HAS_SUFFICIENT_DATA",
    )


def gold_kpi_code_postal(cells: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Per postcode and INSEE code, sales without INSEE code forming a group of their own.

    A postcode may lie in several départements, each with a key of its own.
    """
    known = postcodes.where(F.col("CODE_POSTAL").isNotNull()).select("CODE_POSTAL_ID", "CODE_POSTAL")
    by = ["CODE_POSTAL", "CODE_INSEE", "ANNEE"]
    kpis = summarise(cells.join(known, "CODE_POSTAL_ID"), by, _spec(centroid=True))
    return _zero_centroid_and_flag(kpis).select(
        "CODE_POSTAL", F.col("CODE_INSEE").alias("CODE_COMMUNE"), "ANNEE", "PRIX_MEDIAN_M2",
        "NB_VENTES", "PRIX_MEDIAN_APPARTEMENT", "PRIX_MEDIAN_MAISON", "LATITUDE_CENTROID",
        "LONGITUDE_CENTROID", "HAS_SUFFICIENT_DATA",
    )
