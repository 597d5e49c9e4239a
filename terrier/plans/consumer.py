"""Queries that readers ask of the star schema.

Here dimensions are joined to finished groups or to the few rows a ranking keeps, not to all sales.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.keys import premises_is
from terrier.functions.numbers import price_per_m2
from terrier.functions.scoring import level_rank
from terrier.operators.quantiles import Quantile, Summary, summarise
from terrier.plans.fact import sold_between, sold_in
from terrier.plans.kpi import APARTMENT
from terrier.plans.reports import share_of_total

# Match levels that locate a sale precisely.
PRECISE_LEVELS = ("EXACT", "SANS_TYPE")


def _month() -> Column:
    return F.trunc("DATE_MUTATION", "month")


def _m2() -> Column:
    return price_per_m2("VALEUR_FONCIERE", "SURFACE_REELLE_BATI")


def _priced(fact: DataFrame) -> DataFrame:
    return fact.where((F.col("SURFACE_REELLE_BATI") > 0) & (F.col("VALEUR_FONCIERE") > 0))


def _commune_names(communes: DataFrame) -> DataFrame:
    return communes.select("COMMUNE_ID", "COMMUNE", "CODE_DEPARTEMENT")


def median_by_commune(fact: DataFrame, communes: DataFrame, year: int, top: int = 20) -> DataFrame:
    """The ``top`` communes of highest median price in one year."""
    sold = sold_in(fact, year).where(F.col("COMMUNE_ID").isNotNull())
    spec = Summary(
        F.col("VALEUR_FONCIERE"), {"prix_median": Quantile()}, counts={"nb_transactions": None}
    )
    groups = summarise(sold, ["COMMUNE_ID"], spec)
    return (
        groups.join(_commune_names(communes), "COMMUNE_ID")
        .select("COMMUNE", "CODE_DEPARTEMENT", "prix_median", "nb_transactions")
        .orderBy(F.desc("prix_median"), "COMMUNE", "CODE_DEPARTEMENT")
        .limit(top)
    )


def mean_price_by_type(fact: DataFrame, types: DataFrame) -> DataFrame:
    groups = _priced(fact).groupBy("TYPE_LOCAL_ID").agg(
        F.avg(_m2()).alias("prix_m2_moyen"), F.count(F.lit(1)).alias("nb_transactions")
    )
    return (
        groups.join(types, "TYPE_LOCAL_ID")
        .select("TYPE_LOCAL", "prix_m2_moyen", "nb_transactions")
        .orderBy(F.desc("prix_m2_moyen"))
    )


def monthly_trend(fact: DataFrame, today: dt.date, years: int = 2) -> DataFrame:
    """Sales, median price and volume per month over the years before ``today``."""
    last = calendar.monthrange(today.year - years, today.month)[1]  # the 29th of February may be missing
    recent = sold_between(fact, dt.date(today.year - years, today.month, min(today.day, last)))
    spec = Summary(
        F.col("VALEUR_FONCIERE"),
        {"prix_median": Quantile()},
        counts={"nb_transactions": None},
        sums={"volume_total": F.col("VALEUR_FONCIERE")},
    )
    monthly = summarise(recent.withColumn("mois", _month()), ["mois"], spec)
    return monthly.select("mois", "nb_transactions", "prix_median", "volume_total").orderBy("mois")


def monthly_apartment_price(fact: DataFrame) -> DataFrame:
    sold = _priced(fact).where(premises_is(APARTMENT))
    return sold.groupBy(_month().alias("mois")).agg(F.avg(_m2()).alias("prix_m2_moyen")).orderBy(
        "mois"
    )


def precisely_located(
    fact: DataFrame, enriched: DataFrame, since: dt.date, premises: str = APARTMENT, top: int = 100
) -> DataFrame:
    """The ``top`` most expensive sales of one premises type at a precisely known place.

    A sale with a match level has its address in the dimension, so ranking before the join drops
    nothing, and the join meets only the ranked sales.
    """
    order = [F.desc("VALEUR_FONCIERE"), F.asc("ADDRESS_ID"), F.asc("SURFACE_REELLE_BATI")]
    ranked = (
        sold_between(fact, since)
        .where(F.col("GEOCODING_MATCH_LEVEL").isin(*PRECISE_LEVELS) & premises_is(premises))
        .select("ADDRESS_ID", "VALEUR_FONCIERE", "SURFACE_REELLE_BATI")
        .orderBy(*order)
        .limit(top)
    )
    places = enriched.select("ADDRESS_ID", "ADDRESS_FULL", "LONGITUDE", "LATITUDE")
    return (
        places.join(F.broadcast(ranked), "ADDRESS_ID")  # at most ``top`` rows
        .orderBy(*order)
        .select(
            "ADDRESS_FULL", "LONGITUDE", "LATITUDE", "VALEUR_FONCIERE", "SURFACE_REELLE_BATI",
            F.lit(premises).alias("TYPE_LOCAL"),
        )
    )


def geocoding_quality(fact: DataFrame) -> DataFrame:
    """Sales per match level, best level first."""
    groups = fact.groupBy("GEOCODING_MATCH_LEVEL").agg(F.count(F.lit(1)).alias("nb_transactions"))
    return groups.select("*", share_of_total("nb_transactions").alias("pourcentage")).orderBy(
        level_rank(F.col("GEOCODING_MATCH_LEVEL")).asc_nulls_last()
    )


def most_active_communes(fact: DataFrame, communes: DataFrame, top: int = 10) -> DataFrame:
    groups = fact.where(F.col("COMMUNE_ID").isNotNull()).groupBy("COMMUNE_ID").agg(
        F.count(F.lit(1)).alias("nb_transactions"), F.sum("VALEUR_FONCIERE").alias("volume_total")
    )
    return (
        groups.join(_commune_names(communes), "COMMUNE_ID")
        .select("COMMUNE", "CODE_DEPARTEMENT", "nb_transactions", "volume_total")
        .orderBy(F.desc("nb_transactions"), "COMMUNE", "CODE_DEPARTEMENT")
        .limit(top)
    )


def sales_by_star(
    sales: DataFrame, communes: DataFrame, types: DataFrame, postcodes: DataFrame
) -> DataFrame:
    """Sales per commune, premises type and postcode; unknown keys are kept.

    Sales are counted per key combination first: the dimensions meet the groups only.
    """
    by = ["COMMUNE_ID", "TYPE_LOCAL_ID", "CODE_POSTAL_ID"]
    groups = sales.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return (
        groups.join(communes.select("COMMUNE_ID", "COMMUNE"), "COMMUNE_ID", "left")
        .join(types.select("TYPE_LOCAL_ID", "TYPE_LOCAL"), "TYPE_LOCAL_ID", "left")
        .join(postcodes.select("CODE_POSTAL_ID", "CODE_POSTAL"), "CODE_POSTAL_ID", "left")
        .select("COMMUNE", "TYPE_LOCAL", "CODE_POSTAL", "n")
    )


def volume_by_commune_and_type(fact: DataFrame, communes: DataFrame, types: DataFrame) -> DataFrame:
    """Volume of sales of known commune and premises type."""
    groups = fact.groupBy("COMMUNE_ID", "TYPE_LOCAL_ID").agg(F.sum("VALEUR_FONCIERE").alias("volume"))
    return (
        groups.join(_commune_names(communes), "COMMUNE_ID")
        .join(types.select("TYPE_LOCAL_ID", "TYPE_LOCAL"), "TYPE_LOCAL_ID")
        .select("COMMUNE", "CODE_DEPARTEMENT", "TYPE_LOCAL", "volume")
    )
