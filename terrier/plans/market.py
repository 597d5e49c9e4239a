"""Market analyses over the sales fact table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions.keys import premises_is
from terrier.functions.numbers import in_period, price_per_m2
from terrier.operators.geo import cell
from terrier.operators.quantiles import Quantile, Summary, summarise
from terrier.plans.geocode import POSITION_COLUMNS
from terrier.plans.fact import sold_in
from terrier.plans.kpi import eligible
from terrier.session import written

ROWS = "nb_ventes"


def filter_sales(
    fact: DataFrame,
    premises: str | None = None,
    year: int | None = None,
    quarter: int | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """Sales by premises type, period and price range; every filter is optional."""
    price = F.col("VALEUR_FONCIERE")
    wanted = in_period("DATE_MUTATION", year, quarter) if year is None else F.lit(True)
    if premises is not None:
        wanted &= premises_is(premises)
    if min_price is not None:
        wanted &= price >= min_price
    if max_price is not None:
        wanted &= price <= max_price
    return (fact if year is None else sold_in(fact, year, quarter)).where(wanted)


def zone_statistics(fact: DataFrame, zone: list[str]) -> DataFrame:
    """Median price, sales, volume and mean surface per zone."""
    spec = Summary(
        F.col("VALEUR_FONCIERE"),
        {"prix_median": Quantile()},
        counts={ROWS: None},
        means={"surface_moyenne": F.col("SURFACE_REELLE_BATI")},
        sums={"volume_total": F.col("VALEUR_FONCIERE")},
    )
    return summarise(fact, zone, spec)


def price_evolution(fact: DataFrame, period: str = "quarter") -> DataFrame:
    """Median price per square metre and sales per calendar period."""
    dated = eligible(fact).withColumn("periode", F.date_trunc(period, "DATE_MUTATION").cast("date"))
    spec = Summary(F.col("PRIX_M2"), {"prix_median_m2": Quantile()}, counts={ROWS: None})
    return summarise(dated, ["periode"], spec).orderBy("periode")


def compare_communes(fact: DataFrame, communes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Median price per square metre, one column per commune name and one row per year."""
    chosen = communes.where(F.col("COMMUNE").isin(*names)).select("COMMUNE_ID", "COMMUNE")
    # Written: the two passes of the medians read the few chosen sales, not the join.
    sold = eligible(fact).select("COMMUNE_ID", "ANNEE", "PRIX_M2").join(chosen, "COMMUNE_ID")
    sold = written(sold, "chosen-sales")
    medians = summarise(sold, ["ANNEE", "COMMUNE"], Summary(F.col("PRIX_M2"), {"m": Quantile()}))
    return medians.groupBy("ANNEE").pivot("COMMUNE", list(names)).agg(F.max("m")).orderBy("ANNEE")


def density_cells(fact: DataFrame, step: float) -> DataFrame:
    """Located sales per grid cell of ``step`` degrees."""
    return (
        fact.where(F.col("LATITUDE").isNotNull())
        .groupBy(
            cell(F.col("LATITUDE"), step).alias("cell_lat"),
            cell(F.col("LONGITUDE"), step).alias("cell_lon"),
        )
        .agg(F.count(F.lit(1)).alias(ROWS))
    )


def price_bands(fact: DataFrame, width: int) -> DataFrame:
    """Sales and volume per price band; a band starts at ``band * width``."""
    band = F.floor(F.col("VALEUR_FONCIERE") / F.lit(width)).cast("bigint")
    return (
        fact.where(F.col("VALEUR_FONCIERE").isNotNull())
        .groupBy(band.alias("band"))
        .agg(F.count(F.lit(1)).alias(ROWS), F.sum("VALEUR_FONCIERE").alias("volume_total"))
    )


def moving_average(fact: DataFrame, communes: DataFrame, months: int = 12) -> DataFrame:
    """Mean price per square metre per département over the last ``months`` calendar months.

    Monthly sums per commune come first: communes are joined to them, not to sales. The window then
    runs over one row per month.
    """
    zones = communes.where(F.col("CODE_DEPARTEMENT").isNotNull())
    local = eligible(fact).groupBy("COMMUNE_ID", F.trunc("DATE_MUTATION", "month").alias("mois")).agg(
        F.sum("PRIX_M2").alias("_sum"), F.count("PRIX_M2").alias("_n")
    )
    placed = local.join(zones.select("COMMUNE_ID", "CODE_DEPARTEMENT"), "COMMUNE_ID")
    monthly = placed.groupBy("CODE_DEPARTEMENT", "mois").agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")
    )
    index = F.year("mois") * F.lit(12) + F.month("mois")
    window = (
        Window.partitionBy("CODE_DEPARTEMENT").orderBy("_i").rangeBetween(-(months - 1), 0)
    )
    return monthly.withColumn("_i", index).select(
        "CODE_DEPARTEMENT",
        "mois",
        F.col("_n").alias(ROWS),
        (F.sum("_sum").over(window) / F.sum("_n").over(window)).alias("prix_m2_glissant"),
    )


def yearly_change(kpis: DataFrame, zone: list[str], price: str = "PRIX_MEDIAN_M2") -> DataFrame:
    """Change in percent against the year before, NULL where that year has no figure."""
    window = Window.partitionBy(*zone).orderBy("ANNEE")
    consecutive = F.lag("ANNEE").over(window) == F.col("ANNEE") - 1
    before = F.when(consecutive, F.lag(price).over(window))
    return kpis.select(
        *zone, "ANNEE", price, ((F.col(price) / before - 1) * 100).alias("evolution_pct")
    )


def dwelling_size(rooms: Column) -> Column:
    """T1 to T4 by number of rooms, T5+ beyond; NULL without rooms."""
    return F.when(rooms >= 5, F.lit("T5+")).when(
        rooms >= 1, F.concat(F.lit("T"), rooms.cast("string"))
    )


def price_by_size(fact: DataFrame) -> DataFrame:
    """Sales and mean price per room by dwelling size."""
    rooms = F.col("NOMBRE_PIECES_PRINCIPALES")
    per_room = F.col("VALEUR_FONCIERE").cast("double") / F.nullif(rooms, F.lit(0))
    return fact.groupBy(dwelling_size(rooms).alias("typologie")).agg(
        F.count(F.lit(1)).alias(ROWS), F.avg(per_room).alias("prix_piece_moyen")
    )


def land_price(fact: DataFrame) -> DataFrame:
    """Mean price per square metre of land by year."""
    sold = fact.where(F.col("SURFACE_TERRAIN") > 0)
    return sold.groupBy(F.year("DATE_MUTATION").alias("ANNEE")).agg(
        F.count(F.lit(1)).alias(ROWS),
        F.avg(price_per_m2("VALEUR_FONCIERE", "SURFACE_TERRAIN")).alias("prix_m2_terrain"),
    )


def price_outliers(fact: DataFrame, by: list[str], spread: float = 1.5) -> DataFrame:
    """Sales whose price per square metre lies far outside the quartiles of their group.

    The bounds are stored first: their true size then lets the join keep the sales in place.
    """
    sold = eligible(fact)
    quartiles = Summary(F.col("PRIX_M2"), {"q1": Quantile(0.25), "q3": Quantile(0.75)})
    reach = (F.col("q3") - F.col("q1")) * F.lit(spread)
    bounds = summarise(sold, by, quartiles).select(
        *(F.col(c).alias(f"_{c}") for c in by),
        (F.col("q1") - reach).alias("borne_basse"),
        (F.col("q3") + reach).alias("borne_haute"),
    )
    bounds = written(bounds, "bounds")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by))
    outside = (F.col("PRIX_M2") < F.col("borne_basse")) | (F.col("PRIX_M2") > F.col("borne_haute"))
    return sold.join(bounds, same).where(outside).drop(*(f"_{c}" for c in by))


def price_hotspots(fact: DataFrame, step: float, min_sales: int, min_price: float) -> DataFrame:
    """Grid cells with enough sales and a high mean price per square metre."""
    return (
        eligible(fact)
        .where(F.col("LATITUDE").isNotNull())
        .groupBy(
            cell(F.col("LATITUDE"), step).alias("cell_lat"),
            cell(F.col("LONGITUDE"), step).alias("cell_lon"),
        )
        .agg(F.count(F.lit(1)).alias(ROWS), F.avg("PRIX_M2").alias("prix_m2_moyen"))
        .where((F.col(ROWS) >= min_sales) & (F.col("prix_m2_moyen") >= min_price))
    )


def score_weighted_price(fact: DataFrame) -> DataFrame:
    """Mean price per square metre by year, each sale weighted by its match score."""
    score = F.coalesce("GEOCODING_MATCH_SCORE", F.lit(0))
    return eligible(fact).groupBy("ANNEE").agg(
        F.sum(score).alias("poids"),
        (F.sum(score * F.col("PRIX_M2")) / F.nullif(F.sum(score), F.lit(0))).alias("prix_m2_pondere"),
    )


def register_parcels(enriched: DataFrame) -> DataFrame:
    """One row per address and parcel code of its register entry."""
    codes = F.split("PARCELLES_CADASTRALES", r"[|,]")
    exploded = enriched.select("ADDRESS_ID", F.explode(codes).alias("code"))
    return exploded.select("ADDRESS_ID", F.trim("code").alias("code")).where(F.col("code") != "")


def parcels_of_addresses(
    enriched: DataFrame,
    parcels: DataFrame,
    register_key: Callable[[Column], Column],
    parcel_key: Callable[[DataFrame], Column],
) -> DataFrame:
    """Register parcels per address, with the number of sale parcels of the same key.

    The two sources write parcels differently, so the caller says how to compare them. Sale parcels
    are counted per key before the join: each register parcel meets one row.
    """
    counted = parcels.groupBy(parcel_key(parcels).alias("_key")).agg(
        F.count(F.lit(1)).alias("nb_parcelles_vente")
    )
    listed = register_parcels(enriched).withColumn("_key", register_key(F.col("code")))
    return listed.join(counted, "_key", "left").select(
        "ADDRESS_ID",
        F.col("code").alias("parcelle_ban"),
        F.coalesce("nb_parcelles_vente", F.lit(0)).cast("bigint").alias("nb_parcelles_vente"),
    )


def street_centroids(register: DataFrame) -> DataFrame:
    """Mean position per street, over all its register points."""
    means = [F.avg(c).alias(c) for c in POSITION_COLUMNS]
    return register.groupBy(F.col("MATCH_KEY_VOIE").alias("CLE_VOIE")).agg(
        F.count(F.lit(1)).alias("nb_points"), *means
    )
