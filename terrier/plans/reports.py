"""Matching quality reports over the enriched address dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions.scoring import LOW_QUALITY_LEVELS, MATCH_SCORES, position_label

# Section titles of the assembled report.
SECTION_LEVELS = "=== DISTRIBUTION DES NIVEAUX DE MATCHING ==="
SECTION_COVERAGE = "=== COUVERTURE GÉOGRAPHIQUE GLOBALE ==="
TOTAL_LABEL = "Total adresses"
GEOCODED_LABEL = "Adresses géocodées"
IDENTIFIED_LABEL = "Adresses avec BAN_ID"

REPORT_SCHEMA = {
    "section": "string", "match_level": "string", "match_score": "int",
    "nb_addresses": "bigint", "pct_addresses": "double",
    "nb_with_coords": "bigint", "pct_with_coords": "double",
}


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """Exact decimal quotient, rounded half up."""
    quotient = part.cast("decimal(20,0)") / whole.cast("decimal(20,0)")
    return F.round(quotient, digits).cast("double")


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100), whole)


def share_of_total(count: str) -> Column:
    """Percentage of the grand total; meant for finished, few groups."""
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()))


def located() -> Column:
    return F.count_if(F.col("LONGITUDE").isNotNull())


def match_level_distribution(enriched: DataFrame) -> DataFrame:
    groups = enriched.groupBy("MATCH_LEVEL", "MATCH_SCORE").agg(
        F.count(F.lit(1)).alias("nb_addresses"), located().alias("nb_with_coords")
    )
    return groups.select(
        "MATCH_LEVEL",
        "MATCH_SCORE",
        "nb_addresses",
        share_of_total("nb_addresses").alias("pct_addresses"),
        "nb_with_coords",
        percent(F.col("nb_with_coords"), F.col("nb_addresses")).alias("pct_with_coords"),
    ).orderBy(F.desc("MATCH_SCORE"))


def geographic_coverage(enriched: DataFrame) -> DataFrame:
    totals = enriched.agg(
        F.count(F.lit(1)).alias("total_addresses"),
        located().alias("addresses_with_gps"),
        F.count("BAN_ID").alias("addresses_with_ban_id"),
    )
    whole = F.nullif(F.col("total_addresses"), F.lit(0))
    return totals.select(
        "total_addresses",
        "addresses_with_gps",
        percent(F.col("addresses_with_gps"), whole).alias("pct_geocoded"),
        "addresses_with_ban_id",
        percent(F.col("addresses_with_ban_id"), whole).alias("pct_with_ban_id"),
    )


def quality_by_departement(enriched: DataFrame) -> DataFrame:
    levels = [
        F.count_if(F.col("MATCH_LEVEL") == level).alias(f"nb_{level.lower()}")
        for level in MATCH_SCORES
    ]
    rows = F.count(F.lit(1))
    return (
        enriched.where(F.col("CODE_DEPARTEMENT").isNotNull())
        .groupBy("CODE_DEPARTEMENT")
        .agg(
            rows.alias("nb_addresses"),
            *levels,
            percent(located(), rows).alias("pct_geocoded"),
            ratio(F.sum("MATCH_SCORE"), rows).alias("avg_match_score"),
        )
        .orderBy("CODE_DEPARTEMENT")
    )


def position_type_distribution(enriched: DataFrame) -> DataFrame:
    groups = enriched.groupBy("TYPE_POSITION").agg(F.count(F.lit(1)).alias("nb_addresses"))
    return groups.select(
        F.coalesce("TYPE_POSITION", F.lit("NULL")).alias("TYPE_POSITION"),
        "nb_addresses",
        share_of_total("nb_addresses").alias("pct_addresses"),
        position_label(F.col("TYPE_POSITION")).alias("precision_description"),
    ).orderBy(F.desc("nb_addresses"), "TYPE_POSITION")


def sample_by_level(
    enriched: DataFrame, per_level: int = 5, seed: int | None = None
) -> DataFrame:
    """Some addresses of every match level: random with a seed, else by hash of the identifier.

    The optimiser cuts each map task to ``per_level`` rows per level before the shuffle.
    """
    order = F.rand(seed) if seed is not None else F.md5("ADDRESS_ID")
    window = Window.partitionBy("MATCH_LEVEL").orderBy("_order")
    columns = [
        "MATCH_LEVEL", "ADDRESS_FULL", "CODE_POSTAL", "COMMUNE", "LONGITUDE", "LATITUDE",
        "BAN_ID", "MATCH_SCORE",
    ]
    return (
        enriched.select(*columns, order.alias("_order"))
        .withColumn("_n", F.row_number().over(window))
        .where(F.col("_n") <= per_level)
        .select(*columns)
        .orderBy(F.desc("MATCH_SCORE"), "MATCH_LEVEL")
    )


def large_communes(enriched: DataFrame, min_addresses: int = 10, **measures: Column) -> DataFrame:
    """Communes of at least so many addresses, with further measures."""
    return (
        enriched.groupBy("COMMUNE", "CODE_DEPARTEMENT")
        .agg(F.count(F.lit(1)).alias("nb_addresses"), *(c.alias(n) for n, c in measures.items()))
        .where(F.col("nb_addresses") >= min_addresses)
    )


def worst_communes(enriched: DataFrame, min_addresses: int = 10, top: int = 10) -> DataFrame:
    """The ``top`` communes by share of addresses matched at a low level."""
    rows = F.count(F.lit(1))
    low = F.count_if(F.col("MATCH_LEVEL").isin(*LOW_QUALITY_LEVELS))
    return (
        large_communes(
            enriched.where(F.col("COMMUNE").isNotNull()), min_addresses, nb_low_quality=low,
            pct_low_quality=percent(low, rows), avg_match_score=ratio(F.sum("MATCH_SCORE"), rows),
        )
        .orderBy(F.desc("pct_low_quality"), "COMMUNE", "CODE_DEPARTEMENT")
        .limit(top)
    )


def _report_rows(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Rows of the assembled report; columns not given are typed NULLs."""
    selected = []
    for name, dtype in REPORT_SCHEMA.items():
        value = columns.get(name, F.lit(None))
        value = F.col(value) if isinstance(value, str) else value
        selected.append(value.cast(dtype).alias(name))
    return df.select(*selected)


def _title(spark, text: str) -> DataFrame:
    return _report_rows(spark.range(1), section=F.lit(text))


def quality_report(enriched: DataFrame) -> DataFrame:
    """Level distribution and coverage as labelled sections of one table.

    Two passes over the dimension: the rows of the coverage section are one aggregate row, taken apart.
    """
    spark = enriched.sparkSession
    levels, coverage = match_level_distribution(enriched), geographic_coverage(enriched)
    lines = [
        (TOTAL_LABEL, "total_addresses", None),
        (GEOCODED_LABEL, "addresses_with_gps", "pct_geocoded"),
        (IDENTIFIED_LABEL, "addresses_with_ban_id", "pct_with_ban_id"),
    ]
    apart = coverage.select(F.inline(F.array(*(
        F.struct(F.lit(label).alias("label"), F.col(n).cast("bigint").alias("n"),
                 (F.col(share) if share else F.lit(None)).cast("double").alias("share"))
        for label, n, share in lines
    ))))
    return (
        _title(spark, SECTION_LEVELS)
        .unionByName(_report_rows(levels, **{c.lower(): c for c in levels.columns}))
        .unionByName(_title(spark, SECTION_COVERAGE))
        .unionByName(_report_rows(apart, section="label", nb_addresses="n", pct_addresses="share"))
    )


def missing_centroids(kpis: DataFrame, min_sales: int = 100) -> DataFrame:
    """Zones with more than so many sales and no position."""
    nowhere = (F.col("LATITUDE_CENTROID") == 0) | (F.col("LONGITUDE_CENTROID") == 0)
    return kpis.where(nowhere & (F.col("NB_VENTES") > min_sales))


def suspicious_centroids(kpi_commune: DataFrame, min_sales: int = 100, top: int = 20) -> DataFrame:
    """The ``top`` communes by sales among those with many sales and no position."""
    return (
        missing_centroids(kpi_commune, min_sales)
        .select("CODE_COMMUNE", "NOM_COMMUNE", "NB_VENTES", "LATITUDE_CENTROID", "LONGITUDE_CENTROID")
        .orderBy(F.desc("NB_VENTES"), "CODE_COMMUNE", "NOM_COMMUNE")
        .limit(top)
    )
