"""Joins, aggregations, windows, sorting and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions import keys
from terrier.functions.scoring import level_rank
from terrier.operators import dedup
from terrier.operators.quantiles import Quantile, Summary, grouped_median, summarise
from terrier.plans import consumer, dims, fact, geocode, kpi, reports
from terrier.registry import oracle_tables as o
from terrier.registry.core import as_double, outcomes, outcomes_sql, register, rounded

# ---------------------------------------------------------------- joins

_MATCH = ["ADDRESS_ID", "BAN_ID", "CODE_INSEE", "LONGITUDE", "LATITUDE", "BAN_QUALITY_SCORE"]
_MATCH_SQL = (
    f"ADDRESS_ID, BAN_ID, CODE_INSEE, {o.r6('LONGITUDE')} AS LONGITUDE, "
    f"{o.r6('LATITUDE')} AS LATITUDE, {o.r6('q')} AS BAN_QUALITY_SCORE"
)


def _level(level: str):
    def run(c):
        found = geocode.matches_by_level(
            c.lazy.stg_dvf_transactions, c.lazy.stg_ban_addresses_normalized
        )
        return rounded(found[level].select(*_MATCH), *_MATCH[3:])

    return run


_BEST = (
    "row_number() OVER (PARTITION BY ADDRESS_ID ORDER BY q DESC, p DESC, BAN_ID) = 1"
)


def _level_sql(lvl: int) -> str:
    return f"""SELECT {_MATCH_SQL} FROM candidates
    WHERE lvl = {lvl} AND ADDRESS_ID NOT IN (SELECT ADDRESS_ID FROM candidates WHERE lvl < {lvl})
    QUALIFY {_BEST}"""


register("jn_1_exact", _level("EXACT"), _level_sql(1))
register("jn_2_untyped", _level("SANS_TYPE"), _level_sql(2))
register("jn_3_street", _level("VOIE_SEULE"), _level_sql(3))
register("jn_4_postcode", _level("CODE_POSTAL"), _level_sql(4))
# The cascade never gets to level COMMUNE, so the join is shown over all addresses.
register(
    "jn_5_commune",
    lambda c: rounded(
        geocode.match_commune(
            geocode.identified_addresses(c.lazy.stg_dvf_transactions),
            c.lazy.stg_ban_addresses_normalized,
        ).select(*_MATCH),
        *_MATCH[3:],
    ),
    f"SELECT {_MATCH_SQL} FROM candidates WHERE lvl = 5",
)


def _unmatched(c):
    staged, register_ = c.lazy.stg_dvf_transactions, c.lazy.stg_ban_addresses_normalized
    addresses = geocode.identified_addresses(staged)
    sides = {k: geocode.LEVEL_SIDES[k](register_) for k in ("EXACT", "SANS_TYPE")}
    hits = [geocode.match_level(addresses, side, k) for k, side in sides.items()]
    return geocode.unmatched(addresses, *hits).select("ADDRESS_ID")


register(
    "jn_6_anti_join",
    _unmatched,
    """SELECT ADDRESS_ID FROM keyed
    WHERE ADDRESS_ID NOT IN (SELECT ADDRESS_ID FROM candidates WHERE lvl <= 2)""",
)
register(
    "jn_7_first_match_wins",
    lambda c: c.lazy.dim_address_enriched.select(
        "ADDRESS_ID", "MATCH_LEVEL", "MATCH_SCORE", "BAN_ID"
    ),
    "SELECT ADDRESS_ID, MATCH_LEVEL, MATCH_SCORE, BAN_ID FROM dim_address_enriched",
)


def _sales(c):
    return fact.clean_sales(c.lazy.stg_dvf_transactions)


register(
    "jn_8_fact_address",
    lambda c: outcomes(
        fact.join_address(_sales(c), c.gold.dim_address_enriched),
        id=F.col("ADDRESS_ID"), niveau=F.col("MATCH_LEVEL"),
    ),
    outcomes_sql("fct_mutation", id="ADDRESS_ID", niveau="GEOCODING_MATCH_LEVEL"),
)
register(
    "jn_9_fact_commune",
    lambda c: outcomes(
        fact.join_commune(_sales(c), c.gold.dim_commune), id=F.col("COMMUNE_ID")
    ),
    outcomes_sql("fct_mutation", id="COMMUNE_ID"),
)
register(
    "jn_10_fact_type_local",
    lambda c: outcomes(
        fact.join_type_local(_sales(c), c.gold.dim_type_local), id=F.col("TYPE_LOCAL_ID")
    ),
    outcomes_sql("fct_mutation", id="TYPE_LOCAL_ID"),
)
register(
    "jn_11_fact_parcelle",
    lambda c: outcomes(
        fact.join_parcelle(_sales(c), c.gold.dim_parcelle), id=F.col("PARCELLE_ID")
    ),
    outcomes_sql("fct_mutation", id="PARCELLE_ID"),
)
register(
    "jn_12_fact_code_postal",
    lambda c: outcomes(
        fact.join_code_postal(_sales(c), c.gold.dim_code_postal), id=F.col("CODE_POSTAL_ID")
    ),
    outcomes_sql("fct_mutation", id="CODE_POSTAL_ID"),
)


register(
    "jn_13_star_join",
    lambda c: consumer.sales_by_star(
        kpi.eligible(c.gold.fct_mutation), c.gold.dim_commune, c.gold.dim_type_local,
        c.gold.dim_code_postal,
    ),
    outcomes_sql("sales", COMMUNE="COMMUNE", TYPE_LOCAL="TYPE_LOCAL", CODE_POSTAL="CODE_POSTAL"),
)
register(
    "jn_14_seed_fallback",
    lambda c: rounded(
        c.indicators.gold_kpi_departement.select(
            "CODE_DEPARTEMENT", "ANNEE", "NOM_DEPARTEMENT", "LATITUDE_CENTROID",
            "LONGITUDE_CENTROID",
        ),
        "LATITUDE_CENTROID", "LONGITUDE_CENTROID",
    ),
    f"""SELECT CODE_DEPARTEMENT, ANNEE, NOM_DEPARTEMENT,
    {o.r6('LATITUDE_CENTROID')} AS LATITUDE_CENTROID,
    {o.r6('LONGITUDE_CENTROID')} AS LONGITUDE_CENTROID FROM gold_kpi_departement""",
)


register(
    "jn_15_inner_star_join",
    lambda c: as_double(
        consumer.volume_by_commune_and_type(
            c.gold.fct_mutation, c.gold.dim_commune, c.gold.dim_type_local
        ),
        "volume",
    ),
    """SELECT COMMUNE, CODE_DEPARTEMENT, TYPE_LOCAL, CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume
    FROM fct_mutation JOIN dim_commune USING (COMMUNE_ID) JOIN dim_type_local USING (TYPE_LOCAL_ID)
    GROUP BY ALL""",
)

# ---------------------------------------------------------------- aggregations


def _eligible(c) -> DataFrame:
    return kpi.eligible(c.gold.fct_mutation)


register(
    "agg_1_exact_median",
    lambda c: grouped_median(_eligible(c), ["COMMUNE_ID"], F.col("PRIX_M2"), "mediane"),
    "SELECT COMMUNE_ID, median(m2) AS mediane FROM sales GROUP BY ALL",
)
register(
    "agg_2_conditional_median",
    lambda c: summarise(
        _eligible(c),
        ["CODE_INSEE"],
        Summary(
            F.col("PRIX_M2"),
            {
                "appartement": Quantile(when=keys.premises_is("APPARTEMENT")),
                "maison": Quantile(when=keys.premises_is("MAISON")),
            },
        ),
    ),
    """SELECT CODE_INSEE, median(CASE WHEN TYPE_LOCAL = 'APPARTEMENT' THEN m2 END) AS appartement,
    median(CASE WHEN TYPE_LOCAL = 'MAISON' THEN m2 END) AS maison FROM sales GROUP BY ALL""",
)
register(
    "agg_3_conditional_count",
    lambda c: _eligible(c).groupBy("ANNEE", "COMMUNE_ID").agg(
        F.count_if(keys.premises_is("APPARTEMENT")).alias("appartements"),
        F.count_if(F.col("LONGITUDE").isNotNull()).alias("situees"),
    ),
    """SELECT ANNEE, COMMUNE_ID, count(*) FILTER (TYPE_LOCAL = 'APPARTEMENT') AS appartements,
    count(LONGITUDE) AS situees FROM sales GROUP BY ALL""",
)
register(
    "agg_4_count_by_group",
    lambda c: c.gold.fct_mutation.groupBy("CODE_POSTAL_ID", "GEOCODING_MATCH_LEVEL").agg(
        F.count(F.lit(1)).alias("n")
    ),
    "SELECT CODE_POSTAL_ID, GEOCODING_MATCH_LEVEL, count(*) AS n FROM fct_mutation GROUP BY ALL",
)
register(
    "agg_5_centroid",
    lambda c: rounded(
        c.gold.fct_mutation.groupBy("COMMUNE_ID").agg(
            F.coalesce(F.avg("LATITUDE"), F.lit(0.0)).alias("lat"),
            F.coalesce(F.avg("LONGITUDE"), F.lit(0.0)).alias("lon"),
        ),
        "lat", "lon",
    ),
    f"""SELECT COMMUNE_ID, {o.r6('coalesce(avg(LATITUDE), 0)')} AS lat,
    {o.r6('coalesce(avg(LONGITUDE), 0)')} AS lon FROM fct_mutation GROUP BY ALL""",
)
register(
    "agg_6_max_text",
    lambda c: c.lazy.stg_ban_addresses_normalized.groupBy("MATCH_KEY_VOIE").agg(
        F.max("SOURCE_POSITION").alias("source"), F.max("PARCELLES_CADASTRALES").alias("parcelle")
    ),
    """SELECT MATCH_KEY_VOIE, max(SOURCE_POSITION) AS source, max(PARCELLES_CADASTRALES) AS parcelle
    FROM ban GROUP BY ALL""",
)
register(
    "agg_7_mean_quality",
    lambda c: rounded(
        c.gold.dim_address_enriched.groupBy("CODE_DEPARTEMENT").agg(
            reports.ratio(F.sum("MATCH_SCORE"), F.count(F.lit(1))).alias("score"),
            F.avg("BAN_QUALITY_SCORE").alias("qualite"),
        ),
        "qualite",
    ),
    f"""SELECT CODE_DEPARTEMENT, {o.pct('sum(MATCH_SCORE)', 'count(*)', 1)} AS score,
    {o.r6('avg(BAN_QUALITY_SCORE)')} AS qualite FROM dim_address_enriched GROUP BY ALL""",
)
register(
    "agg_8_ratio_percent",
    lambda c: c.gold.dim_address_enriched.groupBy("COMMUNE").agg(
        reports.percent(reports.located(), F.count(F.lit(1))).alias("pct_situees")
    ),
    f"""SELECT COMMUNE, {o.pct('count(LONGITUDE)', 'count(*)')} AS pct_situees
    FROM dim_address_enriched GROUP BY ALL""",
)
register(
    "agg_9_share_of_total",
    lambda c: c.gold.fct_mutation.groupBy("TYPE_LOCAL_ID").agg(F.count(F.lit(1)).alias("n"))
    .select("TYPE_LOCAL_ID", "n", reports.share_of_total("n").alias("part")),
    f"""SELECT TYPE_LOCAL_ID, count(*) AS n, {o.pct('count(*)', 'sum(count(*)) OVER ()')} AS part
    FROM fct_mutation GROUP BY TYPE_LOCAL_ID""",
)
register(
    "agg_10_global",
    lambda c: c.gold.fct_mutation.agg(
        F.count(F.lit(1)).alias("lignes"),
        F.count("BAN_ID").alias("identifiees"),
        F.sum("VALEUR_FONCIERE").cast("double").alias("volume"),
        F.min("DATE_MUTATION").alias("debut"),
        F.max("DATE_MUTATION").alias("fin"),
    ),
    """SELECT count(*) AS lignes, count(BAN_ID) AS identifiees,
    CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume, min(DATE_MUTATION) AS debut,
    max(DATE_MUTATION) AS fin FROM fct_mutation""",
)
register(
    "agg_11_sum_and_mean",
    lambda c: rounded(
        _eligible(c).groupBy("COMMUNE_ID").agg(
            F.sum("VALEUR_FONCIERE").cast("double").alias("volume"),
            F.avg("PRIX_M2").alias("prix_m2"),
        ),
        "prix_m2",
    ),
    f"""SELECT COMMUNE_ID, CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume,
    {o.r6('avg(m2)')} AS prix_m2 FROM sales GROUP BY ALL""",
)

# ---------------------------------------------------------------- windows

register(
    "win_1_first_of_duplicates",
    lambda c: dedup.distinct_blank_insensitive(
        geocode.normalised_address(c.bronze_dvf), geocode.ADDRESS_COLUMNS
    ),
    f"SELECT * FROM (SELECT {o._NORMALISED} FROM bronze_dvf) n QUALIFY {o._FIRST_OF_SIX}",
)
register(
    "win_2_first_commune",
    lambda c: dedup.first_per_key(
        geocode.normalised_address(c.bronze_dvf), ["CODE_POSTAL"], ["COMMUNE", "TYPE_DE_VOIE"],
        ["COMMUNE", "TYPE_DE_VOIE"],
    ),
    f"""SELECT CODE_POSTAL, COMMUNE, TYPE_DE_VOIE FROM (SELECT {o._NORMALISED} FROM bronze_dvf) n
    QUALIFY row_number() OVER (PARTITION BY CODE_POSTAL
      ORDER BY COMMUNE NULLS LAST, TYPE_DE_VOIE NULLS LAST) = 1""",
)
register(
    "win_3_distinct_keys",
    lambda c: dims.normalised_parcel(c.bronze_dvf).distinct(),
    f"""SELECT {o.u('PREFIXE_DE_SECTION')} AS PREFIXE_DE_SECTION, {o.u('SECTION')} AS SECTION,
    trim(NO_PLAN) AS NO_PLAN, trim({o.e('NO_VOLUME')}) AS NO_VOLUME FROM bronze_dvf GROUP BY ALL""",
)
register(
    "win_4_best_match",
    lambda c: geocode.exact_winners(c.lazy.stg_ban_addresses_normalized).select(
        "key", "payload.BAN_ID", F.col("payload.BAN_QUALITY_SCORE").alias("qualite")
    ),
    """SELECT MATCH_KEY_EXACT AS key, BAN_ID, CAST(QUALITY_SCORE AS DOUBLE) AS qualite FROM ban
    QUALIFY row_number() OVER (PARTITION BY MATCH_KEY_EXACT
      ORDER BY QUALITY_SCORE DESC, PRECISION_SCORE DESC, BAN_ID) = 1""",
)
register(
    "win_5_rank_of_mean",
    lambda c: rounded(
        geocode.street_winners(c.lazy.stg_ban_addresses_normalized).select(
            "key", "payload.BAN_ID", F.col("payload.BAN_QUALITY_SCORE").alias("qualite"),
            F.col("payload.LONGITUDE").alias("lon"),
        ),
        "qualite", "lon",
    ),
    f"""SELECT MATCH_KEY_VOIE AS key, BAN_ID, {o.r6('avg(QUALITY_SCORE)')} AS qualite,
    {o.r6('avg(LONGITUDE)')} AS lon FROM ban GROUP BY MATCH_KEY_VOIE, BAN_ID, CODE_INSEE, ID_FANTOIR
    QUALIFY row_number() OVER (PARTITION BY MATCH_KEY_VOIE ORDER BY avg(QUALITY_SCORE) DESC, BAN_ID) = 1""",
)


def _sample(c):
    """How many addresses a random sample shows per level: the rows themselves vary."""
    shown = reports.sample_by_level(c.gold.dim_address_enriched, seed=7)
    return outcomes(shown, MATCH_LEVEL=F.col("MATCH_LEVEL"))


register(
    "win_6_random_sample",
    _sample,
    "SELECT MATCH_LEVEL, least(count(*), 5) AS n FROM dim_address_enriched GROUP BY ALL",
)
register(
    "win_7_grand_total",
    lambda c: c.gold.fct_mutation.groupBy(F.year("DATE_MUTATION").alias("annee"))
    .agg(F.count(F.lit(1)).alias("n"))
    .withColumn("total", F.sum("n").over(Window.partitionBy())),
    """SELECT CAST(year(DATE_MUTATION) AS INTEGER) AS annee, count(*) AS n,
    CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM fct_mutation GROUP BY 1""",
)

# ---------------------------------------------------------------- sorting and limits

register(
    "srt_1_multi_column",
    lambda c: c.gold.gold_kpi_commune.select(
        "CODE_DEPARTEMENT", "CODE_COMMUNE", "ANNEE", "NB_VENTES"
    ).orderBy("CODE_DEPARTEMENT", "CODE_COMMUNE", "ANNEE"),
    """SELECT CODE_DEPARTEMENT, CODE_COMMUNE, ANNEE, NB_VENTES FROM gold_kpi_commune
    ORDER BY 1, 2, 3""",
)
register(
    "srt_2_by_rank",
    lambda c: outcomes(c.gold.dim_address_enriched, niveau=F.col("MATCH_LEVEL")).orderBy(level_rank(F.col("niveau"))),
    outcomes_sql("dim_address_enriched", niveau="MATCH_LEVEL"),
)
register(
    "srt_3_worst_ten",
    lambda c: c.gold.gold_kpi_departement.orderBy(
        F.desc("PRIX_MEDIAN_M2"), "CODE_DEPARTEMENT", "ANNEE"
    ).limit(10).select("CODE_DEPARTEMENT", "ANNEE", "PRIX_MEDIAN_M2"),
    """SELECT CODE_DEPARTEMENT, ANNEE, PRIX_MEDIAN_M2 FROM gold_kpi_departement
    ORDER BY PRIX_MEDIAN_M2 DESC, CODE_DEPARTEMENT, ANNEE LIMIT 10""",
)
register(
    "srt_4_top_hundred",
    lambda c: as_double(
        c.gold.fct_mutation.select("ADDRESS_ID", "DATE_MUTATION", "VALEUR_FONCIERE")
        .orderBy(F.desc("VALEUR_FONCIERE"), "ADDRESS_ID", "DATE_MUTATION")
        .limit(100),
        "VALEUR_FONCIERE",
    ),
    """SELECT ADDRESS_ID, DATE_MUTATION, CAST(VALEUR_FONCIERE AS DOUBLE) AS VALEUR_FONCIERE
    FROM fct_mutation ORDER BY fct_mutation.VALEUR_FONCIERE DESC, ADDRESS_ID, DATE_MUTATION LIMIT 100""",
)

# ---------------------------------------------------------------- set operations

_LEVEL_COLUMNS = ["ADDRESS_ID", "BAN_ID", "MATCH_LEVEL", "MATCH_SCORE"]


def _all_levels(c):
    found = geocode.matches_by_level(
        c.lazy.stg_dvf_transactions, c.lazy.stg_ban_addresses_normalized
    )
    return reduce(DataFrame.unionByName, (f.select(*_LEVEL_COLUMNS) for f in found.values()))


register(
    "set_1_union_of_levels",
    _all_levels,
    f"SELECT {', '.join(_LEVEL_COLUMNS)} FROM dim_address_enriched",
)


def _better_ids(c):
    found = geocode.matches_by_level(
        c.lazy.stg_dvf_transactions, c.lazy.stg_ban_addresses_normalized
    )
    ids = [found[k].select("ADDRESS_ID") for k in ("EXACT", "SANS_TYPE", "VOIE_SEULE")]
    return reduce(DataFrame.unionAll, ids)


register(
    "set_2_union_of_ids",
    _better_ids,
    "SELECT ADDRESS_ID FROM dim_address_enriched WHERE MATCH_SCORE >= 70",
)


def _sections(c):
    by_level = outcomes(c.gold.dim_address_enriched, rubrique=F.col("MATCH_LEVEL"))
    by_type = outcomes(c.gold.dim_address_enriched, position=F.col("TYPE_POSITION"))
    return by_level.withColumn("position", F.lit(None).cast("string")).unionByName(
        by_type.withColumn("rubrique", F.lit(None).cast("string"))
    )


register(
    "set_3_labelled_sections",
    _sections,
    """SELECT MATCH_LEVEL AS rubrique, NULL AS position, count(*) AS n FROM dim_address_enriched GROUP BY 1
    UNION ALL SELECT NULL, TYPE_POSITION, count(*) FROM dim_address_enriched GROUP BY 2""",
)
