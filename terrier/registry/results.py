"""Complete tables, indicators, reports, consumer queries and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from terrier.operators import checks
from terrier.plans import consumer, reports
from terrier.plans.declared_checks import declared_checks
from terrier.plans.fact import sold_in
from terrier.registry import oracle_tables as o
from terrier.registry.columns import MIN_SALES
from terrier.registry.core import as_double, register, rounded

# ---------------------------------------------------------------- tables

_AMOUNTS = ("VALEUR_FONCIERE", "SURFACE_REELLE_BATI", "SURFACE_TERRAIN")
_AMOUNTS_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _AMOUNTS)
_MEANS = ("LONGITUDE", "LATITUDE", "X_LAMBERT93", "Y_LAMBERT93", "BAN_QUALITY_SCORE")


def _rounded_sql(*columns: str) -> str:
    return ", ".join(f"{o.r6(c)} AS {c}" for c in columns)


register(
    "mdl_1_stg_dvf_transactions",
    lambda c: as_double(c.lazy.stg_dvf_transactions, *_AMOUNTS),
    f"SELECT * REPLACE ({_AMOUNTS_SQL}) FROM stg",
)
register("mdl_2_stg_ban_addresses", lambda c: c.lazy.stg_ban_addresses, "SELECT * FROM ban_all")
register(
    "mdl_3_stg_ban_addresses_normalized",
    lambda c: c.lazy.stg_ban_addresses_normalized,
    "SELECT * FROM ban",
)
register("mdl_4_dim_address", lambda c: c.lazy.dim_address, "SELECT * FROM dim_address")
register(
    "mdl_5_dim_address_enriched",
    lambda c: rounded(c.lazy.dim_address_enriched, *_MEANS),
    f"SELECT * REPLACE ({_rounded_sql(*_MEANS)}) FROM dim_address_enriched",
)
register("mdl_6_dim_code_postal", lambda c: c.lazy.dim_code_postal, "SELECT * FROM dim_code_postal")
register("mdl_7_dim_commune", lambda c: c.lazy.dim_commune, "SELECT * FROM dim_commune")
register("mdl_8_dim_parcelle", lambda c: c.lazy.dim_parcelle, "SELECT * FROM dim_parcelle")
register("mdl_9_dim_type_local", lambda c: c.lazy.dim_type_local, "SELECT * FROM dim_type_local")
register(
    "mdl_10_fct_mutation",
    lambda c: as_double(rounded(c.lazy.fct_mutation, "LONGITUDE", "LATITUDE"), *_AMOUNTS),
    f"SELECT * REPLACE ({_AMOUNTS_SQL}, {_rounded_sql('LONGITUDE', 'LATITUDE')}) FROM fct_mutation",
)

# ---------------------------------------------------------------- whole amounts and coordinates

register(
    "mdl_1_scale0",
    lambda c: as_double(c.gold_scale0.stg_dvf_transactions, *_AMOUNTS),
    f"SELECT * REPLACE ({_AMOUNTS_SQL}) FROM stg",
    scale0=True,
)
register(
    "mdl_3_scale0",
    lambda c: c.gold_scale0.stg_ban_addresses_normalized,
    "SELECT * FROM ban",
    scale0=True,
)
register(
    "mdl_10_scale0",
    lambda c: as_double(
        rounded(c.gold_scale0.fct_mutation, "LONGITUDE", "LATITUDE").drop("ANNEE", "CREATED_AT"), *_AMOUNTS
    ),
    f"SELECT * REPLACE ({_AMOUNTS_SQL}, {_rounded_sql('LONGITUDE', 'LATITUDE')}) FROM fct_mutation",
    scale0=True,
)
register(
    "kpi_3_scale0",
    lambda c: rounded(c.gold_scale0.gold_kpi_commune, *_CENTROID),
    f"SELECT * REPLACE ({_rounded_sql('LATITUDE_CENTROID', 'LONGITUDE_CENTROID')}) FROM gold_kpi_commune",
    scale0=True,
)

# ---------------------------------------------------------------- indicators

_CENTROID = ("LATITUDE_CENTROID", "LONGITUDE_CENTROID")


register(
    "kpi_1_france",
    lambda c: c.indicators.gold_kpi_france,
    "SELECT * FROM gold_kpi_france",
)
for _key, _name in (
    ("kpi_2_departement", "gold_kpi_departement"),
    ("kpi_3_commune", "gold_kpi_commune"),
    ("kpi_4_code_postal", "gold_kpi_code_postal"),
):
    register(
        _key,
        lambda c, name=_name: rounded(c.indicators.table(name), *_CENTROID),
        f"SELECT * REPLACE ({_rounded_sql(*_CENTROID)}) FROM {_name}",
    )

# ---------------------------------------------------------------- matching quality


def _enriched(c):
    return c.gold.dim_address_enriched


_SHARE = o.pct("count(*)", "sum(count(*)) OVER ()")
_LOCATED = o.pct("count(LONGITUDE)", "count(*)")
_LEVELS_SQL = f"""SELECT MATCH_LEVEL, MATCH_SCORE, count(*) AS nb_addresses, {_SHARE} AS pct_addresses,
    count(LONGITUDE) AS nb_with_coords, {_LOCATED} AS pct_with_coords
    FROM dim_address_enriched GROUP BY MATCH_LEVEL, MATCH_SCORE"""
_COVERAGE_SQL = f"""SELECT count(*) AS total_addresses, count(LONGITUDE) AS addresses_with_gps,
    {_LOCATED} AS pct_geocoded, count(BAN_ID) AS addresses_with_ban_id,
    {o.pct('count(BAN_ID)', 'count(*)')} AS pct_with_ban_id FROM dim_address_enriched"""

register(
    "rpt_1_match_levels", lambda c: reports.match_level_distribution(_enriched(c)), _LEVELS_SQL
)
register("rpt_2_coverage", lambda c: reports.geographic_coverage(_enriched(c)), _COVERAGE_SQL)
register(
    "rpt_3_by_departement",
    lambda c: reports.quality_by_departement(_enriched(c)),
    "SELECT CODE_DEPARTEMENT, count(*) AS nb_addresses, "
    + ", ".join(
        f"count(*) FILTER (MATCH_LEVEL = '{x}') AS nb_{x.lower()}" for x in o.MATCH_SCORES
    )
    + f""", {_LOCATED} AS pct_geocoded, {o.pct('sum(MATCH_SCORE)', 'count(*)', 1)} AS avg_match_score
    FROM dim_address_enriched WHERE CODE_DEPARTEMENT IS NOT NULL GROUP BY CODE_DEPARTEMENT""",
)
register(
    "rpt_4_position_types",
    lambda c: reports.position_type_distribution(_enriched(c)),
    f"""SELECT coalesce(d.TYPE_POSITION, 'NULL') AS TYPE_POSITION, count(*) AS nb_addresses,
    {_SHARE} AS pct_addresses, {o.position_label('d.TYPE_POSITION')} AS precision_description
    FROM dim_address_enriched d GROUP BY d.TYPE_POSITION""",
)
register(
    "rpt_5_sample",
    lambda c: rounded(reports.sample_by_level(_enriched(c)), "LONGITUDE", "LATITUDE"),
    f"""SELECT MATCH_LEVEL, ADDRESS_FULL, CODE_POSTAL, COMMUNE, {o.r6('LONGITUDE')} AS LONGITUDE,
    {o.r6('LATITUDE')} AS LATITUDE, BAN_ID, MATCH_SCORE FROM dim_address_enriched
    QUALIFY row_number() OVER (PARTITION BY MATCH_LEVEL ORDER BY md5(ADDRESS_ID)) <= 5""",
)
_LOW = "count(*) FILTER (MATCH_SCORE <= 50)"
register(
    "rpt_6_worst_communes",
    lambda c: reports.worst_communes(_enriched(c)),
    f"""SELECT COMMUNE, CODE_DEPARTEMENT, count(*) AS nb_addresses, {_LOW} AS nb_low_quality,
    {o.pct(_LOW, 'count(*)')} AS pct_low_quality,
    {o.pct('sum(MATCH_SCORE)', 'count(*)', 1)} AS avg_match_score
    FROM dim_address_enriched WHERE COMMUNE IS NOT NULL GROUP BY COMMUNE, CODE_DEPARTEMENT
    HAVING count(*) >= 10 ORDER BY pct_low_quality DESC, COMMUNE, CODE_DEPARTEMENT LIMIT 10""",
)
_SIX_NULLS = "CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)"
register(
    "rpt_7_assembled",
    lambda c: reports.quality_report(_enriched(c)),
    f"""SELECT * FROM (SELECT CAST(NULL AS VARCHAR) AS section, MATCH_LEVEL AS match_level, MATCH_SCORE AS match_score,
      nb_addresses, pct_addresses, nb_with_coords, pct_with_coords FROM ({_LEVELS_SQL}) l)
    UNION ALL SELECT '{reports.SECTION_LEVELS}', {_SIX_NULLS}
    UNION ALL SELECT '{reports.SECTION_COVERAGE}', {_SIX_NULLS}
    UNION ALL SELECT '{reports.TOTAL_LABEL}', NULL, NULL, total_addresses, NULL, NULL, NULL FROM ({_COVERAGE_SQL}) c
    UNION ALL SELECT '{reports.GEOCODED_LABEL}', NULL, NULL, addresses_with_gps, pct_geocoded, NULL, NULL FROM ({_COVERAGE_SQL}) c
    UNION ALL SELECT '{reports.IDENTIFIED_LABEL}', NULL, NULL, addresses_with_ban_id, pct_with_ban_id, NULL, NULL FROM ({_COVERAGE_SQL}) c""",
)
register(
    "rpt_8_suspicious_centroids",
    lambda c: reports.suspicious_centroids(c.gold_scale0.gold_kpi_commune, MIN_SALES),
    f"""SELECT CODE_COMMUNE, NOM_COMMUNE, NB_VENTES, LATITUDE_CENTROID, LONGITUDE_CENTROID
    FROM gold_kpi_commune WHERE (LATITUDE_CENTROID = 0 OR LONGITUDE_CENTROID = 0) AND NB_VENTES > {MIN_SALES}
    ORDER BY NB_VENTES DESC, CODE_COMMUNE, NOM_COMMUNE LIMIT 20""",
    scale0=True,
)

# ---------------------------------------------------------------- consumer queries

YEAR, TODAY, SINCE = 1998, dt.date(2000, 6, 15), dt.date(1999, 1, 1)

register(
    "qry_1_median_by_commune",
    lambda c: consumer.median_by_commune(c.gold.fct_mutation, c.gold.dim_commune, YEAR),
    f"""SELECT COMMUNE, CODE_DEPARTEMENT, median(CAST(VALEUR_FONCIERE AS DOUBLE)) AS prix_median,
    count(*) AS nb_transactions FROM fct_mutation JOIN dim_commune USING (COMMUNE_ID)
    WHERE year(DATE_MUTATION) = {YEAR} GROUP BY COMMUNE, CODE_DEPARTEMENT
    ORDER BY prix_median DESC, COMMUNE, CODE_DEPARTEMENT LIMIT 20""",
)
register(
    "qry_2_price_by_type",
    lambda c: rounded(
        consumer.mean_price_by_type(c.gold.fct_mutation, c.gold.dim_type_local), "prix_m2_moyen"
    ),
    f"""SELECT TYPE_LOCAL, {o.r6('avg(m2)')} AS prix_m2_moyen, count(*) AS nb_transactions
    FROM sales WHERE VALEUR_FONCIERE > 0 GROUP BY TYPE_LOCAL""",
)
register(
    "qry_3_monthly_trend",
    lambda c: as_double(consumer.monthly_trend(c.gold.fct_mutation, TODAY), "volume_total"),
    f"""SELECT CAST(date_trunc('month', DATE_MUTATION) AS DATE) AS mois, count(*) AS nb_transactions,
    median(CAST(VALEUR_FONCIERE AS DOUBLE)) AS prix_median,
    CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume_total
    FROM fct_mutation WHERE DATE_MUTATION >= DATE '{TODAY}' - INTERVAL 2 YEAR GROUP BY 1""",
)
register(
    "qry_4_apartment_price_by_month",
    lambda c: rounded(consumer.monthly_apartment_price(c.gold.fct_mutation), "prix_m2_moyen"),
    f"""SELECT CAST(date_trunc('month', DATE_MUTATION) AS DATE) AS mois, {o.r6('avg(m2)')} AS prix_m2_moyen
    FROM sales WHERE TYPE_LOCAL = 'APPARTEMENT' AND VALEUR_FONCIERE > 0 GROUP BY 1""",
)
register(
    "qry_5_precisely_located",
    lambda c: as_double(
        rounded(
            consumer.precisely_located(c.gold.fct_mutation, _enriched(c), SINCE),
            "LONGITUDE", "LATITUDE",
        ),
        "VALEUR_FONCIERE", "SURFACE_REELLE_BATI",
    ),
    f"""SELECT ADDRESS_FULL, {o.r6('a.LONGITUDE')} AS LONGITUDE, {o.r6('a.LATITUDE')} AS LATITUDE,
    CAST(VALEUR_FONCIERE AS DOUBLE) AS VALEUR_FONCIERE,
    CAST(SURFACE_REELLE_BATI AS DOUBLE) AS SURFACE_REELLE_BATI, TYPE_LOCAL
    FROM fct_mutation f JOIN dim_address_enriched a USING (ADDRESS_ID) JOIN dim_type_local t USING (TYPE_LOCAL_ID)
    WHERE GEOCODING_MATCH_LEVEL IN ('EXACT', 'SANS_TYPE') AND DATE_MUTATION >= DATE '{SINCE}'
      AND TYPE_LOCAL = 'APPARTEMENT'
    ORDER BY f.VALEUR_FONCIERE DESC, ADDRESS_ID, f.SURFACE_REELLE_BATI NULLS FIRST LIMIT 100""",
)
register(
    "qry_6_geocoding_quality",
    lambda c: consumer.geocoding_quality(c.gold.fct_mutation),
    f"""SELECT GEOCODING_MATCH_LEVEL, count(*) AS nb_transactions, {_SHARE} AS pourcentage
    FROM fct_mutation GROUP BY GEOCODING_MATCH_LEVEL""",
)
register(
    "qry_7_most_active_communes",
    lambda c: as_double(
        consumer.most_active_communes(c.gold.fct_mutation, c.gold.dim_commune), "volume_total"
    ),
    """SELECT COMMUNE, CODE_DEPARTEMENT, count(*) AS nb_transactions,
    CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume_total
    FROM fct_mutation JOIN dim_commune USING (COMMUNE_ID) GROUP BY COMMUNE, CODE_DEPARTEMENT
    ORDER BY nb_transactions DESC, COMMUNE, CODE_DEPARTEMENT LIMIT 10""",
)

# ---------------------------------------------------------------- checks

register(
    "chk_1_not_null",
    lambda c: checks.not_null(_enriched(c), "BAN_ID").select("ADDRESS_ID", "MATCH_LEVEL"),
    "SELECT ADDRESS_ID, MATCH_LEVEL FROM dim_address_enriched WHERE BAN_ID IS NULL",
)
register(
    "chk_2_unique",
    lambda c: checks.unique(c.gold.fct_mutation, "PARCELLE_ID"),
    """SELECT PARCELLE_ID, count(*) AS n_records FROM fct_mutation WHERE PARCELLE_ID IS NOT NULL
    GROUP BY PARCELLE_ID HAVING count(*) > 1""",
)
register(
    "chk_3_accepted_values",
    lambda c: checks.accepted_values(_enriched(c), "MATCH_LEVEL", ("EXACT", "SANS_TYPE")).select(
        "ADDRESS_ID", "MATCH_LEVEL"
    ),
    """SELECT ADDRESS_ID, MATCH_LEVEL FROM dim_address_enriched
    WHERE MATCH_LEVEL NOT IN ('EXACT', 'SANS_TYPE')""",
)
_PRECISE = "MATCH_LEVEL IN ('EXACT', 'SANS_TYPE')"
register(
    "chk_4_relationships",
    lambda c: checks.relationships(
        c.gold.fct_mutation, "ADDRESS_ID", _enriched(c).where(_PRECISE), "ADDRESS_ID"
    ).select("ADDRESS_ID", "DATE_MUTATION"),
    f"""SELECT ADDRESS_ID, DATE_MUTATION FROM fct_mutation f
    WHERE NOT EXISTS (FROM dim_address_enriched a WHERE a.ADDRESS_ID = f.ADDRESS_ID AND {_PRECISE})""",
)
register(
    "chk_5_conditional_relationship",
    lambda c: checks.relationships(
        sold_in(c.gold.fct_mutation, YEAR), "ADDRESS_ID", _enriched(c).where(_PRECISE), "ADDRESS_ID"
    ).select("ADDRESS_ID", "DATE_MUTATION"),
    f"""SELECT ADDRESS_ID, DATE_MUTATION FROM fct_mutation f WHERE year(DATE_MUTATION) = {YEAR} AND
    NOT EXISTS (FROM dim_address_enriched a WHERE a.ADDRESS_ID = f.ADDRESS_ID AND {_PRECISE})""",
)
register(
    "chk_6_positive_median",
    lambda c: checks.positive_median(
        c.gold.gold_kpi_commune.withColumn("ecart", F.col("PRIX_MEDIAN_M2") - 2000.0), "ecart"
    ).select("CODE_COMMUNE", "NOM_COMMUNE", "ANNEE"),
    """SELECT CODE_COMMUNE, NOM_COMMUNE, ANNEE FROM gold_kpi_commune
    WHERE PRIX_MEDIAN_M2 - 2000.0 <= 0""",
)
register(
    "chk_7_documented_checks",
    lambda c: checks.coordinates_outside(_enriched(c), (44.0, 47.0), (-0.5, 4.0))
    .select(F.lit("position").alias("regle"), "ADDRESS_ID")
    .unionByName(
        checks.positive_price(c.gold.fct_mutation).select(F.lit("prix").alias("regle"), "ADDRESS_ID")
    ),
    """SELECT 'position' AS regle, ADDRESS_ID FROM dim_address_enriched
    WHERE LATITUDE < 44.0 OR LATITUDE > 47.0 OR LONGITUDE < -0.5 OR LONGITUDE > 4.0
    UNION ALL SELECT 'prix', ADDRESS_ID FROM fct_mutation WHERE VALEUR_FONCIERE <= 0""",
)

_AUDIT = ("CREATED_AT", "UPDATED_AT")
_SQL_TABLES = {
    "stg_dvf_transactions": "stg",
    "stg_ban_addresses": "ban_all",
    "stg_ban_addresses_normalized": "ban",
}


def _check_sql(check: checks.Check) -> str:
    table, c = _SQL_TABLES.get(check.model, check.model), check.column
    if c in _AUDIT:
        count = "SELECT 0 AS failures"
    elif check.kind == "unique":
        count = f"SELECT count(*) AS failures FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d"
    elif check.kind == "relationships":
        where = f"{check.where} AND " if check.where else ""
        count = f"SELECT count(*) AS failures FROM {table} WHERE {where}{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {check.to})"
    else:
        values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.values)
        failing = {
            "not_null": f"{c} IS NULL",
            "accepted_values": f"{c} NOT IN ({values})",
            "prix_median_positif": f"{c} <= 0",
        }[check.kind]
        count = f"SELECT count(*) AS failures FROM {table} WHERE {failing}"
    return (
        f"SELECT '{check.model}' AS model, '{c}' AS column_name, '{check.kind}' AS check_name, "
        f"CAST(failures AS BIGINT) AS failures FROM ({count}) x"
    )


register(
    "chk_8_all_declared",
    lambda c: checks.run_checks(c.checked_table, declared_checks(), c.counted),
    "\nUNION ALL ".join(_check_sql(x) for x in declared_checks()),
)
