"""Sources, sinks, column functions and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from terrier.functions import keys, numbers, scoring, text
from terrier.operators.dedup import counted_rows
from terrier.plans import kpi, reports, silver
from terrier.plans.fact import YEAR_COLUMN, by_year
from terrier.plans.geocode import ADDRESS_COLUMNS, geocodable, normalised_address
from terrier.plans.warehouse import parquet_store
from terrier.registry import oracle_tables as o
from terrier.registry.core import as_double, outcomes, outcomes_sql, register
from terrier.session import scratch_path
from terrier.sources import files
from terrier.sources.bronze import REGISTER_COLUMNS, REGISTER_SCHEMA, SALES_COLUMNS, SALES_SCHEMA
from terrier.sources.bronze import derived_register, derived_sales, read_raw

# The test tables have no commune of more than 107 sales.
MIN_SALES = 10

SALES_LIST, REGISTER_LIST = ", ".join(SALES_COLUMNS), ", ".join(REGISTER_COLUMNS)

# ---------------------------------------------------------------- sources and sinks



def _raw(c, df, schema):
    """A raw source at rest, read with its fixed schema."""
    path = scratch_path(c.spark, "raw")
    df.write.parquet(path)
    return read_raw(c.spark, path, schema)


register(
    "src_1_raw_sales",
    lambda c: _raw(c, derived_sales(c.spark, c.folder), SALES_SCHEMA),
    f"SELECT {SALES_LIST} FROM bronze_dvf",
)
register(
    "src_2_raw_register",
    lambda c: _raw(c, derived_register(c.spark, c.folder), REGISTER_SCHEMA),
    f"SELECT {REGISTER_LIST} FROM bronze_ban",
)
register(
    "src_3_ref_departements",
    lambda c: outcomes(c.bronze_dvf, CODE_DEPARTEMENT=F.col("CODE_DEPARTEMENT")).join(
        c.lazy.ref_departements, "CODE_DEPARTEMENT", "left"
    ),
    """SELECT * FROM (SELECT CODE_DEPARTEMENT, count(*) AS n FROM bronze_dvf GROUP BY ALL) b
    LEFT JOIN seed USING (CODE_DEPARTEMENT)""",
)


def _ingested(c):
    """Raw sales written as compressed Latin-1 CSV, loaded again by year and département."""
    source, target = scratch_path(c.spark, "csv"), scratch_path(c.spark, "ingested")
    written_as = {"sep": ";", "encoding": "ISO-8859-1", "null_text": "\\N"}
    files.export_csv(c.bronze_dvf, source, **written_as, compression="gzip")
    files.ingest_csv(c.spark, source, target, **written_as)
    loaded = files.read_partitioned(c.spark, target, SALES_SCHEMA, ["annee", "departement"])
    return counted_rows(loaded.select("annee", "departement", *SALES_COLUMNS), "n")


register(
    "src_4_csv_ingestion",
    _ingested,
    outcomes_sql(
        "bronze_dvf", annee="substr(DATE_MUTATION, 7, 4)", departement="CODE_DEPARTEMENT",
        **{c: c for c in SALES_COLUMNS},
    ),
)


def _view(c):
    files.create_view(c.lazy.stg_ban_addresses_normalized, "terrier_stg_ban")
    return c.spark.sql(
        "SELECT TYPE_POSITION, count(*) AS n FROM terrier_stg_ban GROUP BY TYPE_POSITION"
    )


register("snk_1_silver_view", _view, outcomes_sql("ban", TYPE_POSITION="TYPE_POSITION"))


def _table(c):
    path = scratch_path(c.spark, "fact_by_year")
    files.overwrite_table(c.gold.dim_commune, path)  # replaced by the version that follows
    files.overwrite_table(by_year(c.gold.fct_mutation), path, [YEAR_COLUMN])
    stored = files.read_table(c.spark, path)
    return as_double(
        stored.groupBy("ANNEE").agg(
            F.count(F.lit(1)).alias("n"), F.sum("VALEUR_FONCIERE").alias("volume")
        ),
        "volume",
    )


register(
    "snk_2_gold_table",
    _table,
    """SELECT CAST(year(DATE_MUTATION) AS INTEGER) AS ANNEE, count(*) AS n,
    CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume FROM fct_mutation GROUP BY ALL""",
)


def _namespaces(c):
    """Two tables stored under the default schema and one of their own, read back by name."""
    root = scratch_path(c.spark, "warehouse")
    store = parquet_store(root, "gold", {"dim_type_local": " silver "})
    for name in ("dim_type_local", "dim_commune"):
        store(name, c.gold.table(name).drop("CREATED_AT"))
    types = files.read_table(c.spark, f"{root}/silver/dim_type_local")
    communes = files.read_table(c.spark, f"{root}/gold/dim_commune")
    return types.select(F.lit("silver").alias("schema_name"), F.col("TYPE_LOCAL").alias("libelle")).unionByName(
        communes.select(F.lit("gold").alias("schema_name"), F.col("COMMUNE").alias("libelle")))


register(
    "snk_3_schema_naming",
    _namespaces,
    """SELECT 'silver' AS schema_name, TYPE_LOCAL AS libelle FROM dim_type_local
    UNION ALL SELECT 'gold', COMMUNE FROM dim_commune""",
)


def _exported(c):
    path = scratch_path(c.spark, "export")
    sold = c.gold.fct_mutation.where(keys.premises_is("MAISON")).select(
        "ADDRESS_ID", "DATE_MUTATION", "VALEUR_FONCIERE", "NOMBRE_PIECES_PRINCIPALES"
    )
    files.export_csv(sold, path)
    return as_double(c.spark.read.schema(sold.schema).csv(path, header=True), "VALEUR_FONCIERE")


register(
    "snk_4_csv_export",
    _exported,
    """SELECT ADDRESS_ID, DATE_MUTATION, CAST(VALEUR_FONCIERE AS DOUBLE) AS VALEUR_FONCIERE,
    NOMBRE_PIECES_PRINCIPALES FROM fct_mutation JOIN dim_type_local USING (TYPE_LOCAL_ID)
    WHERE TYPE_LOCAL = 'MAISON'""",
)

# ---------------------------------------------------------------- column functions

_NORM = f"(SELECT {o._NORMALISED} FROM bronze_dvf) b"


def _normalised(c):
    return normalised_address(c.bronze_dvf)


register(
    "prj_1_norm_text",
    lambda c: outcomes(
        c.bronze_dvf, brut=F.col("COMMUNE"), commune=text.norm_text("COMMUNE"),
        voie=text.norm_text("VOIE"),
    ),
    outcomes_sql("bronze_dvf", brut="COMMUNE", commune=o.t("COMMUNE"), voie=o.t("VOIE")),
)
register(
    "prj_2_norm_upper",
    lambda c: outcomes(
        c.bronze_dvf, no_voie=text.norm_upper("NO_VOIE"), type_voie=text.norm_upper("TYPE_DE_VOIE"),
        section=text.norm_upper("SECTION"),
    ),
    outcomes_sql(
        "bronze_dvf", no_voie=o.u("NO_VOIE"), type_voie=o.u("TYPE_DE_VOIE"),
        section=o.u("SECTION"),
    ),
)
register(
    "prj_3_norm_code",
    lambda c: outcomes(
        c.bronze_dvf, brut=F.col("NO_VOIE"), numero=text.norm_code("NO_VOIE"),
        code_postal=text.norm_code("CODE_POSTAL"),
    ),
    outcomes_sql("bronze_dvf", brut="NO_VOIE", numero="trim(NO_VOIE)", code_postal="trim(CODE_POSTAL)"),
)
register(
    "prj_4_blank_to_null",
    lambda c: outcomes(
        c.bronze_ban, brut=F.col("nom_ld"), lieu_dit=text.norm_text_or_null("nom_ld"),
        voie=text.norm_text_or_null("nom_voie"),
    ),
    outcomes_sql(
        "bronze_ban", brut="nom_ld", lieu_dit=o.t("nullif(nom_ld, '')"),
        voie=o.t("nullif(nom_voie, '')"),
    ),
)
register(
    "prj_5_optional_component",
    lambda c: outcomes(
        c.bronze_dvf, brut=F.col("NO_VOLUME"), volume=text.norm_optional("NO_VOLUME"),
        retour=text.null_if_blank(text.norm_optional("NO_VOLUME")),
    ),
    outcomes_sql(
        "bronze_dvf", brut="NO_VOLUME", volume="trim(coalesce(NO_VOLUME, ''))",
        retour="nullif(trim(coalesce(NO_VOLUME, '')), '')",
    ),
)
register(
    "prj_6_default_member",
    lambda c: outcomes(c.bronze_dvf, brut=F.col("TYPE_LOCAL"), type=text.premises_type("TYPE_LOCAL")),
    outcomes_sql("bronze_dvf", brut="TYPE_LOCAL", type=f"coalesce({o.u('TYPE_LOCAL')}, 'INCONNU')"),
)
register(
    "prj_7_strict_amount",
    lambda c: outcomes(
        c.bronze_dvf, brut=F.col("VALEUR_FONCIERE"),
        prix=numbers.parse_amount("VALEUR_FONCIERE").cast("double"),
        entier=numbers.parse_amount("VALEUR_FONCIERE", scale0=True).cast("double"),
    ),
    outcomes_sql(
        "bronze_dvf", brut="VALEUR_FONCIERE",
        prix=f"CAST({o.amount('VALEUR_FONCIERE')} AS DOUBLE)",
        entier="CAST(CAST(replace(VALEUR_FONCIERE, ',', '.') AS DECIMAL(38,0)) AS DOUBLE)",
    ),
)
register(
    "prj_8_tolerant_number",
    lambda c: c.bronze_ban.select(
        "id",
        numbers.try_parse_coordinate("lon").alias("lon"),
        numbers.try_parse_coordinate("lat").alias("lat"),
        numbers.try_parse_coordinate("x").alias("x"),
        numbers.try_parse_amount("lon").cast("double").alias("lon2"),
        numbers.try_parse_count("numero").alias("numero"),
    ),
    f"""SELECT id, {o.coord('lon')} AS lon, {o.coord('lat')} AS lat, {o.coord('x')} AS x,
    CAST({o.amount('lon', 'TRY_CAST')} AS DOUBLE) AS lon2, TRY_CAST(numero AS INTEGER) AS numero
    FROM bronze_ban""",
)
register(
    "prj_9_strict_date",
    lambda c: outcomes(
        c.bronze_dvf, brut=F.col("DATE_MUTATION"), jour=numbers.parse_french_date("DATE_MUTATION")
    ),
    outcomes_sql(
        "bronze_dvf", brut="DATE_MUTATION", jour="CAST(strptime(DATE_MUTATION, '%d/%m/%Y') AS DATE)"
    ),
)
register(
    "prj_10_year",
    lambda c: outcomes(c.lazy.stg_dvf_transactions, annee=F.year("DATE_MUTATION")),
    outcomes_sql("stg", annee="CAST(extract(year FROM DATE_MUTATION) AS INTEGER)"),
)
register(
    "prj_11_strip_street_type",
    lambda c: outcomes(
        c.lazy.stg_ban_addresses, voie=F.col("NOM_VOIE"), nue=text.strip_street_type("NOM_VOIE")
    ),
    outcomes_sql("ban_all", voie="NOM_VOIE", nue=o.untyped("NOM_VOIE")),
)
register(
    "prj_12_full_street",
    lambda c: outcomes(
        _normalised(c), type=F.col("TYPE_DE_VOIE"), voie=F.col("VOIE"),
        complete=text.full_street("TYPE_DE_VOIE", "VOIE"),
    ),
    outcomes_sql(_NORM, type="TYPE_DE_VOIE", voie="VOIE", complete=o._STREET),
)
register(
    "prj_13_number_with_suffix",
    lambda c: outcomes(
        c.lazy.stg_ban_addresses, rep=F.col("REPETITION"),
        complet=text.number_with_suffix("NUMERO", "REPETITION"),
    ),
    outcomes_sql(
        "ban_all", rep="REPETITION",
        complet="CASE WHEN REPETITION IS NULL THEN NUMERO ELSE NUMERO || ' ' || REPETITION END",
    ),
)
_REGISTER_KEYS = ("EXACT", "SANS_TYPE", "VOIE", "CODE_POSTAL", "COMMUNE")
register(
    "prj_14_register_match_keys",
    lambda c: c.lazy.stg_ban_addresses_normalized.select(
        "BAN_ID", *(f"MATCH_KEY_{k}" for k in _REGISTER_KEYS)
    ),
    "SELECT BAN_ID, " + ", ".join(f"MATCH_KEY_{k}" for k in _REGISTER_KEYS) + " FROM ban",
)


def _sale_keys(c):
    from terrier.plans.geocode import sale_match_keys, unique_addresses

    return unique_addresses(c.lazy.stg_dvf_transactions).select(
        *ADDRESS_COLUMNS, *(k.alias(f"k{i}") for i, k in enumerate(sale_match_keys().values(), 1))
    )


register(
    "prj_15_sale_match_keys",
    _sale_keys,
    f"SELECT {', '.join(ADDRESS_COLUMNS)}, k1, k2, k3, k4 FROM keyed",
)
register(
    "prj_16_precision_score",
    lambda c: outcomes(
        c.lazy.stg_ban_addresses, position=F.col("TYPE_POSITION"),
        score=scoring.precision_score(F.col("TYPE_POSITION")),
    ),
    outcomes_sql("ban_all", position="TYPE_POSITION", score=o.score("TYPE_POSITION")),
)
register(
    "prj_17_quality_score",
    lambda c: outcomes(
        c.lazy.stg_ban_addresses, certifiee=F.col("CERTIFICATION_COMMUNE"),
        bonus=scoring.certification_score(F.col("CERTIFICATION_COMMUNE")),
        qualite=scoring.quality_score(F.col("TYPE_POSITION"), F.col("CERTIFICATION_COMMUNE")),
    ),
    outcomes_sql(
        "ban_all", certifiee="CERTIFICATION_COMMUNE",
        bonus="CASE CERTIFICATION_COMMUNE WHEN '1' THEN 10 ELSE 0 END",
        qualite=o.score("TYPE_POSITION") + " + CASE CERTIFICATION_COMMUNE WHEN '1' THEN 10 ELSE 0 END",
    ),
)
register(
    "prj_18_hex_key",
    lambda c: outcomes(_normalised(c), cle=keys.address_id(*ADDRESS_COLUMNS)),
    outcomes_sql(_NORM, cle=o.hexkey(o.bar(*ADDRESS_COLUMNS))),
)
register(
    "prj_19_numeric_key",
    lambda c: outcomes(
        _normalised(c), commune=keys.commune_id("COMMUNE", "CODE_DEPARTEMENT"),
        rue=keys.premises_id("TYPE_DE_VOIE"),
    ),
    outcomes_sql(
        _NORM, commune=o.longkey("COMMUNE || '|' || CODE_DEPARTEMENT"), rue=o.longkey("TYPE_DE_VOIE")
    ),
)
register(
    "prj_20_fallback_key",
    lambda c: outcomes(
        _normalised(c), secours=keys.fallback_address_id("COMMUNE", "CODE_DEPARTEMENT"),
        sans_type=keys.fallback_address_id("TYPE_DE_VOIE", "CODE_DEPARTEMENT"),
    ),
    outcomes_sql(
        _NORM, secours=o.hexkey("'UNKNOWN|' || COMMUNE || '|' || CODE_DEPARTEMENT"),
        sans_type=o.hexkey("'UNKNOWN|' || TYPE_DE_VOIE || '|' || CODE_DEPARTEMENT"),
    ),
)
_FIVE = ADDRESS_COLUMNS[:5]
_STREET_PARTS = ", ' ', ".join(o.e(c) for c in _FIVE[:3])
_TOWN_PARTS = ", ' ', ".join(o.e(c) for c in _FIVE[3:])
register(
    "prj_21_address_labels",
    lambda c: outcomes(
        _normalised(c), simple=text.address_label(*_FIVE), virgule=text.address_label_full(*_FIVE)
    ),
    outcomes_sql(
        _NORM, simple=f"concat({_STREET_PARTS}, ' ', {_TOWN_PARTS})",
        virgule=f"concat({_STREET_PARTS}, ', ', {_TOWN_PARTS})",
    ),
)
register(
    "prj_22_partial_parcel",
    lambda c: outcomes(
        c.bronze_dvf, section=F.col("SECTION"),
        partiel=scoring.is_partial_parcel(F.col("SECTION"), F.col("NO_PLAN")),
    ),
    outcomes_sql(
        "bronze_dvf", section="SECTION",
        partiel="CASE WHEN SECTION IS NULL OR NO_PLAN IS NULL THEN 1 ELSE 0 END",
    ),
)
register(
    "prj_23_link_strategy",
    lambda c: outcomes(
        c.gold.fct_mutation, strategie=F.col("ADDRESS_MATCH_STRATEGY"),
        # All three labels: by register entry, else by INSEE code.
        par_ban=scoring.link_strategy(F.col("BAN_ID"), F.col("CODE_INSEE")),
    ),
    outcomes_sql(
        "fct_mutation", strategie="ADDRESS_MATCH_STRATEGY",
        par_ban="CASE WHEN BAN_ID IS NOT NULL THEN 'MATCH_ADDRESS' "
        "WHEN CODE_INSEE IS NOT NULL THEN 'FALLBACK_COMMUNE' ELSE 'NO_MATCH' END",
    ),
)
register(
    "prj_24_price_per_m2",
    lambda c: outcomes(
        as_double(c.lazy.stg_dvf_transactions, "VALEUR_FONCIERE", "SURFACE_REELLE_BATI"),
        prix=F.col("VALEUR_FONCIERE"), surface=F.col("SURFACE_REELLE_BATI"),
        m2=numbers.price_per_m2("VALEUR_FONCIERE", "SURFACE_REELLE_BATI"),
    ),
    outcomes_sql(
        "stg", prix="CAST(VALEUR_FONCIERE AS DOUBLE)", surface="CAST(SURFACE_REELLE_BATI AS DOUBLE)",
        m2="CASE WHEN SURFACE_REELLE_BATI <> 0 THEN CAST(VALEUR_FONCIERE AS DOUBLE) / CAST(SURFACE_REELLE_BATI AS DOUBLE) END",
    ),
)
register(
    "prj_25_position_label",
    lambda c: outcomes(
        c.gold.dim_address_enriched, position=F.col("TYPE_POSITION"),
        libelle=scoring.position_label(F.col("TYPE_POSITION")),
    ),
    outcomes_sql(
        "dim_address_enriched", position="TYPE_POSITION", libelle=o.position_label("TYPE_POSITION")
    ),
)
register(
    "prj_26_audit_columns",
    lambda c: outcomes(
        c.gold.dim_type_local, source=F.col("SOURCE_SYSTEM"), date=F.col("CREATED_AT").isNotNull()
    ),
    outcomes_sql("dim_type_local", source="'DVF'", date="true"),
)
_EMPTY = (
    "BAN_ID", "CODE_INSEE", "ID_FANTOIR", "LONGITUDE", "TYPE_POSITION", "BAN_QUALITY_SCORE", "NOM_AFNOR",
)
register(
    "prj_27_typed_nulls",
    lambda c: outcomes(c.gold.dim_address_enriched, **{x: F.col(x) for x in _EMPTY}).where(
        F.col("BAN_QUALITY_SCORE").isNull()
    ),
    outcomes_sql("dim_address_enriched", "MATCH_LEVEL = 'NO_MATCH'", **{x: x for x in _EMPTY}),
)
register(
    "prj_28_calendar",
    lambda c: outcomes(
        c.lazy.stg_dvf_transactions, mois=F.trunc("DATE_MUTATION", "month"),
        recent=F.col("DATE_MUTATION") >= F.add_months(F.lit(dt.date(2000, 6, 15)), -24),
        an=F.year("DATE_MUTATION"),
    ),
    outcomes_sql(
        "stg", mois="CAST(date_trunc('month', DATE_MUTATION) AS DATE)",
        recent="DATE_MUTATION >= DATE '2000-06-15' - INTERVAL 2 YEAR",
        an="CAST(year(DATE_MUTATION) AS INTEGER)",
    ),
)

# ---------------------------------------------------------------- filters

register(
    "flt_1_sales_above_floor",
    lambda c: silver.sale_lines(c.bronze_dvf),
    f"""SELECT {SALES_LIST} FROM bronze_dvf
    WHERE NATURE_MUTATION = 'Vente' AND {o.amount('VALEUR_FONCIERE')} > 20000""",
)
register(
    "flt_2_mandatory_fields",
    lambda c: silver.identified_register_rows(c.bronze_ban),
    f"""SELECT {REGISTER_LIST} FROM bronze_ban
    WHERE id IS NOT NULL AND code_postal IS NOT NULL AND code_insee IS NOT NULL""",
)
register(
    "flt_3_metropolitan_box",
    lambda c: silver.in_metropolitan_box(c.lazy.stg_ban_addresses).select("ID", "LONGITUDE", "LATITUDE"),
    "SELECT BAN_ID AS ID, LONGITUDE, LATITUDE FROM ban",
)
register(
    "flt_4_geocodable",
    lambda c: outcomes(geocodable(c.lazy.stg_dvf_transactions), cp=F.col("CODE_POSTAL")),
    outcomes_sql("stg", "CODE_POSTAL IS NOT NULL AND COMMUNE IS NOT NULL", cp="CODE_POSTAL"),
)
register(
    "flt_5_kpi_eligible",
    lambda c: kpi.eligible(c.gold.fct_mutation).select("ADDRESS_ID", "ANNEE", "PRIX_M2"),
    "SELECT ADDRESS_ID, ANNEE, m2 AS PRIX_M2 FROM sales",
)
register(
    "flt_6_missing_centroids",
    lambda c: reports.missing_centroids(c.gold_scale0.gold_kpi_commune, MIN_SALES).select(
        "CODE_COMMUNE", "NOM_COMMUNE", "ANNEE", "NB_VENTES"
    ),
    f"""SELECT CODE_COMMUNE, NOM_COMMUNE, ANNEE, NB_VENTES FROM gold_kpi_commune
    WHERE (LATITUDE_CENTROID = 0 OR LONGITUDE_CENTROID = 0) AND NB_VENTES > {MIN_SALES}""",
    scale0=True,
)
register(
    "flt_7_minimum_group_size",
    lambda c: reports.large_communes(c.gold.dim_address_enriched),
    """SELECT COMMUNE, CODE_DEPARTEMENT, count(*) AS nb_addresses FROM dim_address_enriched
    GROUP BY ALL HAVING count(*) >= 10""",
)
register(
    "flt_8_sufficient_data",
    lambda c: outcomes(
        c.gold.gold_kpi_code_postal, suffisant=F.col("HAS_SUFFICIENT_DATA"), ventes=F.col("NB_VENTES")
    ),
    outcomes_sql("gold_kpi_code_postal", suffisant="NB_VENTES >= 5", ventes="NB_VENTES"),
)
