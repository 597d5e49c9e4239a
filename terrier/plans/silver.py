"""Silver layer: typed sales and the normalised address register (lazy, nothing is stored)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions import keys, scoring, text
from terrier.functions.numbers import parse_amount, parse_french_date, try_parse_coordinate

# Kept kind of transaction and the price it must exceed.
KEPT_NATURES = ("Vente",)
MIN_PRICE = 20000

# Bounding box of metropolitan France, bounds included.
LATITUDE_RANGE = (41.0, 51.5)
LONGITUDE_RANGE = (-5.5, 10.0)


def sale_lines(bronze_sales: DataFrame, scale0: bool = False) -> DataFrame:
    """Cheap filter first: the strict price parse only ever sees rows that pass it."""
    kept = F.col("VALEUR_FONCIERE").isNotNull() & F.col("NATURE_MUTATION").isin(*KEPT_NATURES)
    price = F.when(kept, parse_amount("VALEUR_FONCIERE", scale0))
    return bronze_sales.where(kept).where(price > MIN_PRICE)


def stg_dvf_transactions(bronze_sales: DataFrame, scale0: bool = False) -> DataFrame:
    """Sales above the price floor, with typed date and amounts; malformed text raises."""
    typed = {
        "DATE_MUTATION": parse_french_date("DATE_MUTATION"),
        "VALEUR_FONCIERE": parse_amount("VALEUR_FONCIERE", scale0),
        "SURFACE_REELLE_BATI": parse_amount("SURFACE_REELLE_BATI", scale0),
        "SURFACE_TERRAIN": parse_amount("SURFACE_TERRAIN", scale0),
    }
    return sale_lines(bronze_sales, scale0).select(
        *(typed[c].alias(c) if c in typed else F.col(c) for c in bronze_sales.columns)
    )


def identified_register_rows(bronze_register: DataFrame) -> DataFrame:
    return bronze_register.dropna(subset=["id", "code_postal", "code_insee"])


def _register_columns(scale0: bool) -> dict:
    """Cleaned register columns by output name."""
    return {
        "ID": text.norm_code("id"),
        "ID_FANTOIR": text.norm_code("id_fantoir"),
        "NUMERO": text.norm_code("numero"),
        "REPETITION": text.norm_upper("rep"),
        "NOM_VOIE": text.norm_text("nom_voie"),
        "CODE_POSTAL": text.norm_code("code_postal"),
        "CODE_INSEE": text.norm_code("code_insee"),
        "NOM_COMMUNE": text.norm_text("nom_commune"),
        "CODE_INSEE_ANCIENNE_COMMUNE": text.norm_code("code_insee_ancienne_commune"),
        "NOM_ANCIENNE_COMMUNE": text.norm_text_or_null("nom_ancienne_commune"),
        "X_LAMBERT93": try_parse_coordinate("x", scale0),
        "Y_LAMBERT93": try_parse_coordinate("y", scale0),
        "LONGITUDE": try_parse_coordinate("lon", scale0),
        "LATITUDE": try_parse_coordinate("lat", scale0),
        "TYPE_POSITION": text.norm_upper("type_position"),
        "ALIAS": F.col("alias"),
        "NOM_LIEU_DIT": text.norm_text_or_null("nom_ld"),
        "LIBELLE_ACHEMINEMENT": text.norm_text("libelle_acheminement"),
        "NOM_AFNOR": text.norm_text("nom_afnor"),
        "SOURCE_POSITION": text.norm_upper("source_position"),
        "SOURCE_NOM_VOIE": text.norm_upper("source_nom_voie"),
        "CERTIFICATION_COMMUNE": text.norm_code("certification_commune"),
        "PARCELLES_CADASTRALES": text.norm_code("cad_parcelles"),
        "CODE_DEPARTEMENT": text.norm_code("departement"),
    }


def stg_ban_addresses(bronze_register: DataFrame, scale0: bool = False) -> DataFrame:
    """The address register, cleaned column by column."""
    return identified_register_rows(bronze_register).select(
        *(c.alias(name) for name, c in _register_columns(scale0).items())
    )


def in_metropolitan_box(df: DataFrame) -> DataFrame:
    """Rows with usable coordinates; a missing coordinate fails both tests."""
    return df.where(
        F.col("LATITUDE").between(*LATITUDE_RANGE) & F.col("LONGITUDE").between(*LONGITUDE_RANGE)
    )


def stg_ban_addresses_normalized(bronze_register: DataFrame, scale0: bool = False) -> DataFrame:
    """Located register addresses with match keys and quality scores."""
    renamed = {"ID": "BAN_ID", "NUMERO": "NUMERO_RAW", "NOM_VOIE": "NOM_VOIE_RAW"}
    located = in_metropolitan_box(stg_ban_addresses(bronze_register, scale0))
    base = located.withColumnsRenamed(renamed)
    position, certified = F.col("TYPE_POSITION"), F.col("CERTIFICATION_COMMUNE")
    place = ("CODE_POSTAL", "NOM_COMMUNE")
    return base.select(
        "*",
        text.number_with_suffix("NUMERO_RAW", "REPETITION").alias("NUMERO_COMPLET"),
        text.strip_street_type("NOM_VOIE_RAW").alias("NOM_VOIE_SANS_TYPE"),
        keys.register_key_exact("NUMERO_RAW", "REPETITION", "NOM_VOIE_RAW", *place).alias(
            "MATCH_KEY_EXACT"
        ),
        keys.register_key_untyped("NUMERO_RAW", "NOM_VOIE_RAW", *place).alias(
            "MATCH_KEY_SANS_TYPE"
        ),
        keys.key_street("NOM_VOIE_RAW", *place).alias("MATCH_KEY_VOIE"),
        keys.key_postcode(*place).alias("MATCH_KEY_CODE_POSTAL"),
        F.col("CODE_INSEE").alias("MATCH_KEY_COMMUNE"),
        scoring.precision_score(position).alias("PRECISION_SCORE"),
        scoring.certification_score(certified).alias("CERTIFICATION_SCORE"),
        scoring.quality_score(position, certified).alias("QUALITY_SCORE"),
    )
