"""Checks that the tables of the star schema must pass."""

from __future__ import annotations

from terrier.functions.scoring import MATCH_SCORES
from terrier.operators.checks import Check

# Columns per table that must be present.
NOT_NULL = {
    "stg_dvf_transactions": ("DATE_MUTATION", "VALEUR_FONCIERE"),
    "stg_ban_addresses": ("ID", "CODE_POSTAL", "CODE_INSEE"),
    "stg_ban_addresses_normalized": (
        "BAN_ID", "MATCH_KEY_EXACT", "MATCH_KEY_SANS_TYPE", "MATCH_KEY_VOIE",
        "MATCH_KEY_CODE_POSTAL", "MATCH_KEY_COMMUNE", "LONGITUDE", "LATITUDE", "QUALITY_SCORE",
        "TYPE_POSITION",
    ),
    "dim_address": ("ADDRESS_ID", "CODE_POSTAL", "COMMUNE", "CODE_DEPARTEMENT", "CREATED_AT"),
    "dim_address_enriched": (
        "ADDRESS_ID", "CODE_POSTAL", "COMMUNE", "CODE_DEPARTEMENT", "MATCH_LEVEL",
        "MATCH_SCORE", "CREATED_AT", "UPDATED_AT",
    ),
    "dim_code_postal": ("CODE_POSTAL_ID", "CODE_POSTAL", "CODE_DEPARTEMENT", "CREATED_AT"),
    "dim_commune": ("COMMUNE_ID", "COMMUNE", "CODE_DEPARTEMENT", "CREATED_AT"),
    "dim_parcelle": ("PARCELLE_ID", "IS_PARTIAL", "CREATED_AT"),
    "dim_type_local": ("TYPE_LOCAL_ID", "TYPE_LOCAL", "CREATED_AT", "SOURCE_SYSTEM"),
    "gold_kpi_france": (
        "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES", "NB_VENTES_APPARTEMENT", "NB_VENTES_MAISON",
    ),
    "gold_kpi_departement": (
        "CODE_DEPARTEMENT", "NOM_DEPARTEMENT", "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES",
        "NB_VENTES_APPARTEMENT", "NB_VENTES_MAISON", "LATITUDE_CENTROID", "LONGITUDE_CENTROID",
    ),
    "fct_mutation": (
        "ADDRESS_ID", "ADDRESS_MATCH_STRATEGY", "DATE_MUTATION", "NATURE_MUTATION",
        "CREATED_AT",
    ),
    "gold_kpi_commune": (
        "CODE_COMMUNE", "CODE_DEPARTEMENT", "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES",
        "LATITUDE_CENTROID", "LONGITUDE_CENTROID", "HAS_SUFFICIENT_DATA",
    ),
    "gold_kpi_code_postal": (
        "CODE_POSTAL", "ANNEE", "PRIX_MEDIAN_M2", "NB_VENTES", "LATITUDE_CENTROID",
        "LONGITUDE_CENTROID", "HAS_SUFFICIENT_DATA",
    ),
}

# Unique column per table.
UNIQUE = {
    "stg_ban_addresses": "ID",
    "stg_ban_addresses_normalized": "BAN_ID",
    "dim_address": "ADDRESS_ID",
    "dim_address_enriched": "ADDRESS_ID",
    "dim_code_postal": "CODE_POSTAL_ID",
    "dim_commune": "COMMUNE_ID",
    "dim_parcelle": "PARCELLE_ID",
    "dim_type_local": "TYPE_LOCAL_ID",
}

# Accepted values per table and column.
ACCEPTED = {
    ("dim_address_enriched", "MATCH_LEVEL"): tuple(MATCH_SCORES),
    ("dim_address_enriched", "MATCH_SCORE"): tuple(MATCH_SCORES.values()),
    ("dim_parcelle", "IS_PARTIAL"): (0, 1),
    ("dim_type_local", "SOURCE_SYSTEM"): ("DVF",),
    ("fct_mutation", "ADDRESS_MATCH_STRATEGY"): ("MATCH_ADDRESS", "FALLBACK_COMMUNE", "NO_MATCH"),
    ("fct_mutation", "NATURE_MUTATION"): ("Vente",),
}

# Dimension behind each foreign key of the fact, and the rows the rule holds for.
REFERENCES = {
    "ADDRESS_ID": ("dim_address_enriched", "ADDRESS_MATCH_STRATEGY = 'MATCH_ADDRESS'"),
    "COMMUNE_ID": ("dim_commune", ""),
    "PARCELLE_ID": ("dim_parcelle", ""),
    "TYPE_LOCAL_ID": ("dim_type_local", ""),
    "CODE_POSTAL_ID": ("dim_code_postal", ""),
}

MEDIANS = ("PRIX_MEDIAN_M2", "PRIX_MEDIAN_APPARTEMENT", "PRIX_MEDIAN_MAISON")
KPI_TABLES = (
    "gold_kpi_france", "gold_kpi_departement", "gold_kpi_commune", "gold_kpi_code_postal",
)


def declared_checks() -> list[Check]:
    return [
        *(Check(m, c, "not_null") for m, cols in NOT_NULL.items() for c in cols),
        *(Check(m, c, "unique") for m, c in UNIQUE.items()),
        *(Check(m, c, "accepted_values", values=v) for (m, c), v in ACCEPTED.items()),
        *(
            Check("fct_mutation", c, "relationships", to=to, where=where)
            for c, (to, where) in REFERENCES.items()
        ),
        *(Check(m, c, "prix_median_positif") for m in KPI_TABLES for c in MEDIANS),
    ]
