"""Scores and labels of address positions and matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Precision score of a register position, any other type scoring 10.
POSITION_SCORES = {
    "HOUSENUMBER": 100,
    "INTERPOLATION": 80,
    "STREET": 60,
    "LOCALITY": 40,
    "MUNICIPALITY": 20,
}
OTHER_POSITION_SCORE = 10
CERTIFIED_BONUS = 10

# Match levels from best to worst, with their scores.
MATCH_SCORES = {
    "EXACT": 100,
    "SANS_TYPE": 90,
    "VOIE_SEULE": 70,
    "CODE_POSTAL": 50,
    "COMMUNE": 30,
    "NO_MATCH": 0,
}
LOW_QUALITY_LEVELS = ("NO_MATCH", "COMMUNE", "CODE_POSTAL")

# How a sale line was linked to an address.
LINKED_TO_ADDRESS = "MATCH_ADDRESS"
LINKED_TO_COMMUNE = "FALLBACK_COMMUNE"
NOT_LINKED = "NO_MATCH"

# Precision label of a position type.
POSITION_LABELS = {
    "HOUSENUMBER": "Numéro exact (précision < 10m)",
    "INTERPOLATION": "Numéro interpolé (précision ~10-50m)",
    "STREET": "Centroïde de rue (précision ~50-200m)",
    "LOCALITY": "Lieu-dit (précision ~200-500m)",
    "MUNICIPALITY": "Centroïde commune (précision > 500m)",
}
NO_POSITION_LABEL = "Pas de coordonnées"


def lookup(c: Column, mapping: dict, default) -> Column:
    """Constant mapping as a CASE chain."""
    chain = F
    for key, value in mapping.items():
        chain = chain.when(c == F.lit(key), F.lit(value))
    return chain.otherwise(F.lit(default))


def precision_score(position_type: Column) -> Column:
    return lookup(position_type, POSITION_SCORES, OTHER_POSITION_SCORE)


def certification_score(certified: Column) -> Column:
    return F.when(certified == "1", F.lit(CERTIFIED_BONUS)).otherwise(F.lit(0))


def quality_score(position_type: Column, certified: Column) -> Column:
    return precision_score(position_type) + certification_score(certified)


def position_label(position_type: Column) -> Column:
    return lookup(position_type, POSITION_LABELS, NO_POSITION_LABEL)


def level_rank(level: Column) -> Column:
    """1 for the best match level, counting up; NULL for an unknown level."""
    return lookup(level, {name: i for i, name in enumerate(MATCH_SCORES, 1)}, None)


def link_strategy(address_key: Column, commune_key: Column) -> Column:
    return (
        F.when(address_key.isNotNull(), F.lit(LINKED_TO_ADDRESS))
        .when(commune_key.isNotNull(), F.lit(LINKED_TO_COMMUNE))
        .otherwise(F.lit(NOT_LINKED))
    )


def is_partial_parcel(section: Column, plan: Column) -> Column:
    return (section.isNull() | plan.isNull()).cast("int")
