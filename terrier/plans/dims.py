"""Dimensions built from the staged sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions import keys, scoring, text
from terrier.operators.dedup import distinct_blank_insensitive, first_per_key
from terrier.plans.geocode import ADDRESS_COLUMNS, normalised_address

SOURCE_SYSTEM = "DVF"
PARCEL_COLUMNS = ["PREFIXE_DE_SECTION", "SECTION", "NO_PLAN", "NO_VOLUME"]


def dim_address(staged: DataFrame) -> DataFrame:
    """Distinct normalised sale addresses."""
    return distinct_blank_insensitive(normalised_address(staged), ADDRESS_COLUMNS).select(
        keys.address_id(*ADDRESS_COLUMNS).alias("ADDRESS_ID"),
        *ADDRESS_COLUMNS,
        text.address_label(*ADDRESS_COLUMNS[:5]).alias("ADDRESS"),
    )


def dim_code_postal(staged: DataFrame) -> DataFrame:
    """Postcodes per département, labelled with the first commune and street in order."""
    key = ["CODE_POSTAL", "CODE_DEPARTEMENT"]
    located = normalised_address(staged.dropna(subset=["CODE_POSTAL"]))
    return first_per_key(located, key, ["COMMUNE", "VOIE"], ["COMMUNE", "VOIE"]).select(
        keys.postcode_id(*key).alias("CODE_POSTAL_ID"),
        "CODE_POSTAL", "COMMUNE", "CODE_DEPARTEMENT", "VOIE",
    )


def dim_commune(addresses: DataFrame) -> DataFrame:
    """Communes of :func:`dim_address`."""
    communes = addresses.select(
        text.norm_upper("COMMUNE").alias("COMMUNE"),
        text.norm_code("CODE_DEPARTEMENT").alias("CODE_DEPARTEMENT"),
    ).distinct()
    return communes.select(keys.commune_id("COMMUNE", "CODE_DEPARTEMENT").alias("COMMUNE_ID"), "*")


def normalised_parcel(sales: DataFrame, *others) -> DataFrame:
    """The four parcel components, a missing volume being ``''``."""
    return sales.select(
        text.norm_upper("PREFIXE_DE_SECTION").alias("PREFIXE_DE_SECTION"),
        text.norm_upper("SECTION").alias("SECTION"),
        text.norm_code("NO_PLAN").alias("NO_PLAN"),
        text.norm_optional("NO_VOLUME").alias("NO_VOLUME"),
        *others,
    )


def dim_parcelle(staged: DataFrame) -> DataFrame:
    """Cadastral parcels of the sales."""
    parcels = normalised_parcel(staged).distinct()
    return parcels.select(
        keys.parcel_id(*PARCEL_COLUMNS).alias("PARCELLE_ID"),
        *PARCEL_COLUMNS[:3],
        text.null_if_blank("NO_VOLUME").alias("NO_VOLUME"),
        scoring.is_partial_parcel(F.col("SECTION"), F.col("NO_PLAN")).alias("IS_PARTIAL"),
    )


def dim_type_local(staged: DataFrame) -> DataFrame:
    """Premises types, with a member for sales that name none."""
    types = staged.select(text.premises_type("TYPE_LOCAL").alias("TYPE_LOCAL")).distinct()
    return types.select(
        keys.premises_id("TYPE_LOCAL").alias("TYPE_LOCAL_ID"),
        "TYPE_LOCAL",
        F.lit(SOURCE_SYSTEM).alias("SOURCE_SYSTEM"),
    )
