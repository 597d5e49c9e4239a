"""Address matching cascade: every distinct sale address gets its best register match.

All choices within a match level depend on register columns only, and sale addresses are unique.
So the register is reduced to one row per match key *before* joining: every join is 1:0..1, nothing
fans out, and the first level that hits wins by coalescing whole payload structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions import keys, text
from terrier.functions.scoring import MATCH_SCORES
from terrier.operators.bloom import having_keys
from terrier.operators.dedup import best_per_key, distinct_blank_insensitive
from terrier.operators.lookup import lookup_left
from terrier.session import written

ADDRESS_COLUMNS = [
    "NO_VOIE", "TYPE_DE_VOIE", "VOIE", "CODE_POSTAL", "COMMUNE", "CODE_DEPARTEMENT",
]
POSITION_COLUMNS = ["LONGITUDE", "LATITUDE", "X_LAMBERT93", "Y_LAMBERT93"]

# What a match adds to an address. One type for all levels, so that levels can be coalesced.
PAYLOAD = {
    "BAN_ID": "string",
    "CODE_INSEE": "string",
    "ID_FANTOIR": "string",
    "LONGITUDE": "double",
    "LATITUDE": "double",
    "X_LAMBERT93": "double",
    "Y_LAMBERT93": "double",
    "MATCH_LEVEL": "string",
    "MATCH_SCORE": "int",
    "TYPE_POSITION": "string",
    "SOURCE_POSITION": "string",
    "BAN_QUALITY_SCORE": "double",
    "PARCELLES_CADASTRALES": "string",
    "LIBELLE_ACHEMINEMENT": "string",
    "NOM_AFNOR": "string",
}

# Register columns that the cascade reads.
MATCHED_COLUMNS = [
    "BAN_ID", "CODE_INSEE", "ID_FANTOIR", *POSITION_COLUMNS, "TYPE_POSITION", "SOURCE_POSITION",
    "PARCELLES_CADASTRALES", "LIBELLE_ACHEMINEMENT", "NOM_AFNOR", "PRECISION_SCORE",
    "QUALITY_SCORE", "MATCH_KEY_EXACT", "MATCH_KEY_SANS_TYPE", "MATCH_KEY_VOIE",
    "MATCH_KEY_CODE_POSTAL",
]


def normalised_address(sales: DataFrame, *others: str | Column) -> DataFrame:
    """The six address components in their normalised form, with further columns."""
    return sales.select(
        text.norm_upper("NO_VOIE").alias("NO_VOIE"),
        text.norm_upper("TYPE_DE_VOIE").alias("TYPE_DE_VOIE"),
        text.norm_text("VOIE").alias("VOIE"),
        text.norm_code("CODE_POSTAL").alias("CODE_POSTAL"),
        text.norm_text("COMMUNE").alias("COMMUNE"),
        text.norm_code("CODE_DEPARTEMENT").alias("CODE_DEPARTEMENT"),
        *others,
    )


def geocodable(sales: DataFrame) -> DataFrame:
    return sales.dropna(subset=["CODE_POSTAL", "COMMUNE"])


def unique_addresses(staged: DataFrame) -> DataFrame:
    """Distinct normalised addresses of the sales that can be geocoded."""
    return distinct_blank_insensitive(normalised_address(geocodable(staged)), ADDRESS_COLUMNS)


def sale_match_keys() -> dict[str, Column]:
    """Match key per level on the sale side."""
    place = ("CODE_POSTAL", "COMMUNE")
    return {
        "EXACT": keys.sale_key_exact("NO_VOIE", "TYPE_DE_VOIE", "VOIE", *place),
        "SANS_TYPE": keys.sale_key_untyped("NO_VOIE", "VOIE", *place),
        "VOIE_SEULE": keys.sale_key_street("TYPE_DE_VOIE", "VOIE", *place),
        "CODE_POSTAL": keys.key_postcode(*place),
    }


def payload_struct(level: str, **columns: Column | str) -> Column:
    """Match payload of one level; columns not given are NULL."""
    values = {
        **columns,
        "MATCH_LEVEL": F.lit(level),
        "MATCH_SCORE": F.lit(MATCH_SCORES[level]),
    }
    fields = []
    for name, dtype in PAYLOAD.items():
        value = values.get(name, F.lit(None))
        value = F.col(value) if isinstance(value, str) else value
        fields.append(value.cast(dtype).alias(name))
    return F.struct(*fields)


_OWN_COLUMNS = {
    c: c for c in PAYLOAD if c not in ("MATCH_LEVEL", "MATCH_SCORE", "BAN_QUALITY_SCORE")
}


def row_winners(register: DataFrame, key: str, level: str) -> DataFrame:
    """Best register row per match key, as ``(key, payload)``."""
    payload = payload_struct(level, **_OWN_COLUMNS, BAN_QUALITY_SCORE="QUALITY_SCORE")
    order = [-F.col("QUALITY_SCORE"), -F.col("PRECISION_SCORE"), F.col("BAN_ID")]
    return best_per_key(register.withColumnRenamed(key, "key"), "key", payload, order)


def exact_winners(register: DataFrame) -> DataFrame:
    return row_winners(register, "MATCH_KEY_EXACT", "EXACT")


def untyped_winners(register: DataFrame) -> DataFrame:
    return row_winners(register, "MATCH_KEY_SANS_TYPE", "SANS_TYPE")


def street_points(register: DataFrame) -> DataFrame:
    """Register points per street key, merged by identifier."""
    means = [F.avg(c).alias(c) for c in [*POSITION_COLUMNS, "QUALITY_SCORE"]]
    texts = ["SOURCE_POSITION", "PARCELLES_CADASTRALES", "LIBELLE_ACHEMINEMENT", "NOM_AFNOR"]
    return (
        register.withColumnRenamed("MATCH_KEY_VOIE", "key")
        .groupBy("key", "BAN_ID", "CODE_INSEE", "ID_FANTOIR")
        .agg(*means, *(F.max(c).alias(c) for c in texts))
    )


def street_winners(register: DataFrame) -> DataFrame:
    """The point of best mean quality per street key."""
    own = {c: c for c in _OWN_COLUMNS if c != "TYPE_POSITION"}
    payload = payload_struct(
        "VOIE_SEULE", **own, TYPE_POSITION=F.lit("STREET"), BAN_QUALITY_SCORE="QUALITY_SCORE"
    )
    order = [-F.col("QUALITY_SCORE"), *(F.col(c) for c in ("BAN_ID", "CODE_INSEE", "ID_FANTOIR"))]
    return best_per_key(street_points(register), "key", payload, order)


def area_centroids(register: DataFrame, key: list[str], level: str, position: str) -> DataFrame:
    """Mean position per area, as ``(*key, payload)``.

    Sums per (area, INSEE code, delivery label) come first: those groups need hash buffers only and
    shrink each map task to a few rows, so that no area is heavy afterwards, however hot.
    """
    measures = [*POSITION_COLUMNS, "QUALITY_SCORE"]
    labels = [c for c in ("CODE_INSEE", "LIBELLE_ACHEMINEMENT") if c not in key]
    parts = register.groupBy(*key, *labels).agg(
        *(F.sum(F.col(c).cast("double")).alias(f"{c}_sum") for c in measures),
        *(F.count(c).alias(f"{c}_n") for c in measures),
    )
    means = {c: F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0)) for c in measures}
    areas = parts.groupBy(*key).agg(
        *(m.alias(c) for c, m in means.items()), *(F.max(c).alias(c) for c in labels)
    )
    payload = payload_struct(
        level,
        **{c: c for c in [*POSITION_COLUMNS, "CODE_INSEE", "LIBELLE_ACHEMINEMENT"]},
        TYPE_POSITION=F.lit(position),
        SOURCE_POSITION=F.lit("COMPUTED_CENTROID"),
        BAN_QUALITY_SCORE="QUALITY_SCORE",
    )
    return areas.select(*key, payload.alias("payload"))


def postcode_centroids(register: DataFrame) -> DataFrame:
    keyed = register.withColumnRenamed("MATCH_KEY_CODE_POSTAL", "key")
    return area_centroids(keyed, ["key"], "CODE_POSTAL", "LOCALITY")


def commune_centroids(register: DataFrame) -> DataFrame:
    """Level COMMUNE: one row per postcode, commune and INSEE code.

    Its join condition (equal postcode and commune) implies an equal postcode key, so whatever it
    could match has been matched one level up. The cascade therefore has no join for it.
    """
    key = ["CODE_POSTAL", "NOM_COMMUNE", "CODE_INSEE"]
    return area_centroids(register, key, "COMMUNE", "MUNICIPALITY")


# Register reduced to one row per key, as ``(key, payload)``, and its key column, by match level.
LEVEL_SIDES = {
    "EXACT": exact_winners,
    "SANS_TYPE": untyped_winners,
    "VOIE_SEULE": street_winners,
    "CODE_POSTAL": postcode_centroids,
}
LEVEL_KEYS = {
    "EXACT": "MATCH_KEY_EXACT",
    "SANS_TYPE": "MATCH_KEY_SANS_TYPE",
    "VOIE_SEULE": "MATCH_KEY_VOIE",
    "CODE_POSTAL": "MATCH_KEY_CODE_POSTAL",
}


def identified_addresses(staged: DataFrame) -> DataFrame:
    addresses = unique_addresses(staged)
    return addresses.select(keys.address_id(*ADDRESS_COLUMNS).alias("ADDRESS_ID"), "*")


def match_level(addresses: DataFrame, side: DataFrame, level: str) -> DataFrame:
    """Addresses that hit at one level, with their payload."""
    hits = addresses.withColumn("key", sale_match_keys()[level]).join(side, "key")
    return hits.select(*addresses.columns, "payload.*")


def match_commune(addresses: DataFrame, register: DataFrame) -> DataFrame:
    """Addresses joined to the centroids of their postcode, commune and INSEE code."""
    areas = commune_centroids(register).select(
        "CODE_POSTAL", F.col("NOM_COMMUNE").alias("COMMUNE"), "payload"
    )
    hits = addresses.join(areas, ["CODE_POSTAL", "COMMUNE"])
    return hits.select(*addresses.columns, "payload.*")


def unmatched(addresses: DataFrame, *matches: DataFrame) -> DataFrame:
    """Addresses that none of the given levels matched."""
    rest = addresses
    for matched in matches:
        rest = rest.join(matched.select("ADDRESS_ID"), "ADDRESS_ID", "left_anti")
    return rest.select(*addresses.columns)


def matches_by_level(staged: DataFrame, register: DataFrame) -> dict[str, DataFrame]:
    """The levels one by one, each over the addresses that the better levels left.

    For looking at single levels; :func:`dim_address_enriched` gets the same in one pass.
    """
    addresses = identified_addresses(staged)
    found: dict[str, DataFrame] = {}
    for level, side in LEVEL_SIDES.items():
        found[level] = match_level(unmatched(addresses, *found.values()), side(register), level)
    found["COMMUNE"] = match_commune(unmatched(addresses, *found.values()), register)
    rest = unmatched(addresses, *found.values())
    found["NO_MATCH"] = rest.select("*", payload_struct("NO_MATCH").alias("p")).select(
        *addresses.columns, "p.*"
    )
    return found


def geocoded(addresses: DataFrame, register: DataFrame) -> DataFrame:
    """The six components of unique addresses, with the payload of their best register match.

    Every level reads the register, and normalising its text costs far more than reading it back: a
    plan that still has to do so is best written first. A level works on the addresses that the
    better levels left: found ones leave the flow with their payload, the rest is written, so that
    the next level's join is planned by its real size. The scan of the register drops the rows whose key
    no address left asks for; what remains is shuffled once by the key that the winner and the join need,
    for streets and postcodes after their points were merged by finer keys.
    """
    rest = written(addresses, "addresses", even=True)
    found = []
    for level, key in sale_match_keys().items():
        n_left = rest.count()
        if not n_left:
            break
        keyed = rest.withColumn("key", key)
        asked = having_keys(register, LEVEL_KEYS[level], keyed, "key", n_left)
        joined = lookup_left(keyed, LEVEL_SIDES[level](asked), "key").select(*ADDRESS_COLUMNS, "payload")
        if level == list(LEVEL_SIDES)[-1]:
            rest = joined
            break
        joined = written(joined, level, even=True)
        found.append(joined.where(F.col("payload").isNotNull()))
        rest = joined.where(F.col("payload").isNull()).select(*ADDRESS_COLUMNS)
    if "payload" not in rest.columns:
        rest = rest.withColumn("payload", F.lit(None).cast(payload_type()))
    matched = rest.withColumn("payload", F.coalesce("payload", payload_struct("NO_MATCH")))
    for part in found:
        matched = matched.unionByName(part)
    return matched


def payload_type() -> str:
    return f"struct<{','.join(f'{name}:{kind}' for name, kind in PAYLOAD.items())}>"


def enriched(matched: DataFrame) -> DataFrame:
    """The enriched address dimension of addresses with their payload."""
    return matched.select(
        keys.address_id(*ADDRESS_COLUMNS).alias("ADDRESS_ID"),
        "payload.BAN_ID",
        *ADDRESS_COLUMNS,
        text.address_label_full(*ADDRESS_COLUMNS[:5]).alias("ADDRESS_FULL"),
        *(f"payload.{c}" for c in PAYLOAD if c != "BAN_ID"),
    )


def dim_address_enriched(staged: DataFrame, register: DataFrame) -> DataFrame:
    """Distinct sale addresses with their best register match.

    The normalised register is written once, without the columns no level needs.
    """
    stored = written(register.select(*MATCHED_COLUMNS), "register", even=True)
    return enriched(geocoded(unique_addresses(staged), stored))
