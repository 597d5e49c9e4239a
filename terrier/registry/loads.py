"""Loads that change stored tables, files with bad rows, reading a history, layouts of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrier.operators import checks, geo, morton
from terrier.operators.asof import as_of
from terrier.registry.core import as_double, register, register_like, rounded
from terrier.registry.derived import VERSIONS_SQL, address_history
from terrier.registry.results import _AMOUNTS, _AMOUNTS_SQL, _CENTROID, _MEANS, _rounded_sql
from terrier.session import even_tasks, scratch_path
from terrier.sources.bronze import SALES_COLUMNS
from terrier.sources.buckets import store_bucketed
from terrier.sources.loads import load_csv

# ---------------------------------------------------------------- years loaded one after the other

register(
    "snk_2_incremental_load",
    lambda c: as_double(
        rounded(c.loaded_by_year.fct_mutation.drop("ANNEE"), "LONGITUDE", "LATITUDE"), *_AMOUNTS),
    f"SELECT * REPLACE ({_AMOUNTS_SQL}, {_rounded_sql('LONGITUDE', 'LATITUDE')}) FROM fct_mutation",
)
register(
    "jn_8_incremental_geocoding",
    lambda c: rounded(c.loaded_by_year.dim_address_enriched, *_MEANS),
    f"SELECT * REPLACE ({_rounded_sql(*_MEANS)}) FROM dim_address_enriched",
)
register(
    "kpi_1_incremental",
    lambda c: c.loaded_by_year.indicators()["gold_kpi_france"],
    "SELECT * FROM gold_kpi_france",
)
for _key, _name in (
    ("kpi_2_incremental", "gold_kpi_departement"),
    ("kpi_3_incremental", "gold_kpi_commune"),
    ("kpi_4_incremental", "gold_kpi_code_postal"),
):
    register(
        _key,
        lambda c, name=_name: rounded(c.loaded_by_year.indicators()[name], *_CENTROID),
        f"SELECT * REPLACE ({_rounded_sql(*_CENTROID)}) FROM {_name}",
    )

# ---------------------------------------------------------------- files with bad rows

# Faults put into the raw lines, by a condition on the line that both dialects read.
SHORT_LINE = "TYPE_LOCAL = 'Maison' AND NO_VOLUME = ' 1'"
BAD_DATE = "NATURE_MUTATION = 'Echange'"
BAD_AMOUNT = "SECTION IS NULL"
NO_DEPARTEMENT = "CODE_VOIE = '0017'"


def _bad_rows(c):
    """Raw lines with faults, loaded twice: what the tables hold afterwards, by reason and partition."""
    source, target, rejected = (scratch_path(c.spark, name) for name in ("lines", "loaded", "rejected"))
    spoiled = {
        "DATE_MUTATION": F.when(F.expr(BAD_DATE), F.concat(F.lit("31/02/"), F.substring("DATE_MUTATION", 7, 4))),
        "VALEUR_FONCIERE": F.when(F.expr(BAD_AMOUNT), F.lit("n.c.")),
        "CODE_DEPARTEMENT": F.when(F.expr(NO_DEPARTEMENT), F.lit("")),
    }
    columns = [F.coalesce(spoiled[x], F.col(x)).alias(x) if x in spoiled else F.col(x) for x in SALES_COLUMNS]
    line = F.to_csv(F.struct(*columns), {"sep": ";", "ignoreLeadingWhiteSpace": "false"})
    lines = c.bronze_dvf.select(
        F.when(F.expr(SHORT_LINE), F.substring_index(line, ";", 3)).otherwise(line).alias("value"))
    with even_tasks(c.spark):  # a compressed file is parsed by one task
        lines.write.option("zlib.compress.level", "BEST_SPEED").text(source, compression="gzip")
    for _ in range(2):
        load = load_csv(c.spark, source, target, rejected, sep=";", header=False)
    good = load.accepted.read().groupBy("annee", "departement").agg(F.count(F.lit(1)).alias("n"))
    bad = load.rejected.read().groupBy("MOTIF").agg(F.count(F.lit(1)).alias("n"))
    return good.select(F.lit("OK").alias("motif"), "annee", "departement", "n").unionByName(
        bad.select(F.col("MOTIF").alias("motif"), F.lit(None).cast("string").alias("annee"),
                   F.lit(None).cast("string").alias("departement"), "n"))


register(
    "src_4_bad_rows",
    _bad_rows,
    f"""SELECT motif, CASE WHEN motif = 'OK' THEN substr(DATE_MUTATION, 7, 4) END AS annee,
      CASE WHEN motif = 'OK' THEN CODE_DEPARTEMENT END AS departement, count(*) AS n
    FROM (SELECT *, CASE WHEN {SHORT_LINE} THEN 'COLONNES' WHEN {BAD_DATE} THEN 'DATE'
      WHEN {BAD_AMOUNT} THEN 'MONTANT' WHEN {NO_DEPARTEMENT} THEN 'DEPARTEMENT' ELSE 'OK' END AS motif
      FROM bronze_dvf) GROUP BY ALL""",
)

# ---------------------------------------------------------------- reading a history

register(
    "d_20_as_of",
    lambda c: as_double(as_of(
        c.gold.fct_mutation.select("ADDRESS_ID", "DATE_MUTATION", "VALEUR_FONCIERE"),
        address_history(c), ["ADDRESS_ID"], "DATE_MUTATION", ["DERNIERE_VENTE", "NB_VENTES"]), "VALEUR_FONCIERE"),
    f"""SELECT f.ADDRESS_ID, f.DATE_MUTATION, CAST(f.VALEUR_FONCIERE AS DOUBLE) AS VALEUR_FONCIERE,
      CASE WHEN VALID_TO IS NULL OR f.DATE_MUTATION < VALID_TO THEN h.DERNIERE_VENTE END AS DERNIERE_VENTE,
      CASE WHEN VALID_TO IS NULL OR f.DATE_MUTATION < VALID_TO THEN h.NB_VENTES END AS NB_VENTES
    FROM fct_mutation f ASOF LEFT JOIN ({VERSIONS_SQL}) h
      ON f.ADDRESS_ID = h.ADDRESS_ID AND f.DATE_MUTATION >= h.VALID_FROM""",
)

# ---------------------------------------------------------------- layouts of stored tables

PLACE_STEP, PLACE_BITS = 50.0, 3


def _near_by_place(c):
    """The radius search over addresses stored in Morton order."""
    stored = morton.store_by_place(
        c.gold.dim_address_enriched, scratch_path(c.spark, "by-place"), PLACE_STEP, PLACE_BITS)
    x, y, radius = 600700.0, 6800900.0, 650.0
    box = morton.in_box(stored, x - radius, y - radius, x + radius, y + radius, PLACE_STEP, PLACE_BITS)
    return geo.within_radius(box, x, y, radius).select("ADDRESS_ID", F.round("DISTANCE_M", 3).alias("distance_m"))


register_like("d_13_by_place", _near_by_place, "d_13_radius_search")


def _missing_in_buckets(c):
    """Sales without a precisely matched address, both sides stored in buckets of the address key."""
    sales = c.gold.fct_mutation.select("ADDRESS_ID", "DATE_MUTATION", "ANNEE")
    places = c.gold.dim_address_enriched.select("ADDRESS_ID", "MATCH_LEVEL")
    stored = []
    for name, df, split in (("sales", sales, ["ANNEE"]), ("places", places, None)):
        path = scratch_path(c.spark, f"bucketed-{name}")
        table = "terrier_" + path.rsplit("/", 1)[1].replace("-", "_")
        stored.append(store_bucketed(df, table, path, "ADDRESS_ID", 8, split))
    precise = stored[1].where(F.col("MATCH_LEVEL").isin("EXACT", "SANS_TYPE"))
    return checks.relationships(stored[0], "ADDRESS_ID", precise, "ADDRESS_ID").select("ADDRESS_ID", "DATE_MUTATION")


register_like("chk_4_bucketed", _missing_in_buckets, "chk_4_relationships")
