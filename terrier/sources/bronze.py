"""Raw sales and raw address register: all-text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the two raw sources.
SALES_COLUMNS = (
    "DATE_MUTATION", "NATURE_MUTATION", "VALEUR_FONCIERE", "NO_VOIE", "BTQ", "TYPE_DE_VOIE",
    "CODE_VOIE", "CODE_POSTAL", "COMMUNE", "VOIE", "CODE_DEPARTEMENT", "PREFIXE_DE_SECTION",
    "SECTION", "NO_PLAN", "NO_VOLUME", "TYPE_LOCAL", "SURFACE_REELLE_BATI",
    "NOMBRE_PIECES_PRINCIPALES", "NATURE_CULTURE", "SURFACE_TERRAIN",
)
REGISTER_COLUMNS = (
    "id", "id_fantoir", "numero", "rep", "nom_voie", "code_postal", "code_insee", "nom_commune",
    "code_insee_ancienne_commune", "nom_ancienne_commune", "x", "y", "lon", "lat",
    "type_position", "alias", "nom_ld", "libelle_acheminement", "nom_afnor", "source_position",
    "source_nom_voie", "certification_commune", "cad_parcelles", "departement",
)


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


SALES_SCHEMA = text_schema(SALES_COLUMNS)
REGISTER_SCHEMA = text_schema(REGISTER_COLUMNS)


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    fmt: str = "parquet",
    sep: str = ",",
    encoding: str = "UTF-8",
    null_text: str = "",
) -> DataFrame:
    """Read a raw source with its fixed all-text schema; nothing is inferred."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.csv(
            path, header=True, sep=sep, encoding=encoding, enforceSchema=False,
            quote='"', escape='"', mode="FAILFAST", nullValue=null_text,
        )
    return reader.format(fmt).load(path)


# The benchmark tables hold neither source. These statements derive both from them and are valid in
# Spark SQL and in ANSI dialects alike; braces mark the input tables.
DERIVED_SALES_SQL = """
SELECT
 lpad(cast(extract(day FROM o_orderdate) AS string),2,'0') || '/' || lpad(cast(extract(month FROM o_orderdate) AS string),2,'0') || '/' || cast(extract(year FROM o_orderdate) AS string) AS DATE_MUTATION,
 CASE WHEN o_orderstatus = 'P' THEN 'Echange' ELSE 'Vente' END AS NATURE_MUTATION,
 CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE replace(cast(cast(l_extendedprice AS decimal(18,2)) AS string),'.',',') END AS VALEUR_FONCIERE,
 CASE WHEN c_custkey % 11 = 10 THEN NULL ELSE ' ' || cast(c_custkey % 97 + 1 AS string) END AS NO_VOIE,
 CASE WHEN c_custkey % 13 = 0 THEN 'B' END AS BTQ,
 CASE WHEN c_custkey % 6 = 4 THEN NULL WHEN c_custkey % 2 = 0 THEN 'rue' WHEN c_custkey % 6 = 5 THEN 'AV' ELSE 'AVENUE' END AS TYPE_DE_VOIE,
 lpad(cast(c_custkey % 18 AS string),4,'0') AS CODE_VOIE,
 lpad(cast((n_nationkey + 1) * 1000 + (c_custkey % 9) * 10 AS string),5,'0') AS CODE_POSTAL,
 'Ville  ' || n_name || ' ' || cast(c_custkey % 3 AS string) AS COMMUNE,
 'de  ' || lower(n_name) AS VOIE,
 lpad(cast(n_nationkey + 1 AS string),2,'0') AS CODE_DEPARTEMENT,
 CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE lpad(cast(l_suppkey % 7 AS string),3,'0') END AS PREFIXE_DE_SECTION,
 CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 'a' || cast(l_partkey % 8 AS string) END AS SECTION,
 cast(l_suppkey AS string) AS NO_PLAN,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN '' ELSE ' 1' END AS NO_VOLUME,
 CASE l_partkey % 5 WHEN 0 THEN 'Maison' WHEN 1 THEN 'Appartement' WHEN 2 THEN ' Dépendance' WHEN 3 THEN 'Local industriel. commercial. ou assimilé' END AS TYPE_LOCAL,
 CASE l_partkey % 10 WHEN 4 THEN NULL WHEN 9 THEN '0' ELSE cast(cast(l_quantity AS int) AS string) END AS SURFACE_REELLE_BATI,
 CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE cast(l_linenumber AS string) END AS NOMBRE_PIECES_PRINCIPALES,
 CASE WHEN l_partkey % 3 = 0 THEN 'S' END AS NATURE_CULTURE,
 CASE WHEN l_partkey % 3 = 0 THEN cast(l_orderkey % 900 AS string) END AS SURFACE_TERRAIN
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

DERIVED_REGISTER_SQL = """
SELECT 'ban_' || cast(c_custkey AS string) || CASE WHEN v = 1 THEN '' ELSE 'b' END AS id,
 lpad(cast(n_nationkey AS string),5,'0') || '_' || lpad(cast(c_custkey % 18 AS string),4,'0') AS id_fantoir,
 cast(c_custkey % 97 + 1 AS string) AS numero,
 CASE WHEN c_custkey % 13 = 0 THEN 'bis' END AS rep,
 CASE WHEN c_custkey % 2 = 0 THEN 'Rue ' ELSE 'Avenue ' END || ' de ' || lower(n_name) AS nom_voie,
 CASE WHEN c_custkey % 41 = 40 THEN NULL ELSE lpad(cast((n_nationkey + 1) * 1000 + (c_custkey % 9) * 10 AS string),5,'0') END AS code_postal,
 lpad(cast(n_nationkey + 1 AS string),2,'0') || lpad(cast(c_custkey % 3 AS string),3,'0') AS code_insee,
 'Ville ' || n_name || ' ' || cast(c_custkey % 3 AS string) AS nom_commune,
 cast(NULL AS string) AS code_insee_ancienne_commune, '' AS nom_ancienne_commune,
 cast(600000 + c_custkey AS string) || ',5' AS x, cast(6800000 + n_nationkey * 100 AS string) AS y,
 CASE WHEN c_custkey % 37 = 36 THEN 'inconnu' ELSE replace(cast(cast(-1.0 + n_nationkey * 0.25 + (c_custkey % 100) * 0.001 AS decimal(9,4)) AS string),'.',',') END AS lon,
 CASE WHEN n_nationkey = 8 THEN '16.2650' ELSE cast(cast(43.0 + n_nationkey * 0.2 + (c_custkey % 50) * 0.002 AS decimal(9,4)) AS string) END AS lat,
 CASE WHEN v = 2 THEN 'interpolation' ELSE CASE c_custkey % 6 WHEN 0 THEN 'street' WHEN 1 THEN 'locality' WHEN 2 THEN 'municipality' WHEN 3 THEN 'entrance' ELSE 'housenumber' END END AS type_position,
 '0' AS alias, '' AS nom_ld, 'ville ' || lower(n_name) AS libelle_acheminement, 'DE ' || n_name AS nom_afnor,
 CASE WHEN v = 1 THEN 'commune' ELSE 'ign' END AS source_position, 'commune' AS source_nom_voie,
 cast(c_custkey % 2 AS string) AS certification_commune,
 'A' || cast(c_custkey % 8 AS string) || lpad(cast(c_custkey % 1000 AS string),4,'0') AS cad_parcelles,
 lpad(cast(n_nationkey + 1 AS string),2,'0') AS departement
FROM (SELECT c_custkey, c_nationkey, 1 AS v FROM {customer}
      UNION ALL SELECT c_custkey, c_nationkey, 2 AS v FROM {customer} WHERE c_custkey % 7 = 0) copies
JOIN {nation} ON c_nationkey = n_nationkey
WHERE n_nationkey % 10 <> 9 AND c_custkey % 5 <> 4
"""


def _tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def derived_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``DERIVED_SALES_SQL``, by another order of its joins.

    Orders find their customer first, so that lines, the largest table, are dealt once and while they are
    numbers. Dealing them in any case also frees the result from the row groups of the files: the far wider
    text rows need no shuffle of their own.
    """
    lineitem, orders, customer, nation = _tables(
        spark, folder, "lineitem", "orders", "customer", "nation").values()
    used = [c for c in lineitem.columns if c in DERIVED_SALES_SQL]
    columns = DERIVED_SALES_SQL.partition("FROM {lineitem}")[0]
    return spark.sql(
        columns + "FROM {lines} JOIN {placed} ON l_orderkey = o_orderkey JOIN {nation} ON c_nationkey = n_nationkey",
        lines=lineitem.where("l_orderkey IS NOT NULL").select(*used).repartition("l_orderkey"),
        placed=orders.join(customer, F.col("o_custkey") == F.col("c_custkey")),
        nation=nation,
    )


def derived_register(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(DERIVED_REGISTER_SQL, **_tables(spark, folder, "customer", "nation"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` as text, absent ones as NULL."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *(
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast("string").alias(f.name)
            for f in schema
        )
    )
