"""Market analyses, distances and change tracking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from terrier.functions.keys import address_id
from terrier.operators import geo, history
from terrier.plans import dims, geocode, market
from terrier.registry import oracle_tables as o
from terrier.registry.core import as_double, register, rounded

_HALF, _VOLUME = "CAST(sum(VALEUR_FONCIERE) AS DOUBLE) AS volume_total", ("volume_total",)
_PRICE_MEDIAN = "median(CAST(VALEUR_FONCIERE AS DOUBLE)) AS prix_median"


def _fact(c):
    return c.gold.fct_mutation


register(
    "d_1_filters",
    lambda c: as_double(
        market.filter_sales(
            _fact(c), premises="MAISON", year=1997, quarter=2, min_price=30000, max_price=60000
        ).select("ADDRESS_ID", "DATE_MUTATION", "VALEUR_FONCIERE"),
        "VALEUR_FONCIERE",
    ),
    """SELECT ADDRESS_ID, DATE_MUTATION, CAST(VALEUR_FONCIERE AS DOUBLE) AS VALEUR_FONCIERE
    FROM fct_mutation JOIN dim_type_local USING (TYPE_LOCAL_ID) WHERE TYPE_LOCAL = 'MAISON'
    AND DATE_MUTATION BETWEEN DATE '1997-04-01' AND DATE '1997-06-30'
    AND fct_mutation.VALEUR_FONCIERE BETWEEN 30000 AND 60000""",
)
register(
    "d_2_zone_statistics",
    lambda c: rounded(
        as_double(market.zone_statistics(_fact(c), ["COMMUNE_ID"]), *_VOLUME), "surface_moyenne"
    ),
    f"""SELECT COMMUNE_ID, {_PRICE_MEDIAN}, count(*) AS nb_ventes,
    {o.r6('avg(CAST(SURFACE_REELLE_BATI AS DOUBLE))')} AS surface_moyenne, {_HALF}
    FROM fct_mutation GROUP BY COMMUNE_ID""",
)
register(
    "d_3_price_evolution",
    lambda c: market.price_evolution(_fact(c)),
    """SELECT CAST(date_trunc('quarter', DATE_MUTATION) AS DATE) AS periode, median(m2) AS prix_median_m2,
    count(*) AS nb_ventes FROM sales GROUP BY 1""",
)
_COMPARED = ("VILLE NATION_1 0", "VILLE NATION_4 2", "VILLE NATION_17 1")
register(
    "d_4_commune_comparator",
    lambda c: market.compare_communes(_fact(c), c.gold.dim_commune, _COMPARED),
    "SELECT ANNEE, "
    + ", ".join(f"median(m2) FILTER (COMMUNE = '{x}') AS \"{x}\"" for x in _COMPARED)
    + " FROM sales WHERE COMMUNE IN ('" + "', '".join(_COMPARED) + "') GROUP BY ANNEE",
)
_CELL = "CAST(floor(round({c}, 6) / CAST({step} AS DOUBLE)) AS BIGINT)"


def _cells_sql(step: float) -> str:
    lat, lon = (_CELL.format(c=c, step=step) for c in ("LATITUDE", "LONGITUDE"))
    return f"{lat} AS cell_lat, {lon} AS cell_lon"


register(
    "d_5_density_cells",
    lambda c: market.density_cells(_fact(c), 0.05),
    f"""SELECT {_cells_sql(0.05)}, count(*) AS nb_ventes FROM fct_mutation
    WHERE LATITUDE IS NOT NULL GROUP BY 1, 2""",
)
register(
    "d_6_price_bands",
    lambda c: as_double(market.price_bands(_fact(c), 5000), *_VOLUME),
    f"""SELECT CAST(floor(VALEUR_FONCIERE / 5000) AS BIGINT) AS band, count(*) AS nb_ventes, {_HALF}
    FROM fct_mutation GROUP BY 1""",
)
register(
    "d_7_moving_average",
    lambda c: rounded(market.moving_average(_fact(c), c.gold.dim_commune), "prix_m2_glissant"),
    f"""SELECT a.CODE_DEPARTEMENT, a.mois, any_value(a.n) AS nb_ventes, {o.r6('sum(b.s) / sum(b.n)')} AS prix_m2_glissant
    FROM (SELECT CODE_DEPARTEMENT, CAST(date_trunc('month', DATE_MUTATION) AS DATE) AS mois, count(*) AS n FROM sales GROUP BY ALL) a
    JOIN (SELECT CODE_DEPARTEMENT, CAST(date_trunc('month', DATE_MUTATION) AS DATE) AS mois, count(*) AS n, sum(m2) AS s FROM sales GROUP BY ALL) b
      ON a.CODE_DEPARTEMENT = b.CODE_DEPARTEMENT AND b.mois <= a.mois AND b.mois > a.mois - INTERVAL 12 MONTH
    GROUP BY a.CODE_DEPARTEMENT, a.mois""",
)
register(
    "d_8_yearly_change",
    lambda c: rounded(
        market.yearly_change(c.gold.gold_kpi_departement, ["CODE_DEPARTEMENT"]), "evolution_pct"
    ),
    f"""SELECT a.CODE_DEPARTEMENT, a.ANNEE, a.PRIX_MEDIAN_M2,
    {o.r6('100 * (a.PRIX_MEDIAN_M2 / b.PRIX_MEDIAN_M2 - 1)')} AS evolution_pct
    FROM gold_kpi_departement a LEFT JOIN gold_kpi_departement b
    ON a.CODE_DEPARTEMENT = b.CODE_DEPARTEMENT AND a.ANNEE = b.ANNEE + 1""",
)
register(
    "d_9_dwelling_size",
    lambda c: rounded(market.price_by_size(_fact(c)), "prix_piece_moyen"),
    f"""SELECT CASE WHEN NOMBRE_PIECES_PRINCIPALES >= 5 THEN 'T5+' WHEN NOMBRE_PIECES_PRINCIPALES >= 1
      THEN 'T' || NOMBRE_PIECES_PRINCIPALES END AS typologie, count(*) AS nb_ventes,
    {o.r6('avg(CAST(VALEUR_FONCIERE AS DOUBLE) / NOMBRE_PIECES_PRINCIPALES)')} AS prix_piece_moyen
    FROM fct_mutation GROUP BY 1""",
)
register(
    "d_10_land_price",
    lambda c: rounded(market.land_price(_fact(c)), "prix_m2_terrain"),
    f"""SELECT CAST(year(DATE_MUTATION) AS INTEGER) AS ANNEE, count(*) AS nb_ventes,
    {o.r6('avg(CAST(VALEUR_FONCIERE AS DOUBLE) / CAST(SURFACE_TERRAIN AS DOUBLE))')} AS prix_m2_terrain
    FROM fct_mutation WHERE SURFACE_TERRAIN > 0 GROUP BY 1""",
)
register(
    "d_11_price_outliers",
    lambda c: rounded(
        market.price_outliers(_fact(c), ["TYPE_LOCAL_ID", "ANNEE"]).select(
            "ADDRESS_ID", "DATE_MUTATION", "PRIX_M2", "borne_haute"
        ),
        "borne_haute",
    ),
    f"""SELECT ADDRESS_ID, DATE_MUTATION, m2 AS PRIX_M2, {o.r6('q3 + 1.5 * (q3 - q1)')} AS borne_haute
    FROM sales JOIN (SELECT TYPE_LOCAL_ID, ANNEE, quantile_cont(m2, 0.25) AS q1, quantile_cont(m2, 0.75) AS q3
      FROM sales GROUP BY ALL) q USING (TYPE_LOCAL_ID, ANNEE)
    WHERE m2 < q1 - 1.5 * (q3 - q1) OR m2 > q3 + 1.5 * (q3 - q1)""",
)
PARIS = (48.8566, 2.3522)
_HAVERSINE = """2 * 6371000.0 * asin(sqrt(
    power(sin(radians({lat} - LATITUDE) / 2), 2)
    + cos(radians(LATITUDE)) * cos(radians({lat})) * power(sin(radians({lon} - LONGITUDE) / 2), 2)))"""


def _metre(c: str) -> str:
    return f"round({c}, 3)"


register(
    "d_12_great_circle_distance",
    lambda c: geo.distance_to(c.gold.dim_address_enriched, *PARIS, "distance_m").select(
        "ADDRESS_ID", F.round("distance_m", 3).alias("distance_m")
    ),
    f"""SELECT ADDRESS_ID, {_metre(_HAVERSINE.format(lat=PARIS[0], lon=PARIS[1]))} AS distance_m
    FROM dim_address_enriched WHERE LATITUDE IS NOT NULL""",
)
register(
    "d_13_radius_search",
    lambda c: geo.within_radius(c.gold.dim_address_enriched, 600700.0, 6800900.0, 650.0).select(
        "ADDRESS_ID", F.round("DISTANCE_M", 3).alias("distance_m")
    ),
    f"""SELECT ADDRESS_ID, {_metre('d')} AS distance_m FROM (SELECT ADDRESS_ID,
      sqrt(power(X_LAMBERT93 - 600700, 2) + power(Y_LAMBERT93 - 6800900, 2)) AS d
      FROM dim_address_enriched) t WHERE d <= 650""",
)


def _near(c):
    """Sales around the register's town positions."""
    sites = c.lazy.stg_ban_addresses_normalized.where(F.col("TYPE_POSITION") == "MUNICIPALITY")
    sold = _fact(c).groupBy("ADDRESS_ID").agg(F.count(F.lit(1)).alias("ventes"))
    places = c.gold.dim_address_enriched.select("ADDRESS_ID", "X_LAMBERT93", "Y_LAMBERT93")
    near = geo.sales_near(sites, places.join(sold, "ADDRESS_ID"), "BAN_ID", "ventes", 150.0)
    return near.withColumn("nearest_m", F.round("nearest_m", 3))


register(
    "d_14_sales_near_sites",
    _near,
    f"""SELECT BAN_ID, CAST(sum(ventes) AS BIGINT) AS nb_near, {_metre('min(d)')} AS nearest_m
    FROM (SELECT s.BAN_ID, p.ventes,
        sqrt(power(s.X_LAMBERT93 - p.X_LAMBERT93, 2) + power(s.Y_LAMBERT93 - p.Y_LAMBERT93, 2)) AS d
      FROM ban s, (SELECT X_LAMBERT93, Y_LAMBERT93, count(*) AS ventes FROM fct_mutation
        JOIN dim_address_enriched USING (ADDRESS_ID) WHERE X_LAMBERT93 IS NOT NULL GROUP BY ALL) p
      WHERE s.TYPE_POSITION = 'MUNICIPALITY') x
    WHERE d <= 150 GROUP BY BAN_ID""",
)
register(
    "d_15_price_hotspots",
    lambda c: rounded(market.price_hotspots(_fact(c), 0.1, 50, 2400.0), "prix_m2_moyen"),
    f"""SELECT {_cells_sql(0.1)}, count(*) AS nb_ventes, {o.r6('avg(m2)')} AS prix_m2_moyen
    FROM sales WHERE LATITUDE IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 50 AND avg(m2) >= 2400""",
)
register(
    "d_16_score_weighted_price",
    lambda c: rounded(market.score_weighted_price(_fact(c)), "prix_m2_pondere"),
    f"""SELECT ANNEE, CAST(sum(GEOCODING_MATCH_SCORE) AS BIGINT) AS poids,
    {o.r6('sum(m2 * GEOCODING_MATCH_SCORE) / sum(GEOCODING_MATCH_SCORE)')} AS prix_m2_pondere
    FROM sales GROUP BY ANNEE""",
)
register(
    "d_17_parcel_crossing",
    lambda c: market.parcels_of_addresses(
        c.gold.dim_address_enriched,
        c.gold.dim_parcelle,
        # Section and plan: the register ends its codes with both, the plan in four digits.
        register_key=lambda code: F.regexp_extract(code, r"([0-9A-Z]{2}\d{4,})$", 1),
        parcel_key=lambda _: F.concat(
            "SECTION", F.lpad("NO_PLAN", F.greatest(F.lit(4), F.length("NO_PLAN")), F.lit("0"))
        ),
    ),
    """SELECT ADDRESS_ID, parcelle_ban, coalesce(n, 0) AS nb_parcelles_vente
    FROM (SELECT ADDRESS_ID, trim(unnest(string_split(replace(PARCELLES_CADASTRALES, ',', '|'), '|'))) AS parcelle_ban
      FROM dim_address_enriched) a
    LEFT JOIN (SELECT SECTION || repeat('0', 4 - length(NO_PLAN)) || NO_PLAN AS code, count(*) AS n
      FROM dim_parcelle GROUP BY 1) p ON code = parcelle_ban""",
)
_POSITIONS = ("LONGITUDE", "LATITUDE", "X_LAMBERT93", "Y_LAMBERT93")
register(
    "d_18_street_centroid",
    lambda c: rounded(market.street_centroids(c.lazy.stg_ban_addresses_normalized), *_POSITIONS),
    "SELECT MATCH_KEY_VOIE AS CLE_VOIE, count(*) AS nb_points, "
    + ", ".join(f"{o.r6(f'avg({x})')} AS {x}" for x in _POSITIONS)
    + " FROM ban GROUP BY MATCH_KEY_VOIE",
)

# The sales known at an earlier load, for comparing two loads, and when that load ran.
CUT = dt.date(1996, 1, 1)
LAST_RUN = dt.datetime(2020, 1, 1)

register(
    "d_19_new_rows",
    lambda c: history.new_rows(
        history.loaded_since(c.gold.dim_address, LAST_RUN).select("ADDRESS_ID", "ADDRESS"),
        dims.dim_address(c.lazy.stg_dvf_transactions.where(F.col("DATE_MUTATION") < F.lit(CUT))),
        ["ADDRESS_ID"],
    ),
    f"""SELECT ADDRESS_ID, ADDRESS FROM dim_address WHERE ADDRESS_ID NOT IN (
      SELECT {o.hexkey(o.bar(*geocode.ADDRESS_COLUMNS))}
      FROM (SELECT {o._NORMALISED} FROM stg WHERE DATE_MUTATION < DATE '{CUT}') n)""",
)

# Sales are published for the last five years: two loads, a year apart.
LOADS = (dt.date(1997, 1, 1), dt.date(1998, 1, 1))


def _published(c, on: dt.date):
    """Addresses of a full load: last sale and number of sales in the five years before."""
    staged = c.lazy.stg_dvf_transactions
    window = staged.where(
        (F.col("DATE_MUTATION") >= F.lit(on.replace(year=on.year - 5))) & (F.col("DATE_MUTATION") < F.lit(on))
    )
    sold = geocode.normalised_address(window, "DATE_MUTATION")
    return sold.groupBy(address_id(*geocode.ADDRESS_COLUMNS).alias("ADDRESS_ID")).agg(
        F.max("DATE_MUTATION").alias("DERNIERE_VENTE"), F.count(F.lit(1)).alias("NB_VENTES")
    )


def address_history(c):
    """Addresses over two loads: new ones open, those without a sale left close, others may change."""
    first = history.start_history(_published(c, LOADS[0]), LOADS[0])
    return history.merge_history(
        first, _published(c, LOADS[1]), ["ADDRESS_ID"], ["DERNIERE_VENTE", "NB_VENTES"], LOADS[1]
    )


def _published_sql(on: dt.date) -> str:
    return f"""SELECT {o.hexkey(o.bar(*geocode.ADDRESS_COLUMNS))} AS ADDRESS_ID,
    max(DATE_MUTATION) AS DERNIERE_VENTE, count(*) AS NB_VENTES
    FROM (SELECT {o._NORMALISED}, DATE_MUTATION FROM stg
      WHERE DATE_MUTATION >= DATE '{on}' - INTERVAL 5 YEAR AND DATE_MUTATION < DATE '{on}') n GROUP BY 1"""


_CHANGED = "(a.DERNIERE_VENTE <> b.DERNIERE_VENTE OR a.NB_VENTES <> b.NB_VENTES)"
VERSIONS_SQL = f"""SELECT a.*, DATE '{LOADS[0]}' AS VALID_FROM,
      CASE WHEN b.ADDRESS_ID IS NULL OR {_CHANGED} THEN DATE '{LOADS[1]}' END AS VALID_TO, VALID_TO IS NULL AS IS_CURRENT
    FROM ({_published_sql(LOADS[0])}) a LEFT JOIN ({_published_sql(LOADS[1])}) b USING (ADDRESS_ID)
    UNION ALL SELECT b.*, DATE '{LOADS[1]}', CAST(NULL AS DATE), true
    FROM ({_published_sql(LOADS[1])}) b LEFT JOIN ({_published_sql(LOADS[0])}) a USING (ADDRESS_ID)
    WHERE a.ADDRESS_ID IS NULL OR {_CHANGED}"""
register("d_20_history", address_history, VERSIONS_SQL)
