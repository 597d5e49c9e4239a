"""The star schema in SQL, written independently of the DataFrame plans, for comparison.

Each table is a common table expression that names the ones it reads; :func:`oracle` puts together
what a query needs. The matching cascade is spelled out by brute force here: all candidates of all
levels, of which the best per address is kept.
"""

from __future__ import annotations

import re

from terrier.sources.bronze import DERIVED_REGISTER_SQL, DERIVED_SALES_SQL
from terrier.sources.seeds import departement_rows

# Fixed values, stated here a second time so that a wrong one in the engine shows up.
STREET_TYPES = (
    "RUE", "AVENUE", "AVE", "AV", "BOULEVARD", "BD", "PLACE", "PL", "CHEMIN", "CHE", "IMPASSE",
    "IMP", "ALLEE", "ALL", "ROUTE", "RTE", "QUAI", "SQUARE", "SQ", "PASSAGE", "VOIE", "COURS",
    "CRS", "MAIL", "ESPLANADE", "PROMENADE", "PARC", "VILLA", "COUR", "HAMEAU", "CITE",
    "RESIDENCE", "RES", "LOTISSEMENT", "LOT",
)
POSITION_SCORES = {"HOUSENUMBER": 100, "INTERPOLATION": 80, "STREET": 60, "LOCALITY": 40, "MUNICIPALITY": 20}
MATCH_SCORES = {
    "EXACT": 100, "SANS_TYPE": 90, "VOIE_SEULE": 70, "CODE_POSTAL": 50, "COMMUNE": 30, "NO_MATCH": 0,
}
POSITION_LABELS = {
    "HOUSENUMBER": "Numéro exact (précision < 10m)",
    "INTERPOLATION": "Numéro interpolé (précision ~10-50m)",
    "STREET": "Centroïde de rue (précision ~50-200m)",
    "LOCALITY": "Lieu-dit (précision ~200-500m)",
    "MUNICIPALITY": "Centroïde commune (précision > 500m)",
}

_PLAIN = {n: n for n in ("lineitem", "orders", "customer", "nation")}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def t(c: str) -> str:
    """Normalised text."""
    return rf"upper(regexp_replace(trim({c}), '\s+', ' ', 'g'))"


def u(c: str) -> str:
    return f"upper(trim({c}))"


def e(c: str) -> str:
    return f"coalesce({c}, '')"


MONEY, WHOLE = "DECIMAL(18,2)", "DECIMAL(38,0)"


def amount(c: str, cast: str = "CAST", kind: str = MONEY) -> str:
    return f"{cast}(replace({c}, ',', '.') AS {kind})"


def coord(c: str, kind: str = "DOUBLE") -> str:
    return f"CAST(TRY_CAST(replace({c}, ',', '.') AS {kind}) AS DOUBLE)"


def hexkey(text: str) -> str:
    return f"upper(substr(md5(coalesce({text}, '')), 1, 16))"


def longkey(text: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce({text}, '')), 1, 15) AS BIGINT)"


def bar(*parts: str) -> str:
    return " || '|' || ".join(e(p) for p in parts)


def untyped(c: str) -> str:
    return rf"regexp_replace({c}, '^({'|'.join(STREET_TYPES)})\s+', '')"


def score(c: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in POSITION_SCORES.items())
    return f"CASE {c} {cases} ELSE 10 END"


def position_label(c: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {_quote(v)}" for k, v in POSITION_LABELS.items())
    return f"CASE {c} {cases} ELSE 'Pas de coordonnées' END"


def pct(part: str, whole: str, factor: int = 100) -> str:
    """Percentage rounded half up to two places, in whole numbers."""
    n, d = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"(({n} * {200 * factor} + {d}) // (2 * {d})) / 100.0"


def r6(c: str) -> str:
    return f"round(CAST({c} AS DOUBLE) + 1e-9, 6)"


_SIX = ("NO_VOIE", "TYPE_DE_VOIE", "VOIE", "CODE_POSTAL", "COMMUNE", "CODE_DEPARTEMENT")
_STREET = (
    "CASE WHEN VOIE IS NULL THEN NULL WHEN TYPE_DE_VOIE IS NULL THEN VOIE "
    "ELSE TYPE_DE_VOIE || ' ' || VOIE END"
)
_NORMALISED = f"""{u('NO_VOIE')} AS NO_VOIE, {u('TYPE_DE_VOIE')} AS TYPE_DE_VOIE, {t('VOIE')} AS VOIE,
  trim(CODE_POSTAL) AS CODE_POSTAL, {t('COMMUNE')} AS COMMUNE, trim(CODE_DEPARTEMENT) AS CODE_DEPARTEMENT"""
_FIRST_OF_SIX = f"""row_number() OVER (
    PARTITION BY {', '.join(e(c) for c in _SIX)}
    ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in _SIX)}) = 1"""


def six(alias: str) -> str:
    return ", ".join(f"{alias}.{c}" for c in _SIX)


_WINNER = (
    "b.BAN_ID, b.CODE_INSEE, b.ID_FANTOIR, b.LONGITUDE, b.LATITUDE, b.X_LAMBERT93, b.Y_LAMBERT93, "
    "b.TYPE_POSITION, b.SOURCE_POSITION, b.PARCELLES_CADASTRALES, b.LIBELLE_ACHEMINEMENT, "
    "b.NOM_AFNOR, CAST(b.QUALITY_SCORE AS DOUBLE) AS q, b.PRECISION_SCORE AS p"
)
_MEANS = "avg(b.LONGITUDE), avg(b.LATITUDE), avg(b.X_LAMBERT93), avg(b.Y_LAMBERT93)"


def _area(level: int, position: str, key: str, insee: str, group: str) -> str:
    return f"""SELECT a.ADDRESS_ID, {level} AS lvl, NULL, {insee}, NULL, {_MEANS}, '{position}',
    'COMPUTED_CENTROID', NULL, max(b.LIBELLE_ACHEMINEMENT), NULL, avg(b.QUALITY_SCORE), 0
  FROM keyed a JOIN ban b ON {key} GROUP BY a.ADDRESS_ID{group}"""


def _kpi(group: str, extra: str = "", per_type_counts: bool = False) -> str:
    """Indicator columns over ``sales``."""
    out = [group, "median(m2) AS PRIX_MEDIAN_M2", "count(*) AS NB_VENTES"]
    for name, kind in (("APPARTEMENT", "APPARTEMENT"), ("MAISON", "MAISON")):
        out.append(f"median(m2) FILTER (TYPE_LOCAL = '{kind}') AS PRIX_MEDIAN_{name}")
        if per_type_counts:
            out.append(f"count(*) FILTER (TYPE_LOCAL = '{kind}') AS NB_VENTES_{name}")
    return ", ".join(out) + extra


_ZERO_CENTROID = (
    ", coalesce(avg(LATITUDE), 0.0) AS LATITUDE_CENTROID, "
    "coalesce(avg(LONGITUDE), 0.0) AS LONGITUDE_CENTROID, count(*) >= 5 AS HAS_SUFFICIENT_DATA"
)

def _staged(kind: str) -> str:
    return f"""SELECT * REPLACE (
    CAST(strptime(DATE_MUTATION, '%d/%m/%Y') AS DATE) AS DATE_MUTATION,
    {amount('VALEUR_FONCIERE', kind=kind)} AS VALEUR_FONCIERE,
    {amount('SURFACE_REELLE_BATI', kind=kind)} AS SURFACE_REELLE_BATI,
    {amount('SURFACE_TERRAIN', kind=kind)} AS SURFACE_TERRAIN)
  FROM bronze_dvf WHERE NATURE_MUTATION = 'Vente' AND {amount('VALEUR_FONCIERE', kind=kind)} > 20000"""


def _cleaned_register(kind: str) -> str:
    return f"""SELECT trim(id) AS ID, trim(id_fantoir) AS ID_FANTOIR, trim(numero) AS NUMERO,
    {u('rep')} AS REPETITION, {t('nom_voie')} AS NOM_VOIE, trim(code_postal) AS CODE_POSTAL,
    trim(code_insee) AS CODE_INSEE, {t('nom_commune')} AS NOM_COMMUNE,
    trim(code_insee_ancienne_commune) AS CODE_INSEE_ANCIENNE_COMMUNE,
    {t("nullif(nom_ancienne_commune, '')")} AS NOM_ANCIENNE_COMMUNE,
    {coord('x', kind)} AS X_LAMBERT93, {coord('y', kind)} AS Y_LAMBERT93,
    {coord('lon', kind)} AS LONGITUDE, {coord('lat', kind)} AS LATITUDE,
    {u('type_position')} AS TYPE_POSITION, alias AS ALIAS,
    {t("nullif(nom_ld, '')")} AS NOM_LIEU_DIT, {t('libelle_acheminement')} AS LIBELLE_ACHEMINEMENT,
    {t('nom_afnor')} AS NOM_AFNOR, {u('source_position')} AS SOURCE_POSITION,
    {u('source_nom_voie')} AS SOURCE_NOM_VOIE, trim(certification_commune) AS CERTIFICATION_COMMUNE,
    trim(cad_parcelles) AS PARCELLES_CADASTRALES, trim(departement) AS CODE_DEPARTEMENT
  FROM bronze_ban WHERE id IS NOT NULL AND code_postal IS NOT NULL AND code_insee IS NOT NULL"""


TABLES: dict[str, str] = {
    "bronze_dvf": DERIVED_SALES_SQL.format(**_PLAIN),
    "bronze_ban": DERIVED_REGISTER_SQL.format(**_PLAIN),
    "seed": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({_quote(c)}, {_quote(n)}, CAST({la} AS DOUBLE), CAST({lo} AS DOUBLE))"
        for c, n, la, lo in departement_rows()
    )
    + ") s(CODE_DEPARTEMENT, NOM_DEPARTEMENT, LATITUDE, LONGITUDE)",
    "stg": _staged(MONEY),
    "ban_all": _cleaned_register("DOUBLE"),
    "ban": f"""SELECT * RENAME (ID AS BAN_ID, NUMERO AS NUMERO_RAW, NOM_VOIE AS NOM_VOIE_RAW),
    NUMERO || coalesce(' ' || REPETITION, '') AS NUMERO_COMPLET,
    {untyped('NOM_VOIE')} AS NOM_VOIE_SANS_TYPE,
    {bar('NUMERO', 'REPETITION', 'NOM_VOIE', 'CODE_POSTAL', 'NOM_COMMUNE')} AS MATCH_KEY_EXACT,
    {bar('NUMERO', untyped('NOM_VOIE'), 'CODE_POSTAL', 'NOM_COMMUNE')} AS MATCH_KEY_SANS_TYPE,
    {bar('NOM_VOIE', 'CODE_POSTAL', 'NOM_COMMUNE')} AS MATCH_KEY_VOIE,
    {bar('CODE_POSTAL', 'NOM_COMMUNE')} AS MATCH_KEY_CODE_POSTAL,
    CODE_INSEE AS MATCH_KEY_COMMUNE,
    {score('TYPE_POSITION')} AS PRECISION_SCORE,
    CASE CERTIFICATION_COMMUNE WHEN '1' THEN 10 ELSE 0 END AS CERTIFICATION_SCORE,
    {score('TYPE_POSITION')} + CASE CERTIFICATION_COMMUNE WHEN '1' THEN 10 ELSE 0 END AS QUALITY_SCORE
  FROM ban_all
  WHERE LATITUDE >= 41.0 AND LATITUDE <= 51.5 AND LONGITUDE >= -5.5 AND LONGITUDE <= 10.0""",
    "dim_address": f"""SELECT {hexkey(bar(*_SIX))} AS ADDRESS_ID, *,
    concat_ws(' ', {e('NO_VOIE')}, {e('TYPE_DE_VOIE')}, {e('VOIE')}, {e('CODE_POSTAL')}, {e('COMMUNE')}) AS ADDRESS
  FROM (SELECT {_NORMALISED} FROM stg) n QUALIFY {_FIRST_OF_SIX}""",
    "keyed": f"""SELECT {hexkey(bar(*_SIX))} AS ADDRESS_ID, *,
    {bar('NO_VOIE', "''", _STREET, 'CODE_POSTAL', 'COMMUNE')} AS k1,
    {bar('NO_VOIE', 'VOIE', 'CODE_POSTAL', 'COMMUNE')} AS k2,
    {bar(_STREET, 'CODE_POSTAL', 'COMMUNE')} AS k3, {bar('CODE_POSTAL', 'COMMUNE')} AS k4
  FROM (SELECT {_NORMALISED} FROM stg WHERE CODE_POSTAL IS NOT NULL AND COMMUNE IS NOT NULL) n
  QUALIFY {_FIRST_OF_SIX}""",
    "candidates": f"""SELECT a.ADDRESS_ID, 1 AS lvl, {_WINNER} FROM keyed a JOIN ban b ON a.k1 = b.MATCH_KEY_EXACT
  UNION ALL SELECT a.ADDRESS_ID, 2, {_WINNER} FROM keyed a JOIN ban b ON a.k2 = b.MATCH_KEY_SANS_TYPE
  UNION ALL SELECT a.ADDRESS_ID, 3, b.BAN_ID, b.CODE_INSEE, b.ID_FANTOIR, {_MEANS}, 'STREET',
    max(b.SOURCE_POSITION), max(b.PARCELLES_CADASTRALES), max(b.LIBELLE_ACHEMINEMENT),
    max(b.NOM_AFNOR), avg(b.QUALITY_SCORE), 0
  FROM keyed a JOIN ban b ON a.k3 = b.MATCH_KEY_VOIE
  GROUP BY a.ADDRESS_ID, b.BAN_ID, b.CODE_INSEE, b.ID_FANTOIR
  UNION ALL {_area(4, 'LOCALITY', 'a.k4 = b.MATCH_KEY_CODE_POSTAL', 'max(b.CODE_INSEE)', '')}
  UNION ALL {_area(5, 'MUNICIPALITY', 'a.CODE_POSTAL = b.CODE_POSTAL AND a.COMMUNE = b.NOM_COMMUNE', 'b.CODE_INSEE', ', b.CODE_INSEE')}""",
    "levels": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{n}', {s})" for i, (n, s) in enumerate(MATCH_SCORES.items(), 1))
    + ") l(lvl, MATCH_LEVEL, MATCH_SCORE)",
    "matched": """SELECT a.* EXCLUDE (k1, k2, k3, k4), c.* EXCLUDE (ADDRESS_ID, lvl), l.*
  FROM keyed a LEFT JOIN (SELECT * FROM candidates
    QUALIFY row_number() OVER (PARTITION BY ADDRESS_ID ORDER BY lvl, q DESC, p DESC, BAN_ID) = 1) c
    USING (ADDRESS_ID)
  JOIN levels l ON l.lvl = coalesce(c.lvl, 6)""",
    "dim_address_enriched": f"""SELECT ADDRESS_ID, BAN_ID, {', '.join(_SIX)},
    concat({e('NO_VOIE')}, ' ', {e('TYPE_DE_VOIE')}, ' ', {e('VOIE')}, ', ', {e('CODE_POSTAL')}, ' ', {e('COMMUNE')}) AS ADDRESS_FULL,
    CODE_INSEE, ID_FANTOIR, LONGITUDE, LATITUDE, X_LAMBERT93, Y_LAMBERT93, MATCH_LEVEL, MATCH_SCORE,
    TYPE_POSITION, SOURCE_POSITION, q AS BAN_QUALITY_SCORE, PARCELLES_CADASTRALES,
    LIBELLE_ACHEMINEMENT, NOM_AFNOR FROM matched""",
    "dim_code_postal": f"""SELECT {hexkey(bar('CODE_POSTAL', 'CODE_DEPARTEMENT'))} AS CODE_POSTAL_ID,
    CODE_POSTAL, COMMUNE, CODE_DEPARTEMENT, VOIE
  FROM (SELECT {_NORMALISED} FROM stg WHERE CODE_POSTAL IS NOT NULL) n
  QUALIFY row_number() OVER (PARTITION BY CODE_POSTAL, CODE_DEPARTEMENT
    ORDER BY COMMUNE NULLS LAST, VOIE NULLS LAST) = 1""",
    "dim_commune": f"""SELECT {longkey("COMMUNE || '|' || CODE_DEPARTEMENT")} AS COMMUNE_ID, *
  FROM (SELECT DISTINCT {u('COMMUNE')} AS COMMUNE, trim(CODE_DEPARTEMENT) AS CODE_DEPARTEMENT FROM dim_address) d""",
    "parcels": f"""SELECT DISTINCT {u('PREFIXE_DE_SECTION')} AS PREFIXE_DE_SECTION, {u('SECTION')} AS SECTION,
    trim(NO_PLAN) AS NO_PLAN, trim({e('NO_VOLUME')}) AS vol FROM stg""",
    "dim_parcelle": f"""SELECT {longkey(bar('PREFIXE_DE_SECTION', 'SECTION', 'NO_PLAN', 'vol'))} AS PARCELLE_ID,
    PREFIXE_DE_SECTION, SECTION, NO_PLAN, nullif(vol, '') AS NO_VOLUME,
    CASE WHEN SECTION IS NULL OR NO_PLAN IS NULL THEN 1 ELSE 0 END AS IS_PARTIAL FROM parcels""",
    "dim_type_local": f"""SELECT {longkey('TYPE_LOCAL')} AS TYPE_LOCAL_ID, TYPE_LOCAL, 'DVF' AS SOURCE_SYSTEM
  FROM (SELECT DISTINCT coalesce({u('TYPE_LOCAL')}, 'INCONNU') AS TYPE_LOCAL FROM stg) d""",
    "lines": f"""SELECT {_NORMALISED}, {u('PREFIXE_DE_SECTION')} AS px, {u('SECTION')} AS sec,
    trim(NO_PLAN) AS pl, trim({e('NO_VOLUME')}) AS vol,
    coalesce({u('TYPE_LOCAL')}, 'INCONNU') AS ty, DATE_MUTATION, NATURE_MUTATION, VALEUR_FONCIERE,
    SURFACE_REELLE_BATI, TRY_CAST(NOMBRE_PIECES_PRINCIPALES AS INTEGER) AS NOMBRE_PIECES_PRINCIPALES,
    SURFACE_TERRAIN FROM stg""",
    "fct_mutation": f"""SELECT
    coalesce(a.ADDRESS_ID, {hexkey("'UNKNOWN|' || s.COMMUNE || '|' || s.CODE_DEPARTEMENT")}) AS ADDRESS_ID,
    co.COMMUNE_ID, pa.PARCELLE_ID, ty.TYPE_LOCAL_ID, po.CODE_POSTAL_ID, a.BAN_ID, a.CODE_INSEE,
    a.LONGITUDE, a.LATITUDE, a.MATCH_LEVEL AS GEOCODING_MATCH_LEVEL,
    a.MATCH_SCORE AS GEOCODING_MATCH_SCORE,
    CASE WHEN a.ADDRESS_ID IS NULL AND co.COMMUNE_ID IS NULL THEN 'NO_MATCH'
      WHEN a.ADDRESS_ID IS NULL THEN 'FALLBACK_COMMUNE' ELSE 'MATCH_ADDRESS' END AS ADDRESS_MATCH_STRATEGY,
    s.DATE_MUTATION, s.NATURE_MUTATION, s.VALEUR_FONCIERE, s.SURFACE_REELLE_BATI,
    s.NOMBRE_PIECES_PRINCIPALES, s.SURFACE_TERRAIN
  FROM lines s
  LEFT JOIN dim_address_enriched a ON s.CODE_POSTAL = a.CODE_POSTAL AND s.COMMUNE = a.COMMUNE
    AND s.CODE_DEPARTEMENT = a.CODE_DEPARTEMENT AND {bar('s.NO_VOIE', 's.TYPE_DE_VOIE', 's.VOIE')} = {bar('a.NO_VOIE', 'a.TYPE_DE_VOIE', 'a.VOIE')}
  LEFT JOIN dim_commune co ON s.COMMUNE = co.COMMUNE AND s.CODE_DEPARTEMENT = co.CODE_DEPARTEMENT
  LEFT JOIN dim_type_local ty ON s.ty = ty.TYPE_LOCAL
  LEFT JOIN dim_parcelle pa ON s.px = pa.PREFIXE_DE_SECTION AND s.sec = pa.SECTION
    AND s.pl = pa.NO_PLAN AND s.vol = {e('pa.NO_VOLUME')}
  LEFT JOIN dim_code_postal po ON s.CODE_POSTAL = po.CODE_POSTAL AND s.CODE_DEPARTEMENT = po.CODE_DEPARTEMENT""",
    "sales": """SELECT f.*, CAST(year(f.DATE_MUTATION) AS INTEGER) AS ANNEE, ty.TYPE_LOCAL,
    co.COMMUNE, co.CODE_DEPARTEMENT, po.CODE_POSTAL,
    CAST(f.VALEUR_FONCIERE AS DOUBLE) / CAST(f.SURFACE_REELLE_BATI AS DOUBLE) AS m2
  FROM fct_mutation f LEFT JOIN dim_type_local ty USING (TYPE_LOCAL_ID)
  LEFT JOIN dim_commune co USING (COMMUNE_ID) LEFT JOIN dim_code_postal po USING (CODE_POSTAL_ID)
  WHERE f.VALEUR_FONCIERE IS NOT NULL AND f.SURFACE_REELLE_BATI > 0""",
    "gold_kpi_france": f"SELECT {_kpi('ANNEE', per_type_counts=True)} FROM sales GROUP BY ANNEE",
    "gold_kpi_departement": f"""SELECT k.* REPLACE (coalesce(k.LATITUDE_CENTROID, d.LATITUDE) AS LATITUDE_CENTROID,
    coalesce(k.LONGITUDE_CENTROID, d.LONGITUDE) AS LONGITUDE_CENTROID),
    coalesce(d.NOM_DEPARTEMENT, k.CODE_DEPARTEMENT) AS NOM_DEPARTEMENT
  FROM (SELECT {_kpi('CODE_DEPARTEMENT, ANNEE', ', avg(LATITUDE) AS LATITUDE_CENTROID, avg(LONGITUDE) AS LONGITUDE_CENTROID', True)}
    FROM sales WHERE CODE_DEPARTEMENT IS NOT NULL GROUP BY ALL) k
  LEFT JOIN seed d USING (CODE_DEPARTEMENT)""",
    "gold_kpi_commune": f"""SELECT {_kpi('CODE_INSEE AS CODE_COMMUNE, COMMUNE AS NOM_COMMUNE, CODE_DEPARTEMENT, ANNEE', _ZERO_CENTROID)}
  FROM sales WHERE CODE_INSEE IS NOT NULL GROUP BY CODE_INSEE, COMMUNE, CODE_DEPARTEMENT, ANNEE""",
    "gold_kpi_code_postal": f"""SELECT {_kpi('CODE_POSTAL, CODE_INSEE AS CODE_COMMUNE, ANNEE', _ZERO_CENTROID)}
  FROM sales WHERE CODE_POSTAL IS NOT NULL GROUP BY CODE_POSTAL, CODE_INSEE, ANNEE""",
}


def _needed(sql: str, found: set[str]) -> set[str]:
    for word in set(re.findall(r"[a-z_]+", sql)):
        if word in TABLES and word not in found:
            found.add(word)
            _needed(TABLES[word], found)
    return found


#: The same tables with whole amounts and coordinates.
TABLES_SCALE0 = {**TABLES, "stg": _staged(WHOLE), "ban_all": _cleaned_register(WHOLE)}


def oracle(sql: str, scale0: bool = False) -> str:
    """``sql`` preceded by the tables it names."""
    tables = TABLES_SCALE0 if scale0 else TABLES
    needed = _needed(sql, set())
    ctes = [f"{n} AS MATERIALIZED ({tables[n].strip()})" for n in tables if n in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + sql
