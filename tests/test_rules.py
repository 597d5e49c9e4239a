"""Parsing rules, edge rows and the fact table."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import golden
from terrier.functions import numbers, text
from terrier.plans import fact, silver
from terrier.plans.warehouse import Star, build_all, parquet_store


def _staged(spark, *rows, **kwargs):
    return silver.stg_dvf_transactions(golden.sales(spark, list(rows)), **kwargs)


def _values(spark, column, rows):
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    return [r[0] for r in df.select(column).collect()]


def test_price_floor(spark):
    rows = [golden.sale(VALEUR_FONCIERE=v) for v in ("20000", "20000,40", "20000,50", None)]
    kept = [r.VALEUR_FONCIERE for r in _staged(spark, *rows).collect()]
    assert sorted(kept) == [Decimal("20000.40"), Decimal("20000.50")]
    whole = [r.VALEUR_FONCIERE for r in _staged(spark, *rows, scale0=True).collect()]
    assert whole == [Decimal(20001)]


def test_other_transactions_are_dropped_before_parsing(spark):
    rows = [golden.sale(NATURE_MUTATION="Echange", VALEUR_FONCIERE="n/a"), golden.sale()]
    assert _staged(spark, *rows).count() == 1


@pytest.mark.parametrize("bad", [{"DATE_MUTATION": "2024-01-31"}, {"VALEUR_FONCIERE": "cher"}])
def test_malformed_sales_raise(spark, bad):
    with pytest.raises(Exception):
        _staged(spark, golden.sale(**bad)).collect()


def test_tolerant_coordinates(spark):
    texts = ["2,35", " 48.5 ", "abc", "NaN", "Infinity", "1d", "", None, "-5,5", "1e1"]
    assert _values(spark, numbers.try_parse_coordinate("v"), texts) == [
        2.35, 48.5, None, None, None, None, None, None, -5.5, 10.0,
    ]
    assert _values(spark, numbers.try_parse_coordinate("v", scale0=True), ["48.5", "2,4"]) == [49.0, 2.0]


def test_street_type_is_stripped_once(spark):
    names = ["RUE", "RUELLE X", "RUE RUE X", "AVENUE FOCH", "AV FOCH", "LOT 3", None]
    assert _values(spark, text.strip_street_type("v"), names) == [
        "RUE", "RUELLE X", "RUE X", "FOCH", "FOCH", "3", None,
    ]


def test_normalisation_trims_blanks_and_collapses_whitespace(spark):
    assert _values(spark, text.norm_text("v"), ["  de   la\t gare ", "\tx", None]) == [
        "DE LA GARE", " X", None,
    ]
    assert _values(spark, text.norm_text_or_null("v"), ["", " ", "a"]) == [None, "", "A"]


def test_parcels_with_missing_parts(spark):
    rows = [golden.sale(NO_VOLUME=v) for v in (None, "", "  ")]
    rows += [golden.sale(PREFIXE_DE_SECTION=None), golden.sale(SECTION=None)]
    star = Star(golden.sales(spark, rows), golden.register(spark))
    parcels = {(p.PREFIXE_DE_SECTION, p.SECTION): p for p in star.dim_parcelle.collect()}
    assert len(parcels) == 3
    assert parcels["001", "AB"].NO_VOLUME is None
    assert parcels[None, "AB"].IS_PARTIAL == 0 and parcels["001", None].IS_PARTIAL == 1
    keys = [r.PARCELLE_ID for r in star.fct_mutation.collect()]
    assert keys.count(None) == 2 and keys.count(parcels["001", "AB"].PARCELLE_ID) == 3


def test_sale_without_commune(spark):
    star = Star(golden.sales(spark, [golden.sale(COMMUNE=None)]), golden.register(spark))
    row = star.fct_mutation.collect()[0]
    assert row.ADDRESS_ID and row.COMMUNE_ID is None and row.ADDRESS_MATCH_STRATEGY == "NO_MATCH"
    assert star.dim_commune.collect()[0].COMMUNE is None


def test_unknown_premises(spark):
    star = Star(golden.sales(spark, [golden.sale(TYPE_LOCAL=None)]), golden.register(spark))
    assert [r.TYPE_LOCAL for r in star.dim_type_local.collect()] == ["INCONNU"]


EDGES = [
    *golden.SALES,
    golden.sale(COMMUNE="\tPARIS"), golden.sale(COMMUNE="PARIS\t"), golden.sale(COMMUNE=""),
    golden.sale(COMMUNE=None), golden.sale(CODE_DEPARTEMENT=None), golden.sale(CODE_POSTAL=None),
    golden.sale(CODE_POSTAL=""), golden.sale(NO_VOIE=""), golden.sale(NO_VOIE=None),
    golden.sale(TYPE_DE_VOIE="", VOIE=None), golden.sale(VOIE=""), golden.sale(TYPE_LOCAL=None),
    golden.sale(TYPE_LOCAL=" inconnu "), golden.sale(SECTION=None), golden.sale(NO_PLAN=None),
    golden.sale(NO_VOLUME="7"), golden.sale(NO_VOLUME=" "), golden.sale(SECTION="", NO_PLAN=""),
    golden.sale(NOMBRE_PIECES_PRINCIPALES="99999999999"), golden.sale(SURFACE_REELLE_BATI=None),
    golden.sale(CODE_POSTAL=None, COMMUNE=None, CODE_DEPARTEMENT=None),
]


def test_computed_keys_equal_looked_up_keys(spark):
    star = Star(golden.sales(spark, EDGES), golden.register(spark))
    joined = fact.fct_mutation_joined(
        star.stg_dvf_transactions, star.dim_address_enriched, star.dim_commune, star.dim_parcelle,
        star.dim_type_local, star.dim_code_postal,
    )
    computed = star.fct_mutation
    assert computed.columns == joined.columns
    assert computed.count() == len(EDGES)
    assert computed.exceptAll(joined).count() == 0 and joined.exceptAll(computed).count() == 0


def test_fact_keeps_every_copy(spark):
    rows = [golden.sale()] * 50
    star = Star(golden.sales(spark, rows), golden.register(spark))
    assert star.fct_mutation.count() == 50


def test_indicator_flag_and_missing_type(spark):
    rows = [golden.at("12", "RUE", "VICTOR HUGO", "75001", "PARIS", "75")] * 4
    rows += [golden.at("9", "RUE", "Z", "20000", "AJACCIO", "2A", TYPE_LOCAL="Maison")] * 5
    star = Star(golden.sales(spark, rows), golden.register(spark))
    kpis = {r.NOM_COMMUNE: r for r in star.gold_kpi_commune.collect()}
    assert kpis["PARIS"].HAS_SUFFICIENT_DATA is False and kpis["AJACCIO"].HAS_SUFFICIENT_DATA is True
    assert kpis["AJACCIO"].PRIX_MEDIAN_APPARTEMENT is None
    assert kpis["PARIS"].PRIX_MEDIAN_M2 == 5000.0


def test_departement_falls_back_to_the_reference_list(spark):
    rows = [golden.at("1", "RUE", "A", "97100", "BASSE-TERRE", "971"),
            golden.at("1", "RUE", "A", "20100", "NULLE PART", "20")]
    star = Star(golden.sales(spark, rows), golden.register(spark))
    kpis = {r.CODE_DEPARTEMENT: r for r in star.gold_kpi_departement.collect()}
    assert (kpis["971"].NOM_DEPARTEMENT, kpis["971"].LATITUDE_CENTROID) == ("Guadeloupe", 16.265)
    assert (kpis["20"].NOM_DEPARTEMENT, kpis["20"].LATITUDE_CENTROID) == ("20", None)


def test_calendar_ranges(spark):
    days = [dt.date(2023, m, 28) for m in range(1, 13)] + [dt.date(2024, 1, 1), dt.date(2022, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert df.where(numbers.in_period("d", 2023)).count() == 12
    assert df.where(numbers.in_period("d", 2023, 4)).count() == 3
    assert df.where(numbers.in_period("d", quarter=1)).count() == 4
    assert df.where(numbers.in_period("d")).count() == 14


def _means_rounded(df):
    """Means of doubles differ in the last bits with the order of addition."""
    return df.select(*(F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes))


def test_stored_star_equals_lazy_star(spark, tmp_path):
    lazy = Star(golden.sales(spark, EDGES), golden.register(spark))
    stored = Star(golden.sales(spark, EDGES), golden.register(spark), parquet_store(str(tmp_path)))
    tables = build_all(stored)
    assert (tmp_path / "gold" / "fct_mutation" / "v00000001" / "ANNEE=2023").is_dir()
    for name, table in tables.items():
        plain = _means_rounded(lazy.table(name))
        kept = _means_rounded(table.select(plain.columns))
        assert kept.exceptAll(plain).count() == 0
        assert kept.count() == plain.count()
    assert tables["fct_mutation"].where(F.col("CREATED_AT").isNull()).count() == 0


def test_sales_near_sites_agree_with_all_pairs(spark):
    import math
    import random

    from terrier.operators.geo import sales_near

    chance = random.Random(12)
    columns = "X_LAMBERT93 double, Y_LAMBERT93 double"
    points = [(chance.gauss(0, 120), chance.gauss(0, 120), chance.randrange(1, 5)) for _ in range(900)]
    points += points[:50] + [(None, 1.0, 1), (0.0, 0.0, 2), (100.0, 0.0, 3)]
    sites = [(i, chance.uniform(-400, 400), chance.uniform(-400, 400)) for i in range(60)] + [(60, 0.0, 0.0), (61, None, 0.0)]
    got = sales_near(
        spark.createDataFrame(sites, f"id int, {columns}"), spark.createDataFrame(points, f"{columns}, w int"),
        "id", "w", 100.0)
    wanted = {}
    for i, x, y in sites:
        if x is not None:
            near = [(math.hypot(x - a, y - b), w) for a, b, w in points if a is not None]
            near = [(d, w) for d, w in near if d <= 100.0]
            if near:
                wanted[i] = (sum(w for _, w in near), min(near)[0])
    found = {r.id: (r.nb_near, r.nearest_m) for r in got.collect()}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in wanted.items()}
    assert all(abs(found[k][1] - wanted[k][1]) < 1e-9 for k in wanted)
