"""The address matching cascade on known addresses."""

import pytest

import golden
from terrier.plans import geocode, silver
from terrier.plans.warehouse import Star


@pytest.fixture(scope="module")
def star(spark):
    return Star(golden.sales(spark, golden.SALES), golden.register(spark))


def _matches(df):
    return {
        (r.NO_VOIE, r.VOIE, r.COMMUNE): (
            r.MATCH_LEVEL, r.BAN_ID, r.LONGITUDE and round(r.LONGITUDE, 9),
            r.LATITUDE and round(r.LATITUDE, 9), r.BAN_QUALITY_SCORE,
        )
        for r in df.collect()
    }


def test_register_rows_that_survive(star):
    ids = {r.BAN_ID for r in star.stg_ban_addresses_normalized.collect()}
    assert ids == {"b1", "b2", "b3", "b4", "b5"}


def test_every_address_gets_its_best_match(star):
    assert star.dim_address_enriched.count() == len(golden.MATCHES)
    assert _matches(star.dim_address_enriched) == golden.MATCHES


def test_joins_without_broadcast_give_the_same(spark, star):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        found = geocode.dim_address_enriched(star.stg_dvf_transactions, star.stg_ban_addresses_normalized)
        assert _matches(found) == golden.MATCHES
    finally:
        spark.conf.set(threshold, before)


def test_level_by_level_gives_the_same(star):
    found = geocode.matches_by_level(star.stg_dvf_transactions, star.stg_ban_addresses_normalized)
    merged = {}
    for level, df in found.items():
        one = _matches(df)
        assert all(v[0] == level for v in one.values())
        assert not merged.keys() & one.keys()
        merged |= one
    assert merged == golden.MATCHES
    assert found["COMMUNE"].count() == 0


def test_payload_of_area_levels(star):
    row = star.dim_address_enriched.where("MATCH_LEVEL = 'CODE_POSTAL'").collect()[0]
    assert (row.TYPE_POSITION, row.SOURCE_POSITION) == ("LOCALITY", "COMPUTED_CENTROID")
    assert (row.CODE_INSEE, row.ID_FANTOIR, row.PARCELLES_CADASTRALES, row.NOM_AFNOR) == (
        "75101", None, None, None,
    )
    street = star.dim_address_enriched.where("MATCH_LEVEL = 'VOIE_SEULE'").collect()[0]
    assert (street.TYPE_POSITION, street.MATCH_SCORE) == ("STREET", 70)


def test_sale_without_postcode_falls_back_to_its_commune(star):
    assert star.dim_address_enriched.where("COMMUNE = 'MARSEILLE'").count() == 0
    row = star.fct_mutation.where("ADDRESS_MATCH_STRATEGY = 'FALLBACK_COMMUNE'").collect()
    assert len(row) == 1 and row[0].ADDRESS_ID and row[0].BAN_ID is None


def test_hot_postcode_and_street(spark):
    """Many addresses of one street: all rows kept, with and without a broadcast."""
    rows = [golden.at(str(i), "RUE", "VICTOR HUGO", "75001", "PARIS", "75") for i in range(1, 400)]
    rows += [golden.at(str(i), "QUAI", "X", "75001", "PARIS", "75") for i in range(1, 400)]
    staged = silver.stg_dvf_transactions(golden.sales(spark, rows))
    register = silver.stg_ban_addresses_normalized(golden.register(spark))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        for limit in ("-1", before):
            spark.conf.set(threshold, limit)
            found = geocode.dim_address_enriched(staged, register)
            levels = {r.MATCH_LEVEL: r["count"] for r in found.groupBy("MATCH_LEVEL").count().collect()}
            assert levels == {"EXACT": 1, "SANS_TYPE": 1, "VOIE_SEULE": 397, "CODE_POSTAL": 399}
    finally:
        spark.conf.set(threshold, before)


def test_equal_scores_take_the_smallest_identifier(spark):
    rows = [
        golden.entry(i, "f", "12", None, "Rue Y", "75001", "75101", "Paris", "2,3", "48,8", "housenumber", "1")
        for i in ("b9", "b10", "b11")
    ]
    star = Star(golden.sales(spark, [golden.at("12", "RUE", "Y", "75001", "PARIS", "75")]),
                golden.register(spark, rows))
    assert star.dim_address_enriched.collect()[0].BAN_ID == "b10"
