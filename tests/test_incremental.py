"""Tables under a manifest, and a star kept up to date by years against full builds."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import golden
from terrier.plans import geocode
from terrier.plans.incremental import Warehouse
from terrier.plans.warehouse import Star
from terrier.session import written
from terrier.sources.manifest import ConcurrentLoad, PartitionedTable

SCHEMA = "k string, n int, y int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(table):
    return sorted(map(tuple, table.read().collect()))


def files(root):
    """Data files with their times of change."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_load_writes_its_partitions_only(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["y"])
    assert table.replace(frame(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)])) == 3
    before, reader = files(tmp_path), table.read()
    assert table.replace(frame(spark, [("B", 9, 2), ("BB", 9, 2)])) == 2
    after = files(tmp_path)
    assert before.items() <= after.items() and all("y=2" in f for f in set(after) - set(before))
    assert held(table) == [("B", 9, 2), ("BB", 9, 2), ("a", 1, 1), ("c", 3, 3)]
    assert sorted(map(tuple, reader.collect())) == [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]  # as when it was read
    table.replace(frame(spark, []), ["y=3"])  # touched, and now without rows
    assert held(table) == [("B", 9, 2), ("BB", 9, 2), ("a", 1, 1)] and table.names() == {"y=1", "y=2"}
    assert table.append(frame(spark, [("d", 4, 1)])) == 1
    assert held(table) == [("B", 9, 2), ("BB", 9, 2), ("a", 1, 1), ("d", 4, 1)]


def test_a_load_counts_once_its_manifest_is_whole(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["y"])
    with pytest.raises(ValueError):
        table.read()
    assert table.read(frame(spark, []).schema).count() == 0
    table.replace(frame(spark, [("a", 1, 1)]))
    frame(spark, [("x", 1, 1)]).write.partitionBy("y").parquet(str(tmp_path / "t/data/load=broken"))
    (tmp_path / "t/manifests/00000002.json").write_text('{"partitions": {"y=1"')
    assert held(table) == [("a", 1, 1)]
    table.replace(frame(spark, [("b", 1, 1)]))
    assert held(table) == [("b", 1, 1)] and "00000003.json" in os.listdir(tmp_path / "t/manifests")


def test_the_second_of_two_loads_at_once_fails(spark, tmp_path, monkeypatch):
    table, other = (PartitionedTable(spark, str(tmp_path / "t"), ["y"]) for _ in range(2))
    table.replace(frame(spark, [("a", 1, 1)]))
    commit = table._commit

    def late(number, manifest):
        other.replace(frame(spark, [("o", 1, 1)]))
        commit(number, manifest)

    monkeypatch.setattr(table, "_commit", late)
    with pytest.raises(ConcurrentLoad):
        table.replace(frame(spark, [("b", 1, 2)]))
    assert held(other) == [("o", 1, 1)]


def test_vacuum_removes_what_no_kept_manifest_names(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["y"])
    for i in range(4):
        table.replace(frame(spark, [("a", i, 1)] + [("b", 0, 2)] * (i == 0)))
    gone = table.vacuum(keep=2)
    assert len(gone) == 2 and all(g.endswith("y=1") for g in gone)
    assert held(table) == [("a", 3, 1), ("b", 0, 2)] and table.vacuum() == []


def test_keys_keep_their_text(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["y", "k"])
    table.replace(frame(spark, [("01", 1, 1), ("2A", 1, 1), ("a b/c", 1, 2)]))
    assert held(table) == [("01", 1, 1), ("2A", 1, 1), ("a b/c", 1, 2)]


# ---------------------------------------------------------------- loads of years


def dated(year, *sales):
    return [golden.sale(**({"DATE_MUTATION": f"05/03/{year}"} | s)) for s in sales]


def place(number, kind, street, postcode="75001", commune="PARIS", departement="75", **other):
    return {"NO_VOIE": number, "TYPE_DE_VOIE": kind, "VOIE": street, "CODE_POSTAL": postcode, "COMMUNE": commune,
            "CODE_DEPARTEMENT": departement} | other


HUGO, FOCH = place("12", "RUE", "VICTOR HUGO"), place("3", "AV", "FOCH")
LYON = place("5", "RUE", "B", "69001", "LYON", "69")
YEARS = {
    2021: dated(2021, HUGO, LYON, place("14", "RUE", "VICTOR HUGO"), place(None, None, None, "20000", "AJACCIO", "2A")),
    2022: dated(2022, HUGO | {"VALEUR_FONCIERE": "310000,50"}, FOCH, FOCH | {"TYPE_LOCAL": "Maison"}),
    2023: dated(2023, LYON, place("99", "RUE", "VICTOR HUGO"), place("", "RUE", "VICTOR HUGO")),
}


def rows_of(df):
    kept = sorted(c for c in df.columns if c not in ("ANNEE", "CREATED_AT"))
    return Counter(tuple(r) for r in df.select(*kept).collect())


def assert_as_full_build(spark, warehouse, years, register=golden.REGISTER, kpis=False):
    full = Star(golden.sales(spark, [s for rows in years.values() for s in rows]), golden.register(spark, register),
                lambda name, df: written(df, name))
    assert rows_of(warehouse.fct_mutation) == rows_of(full.fct_mutation)
    assert rows_of(warehouse.dim_address_enriched) == rows_of(full.dim_address_enriched)
    if kpis:
        for name, found in warehouse.indicators().items():
            assert rows_of(found) == rows_of(full.table(name)), name


def load(spark, warehouse, years, *changed, register=None):
    rows = [s for year in changed for s in years[year]]
    warehouse.load(golden.sales(spark, rows), register and golden.register(spark, register), list(changed))


def test_loads_equal_full_builds(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    years = {y: YEARS[y] for y in (2021, 2022)}
    load(spark, warehouse, years, 2021, 2022, register=golden.REGISTER)
    assert warehouse.geocoded_last == 5
    assert_as_full_build(spark, warehouse, years)
    # A further year: only its unseen addresses are geocoded, files of other years stay.
    before = {f: t for f, t in files(tmp_path / "w/fct_mutation").items()}
    years = dict(YEARS)
    load(spark, warehouse, years, 2023)
    assert warehouse.geocoded_last == 2 and warehouse.years_last == [2023]
    after = files(tmp_path / "w/fct_mutation")
    assert before.items() <= after.items() and all("ANNEE=2023" in f for f in set(after) - set(before))
    assert_as_full_build(spark, warehouse, years)
    # A year loaded again, with other sales: the earlier ones are gone, nothing new is geocoded.
    years[2022] = dated(2022, LYON, LYON | {"VALEUR_FONCIERE": "99000"})
    load(spark, warehouse, years, 2022)
    assert warehouse.geocoded_last == 0
    assert_as_full_build(spark, warehouse, years, kpis=True)
    # The same load once more changes nothing; a year may become empty.
    load(spark, warehouse, years, 2022)
    assert_as_full_build(spark, warehouse, years)
    years[2022] = []
    load(spark, warehouse, years, 2022)
    assert_as_full_build(spark, warehouse, years)


def test_a_changed_register_is_geocoded_where_it_changed(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load(spark, warehouse, YEARS, 2021, 2022, 2023, register=golden.REGISTER)
    # The avenue moves, which concerns its address and the centroid of its postcode; Lyon gets a row.
    changed = [r for r in golden.REGISTER if r[0] not in ("b4", "b7")]
    changed.append(golden.entry("b4", "f2", "3", None, "Avenue Foch", "75001", "75101", "Paris", "2,31", "48,81",
                                "housenumber", "0"))
    load(spark, warehouse, YEARS, 2023, register=changed)
    assert_as_full_build(spark, warehouse, YEARS, changed)
    lyon = [*changed, golden.entry("b9", "f3", "5", None, "Rue B", "69001", "69381", "Lyon", "4,8", "45,7",
                                   "housenumber", "1")]
    load(spark, warehouse, YEARS, 2022, register=lyon)
    assert warehouse.geocoded_last == 1 and warehouse.years_last == [2021, 2022, 2023]
    assert_as_full_build(spark, warehouse, YEARS, lyon)


def test_blanks_are_chosen_as_in_a_full_build(spark, tmp_path):
    """A missing and an empty street type are one address; the empty one counts, whenever it comes."""
    missing, empty = place("12", None, "RUE VICTOR HUGO"), place("12", "", "RUE VICTOR HUGO")
    years = {2021: dated(2021, missing, FOCH), 2022: dated(2022, empty)}
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load(spark, warehouse, years, 2021, register=golden.REGISTER)
    assert_as_full_build(spark, warehouse, {2021: years[2021]})
    load(spark, warehouse, years, 2022)
    assert warehouse.years_last == [2021, 2022]
    assert_as_full_build(spark, warehouse, years)
    years[2022] = dated(2022, FOCH)
    load(spark, warehouse, years, 2022)
    assert_as_full_build(spark, warehouse, years)


def test_a_load_that_failed_is_mended_by_running_it_again(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load(spark, warehouse, YEARS, 2021, 2022, register=golden.REGISTER)
    moved = [r for r in golden.REGISTER if r[0] != "b1"]
    for broken in ("_geocode", "_store_fact"):
        with monkeypatch.context() as patch:
            def fails(*_):
                raise OSError("no room")

            patch.setattr(warehouse, broken, fails)
            with pytest.raises(OSError):
                load(spark, warehouse, YEARS, 2023, register=moved)
    load(spark, warehouse, YEARS, 2023, register=moved)
    assert_as_full_build(spark, warehouse, YEARS, moved)


def test_the_cascade_is_given_unseen_addresses_only(spark, tmp_path, monkeypatch):
    seen = []
    geocoded = geocode.geocoded
    monkeypatch.setattr(geocode, "geocoded", lambda a, r: seen.append(sorted(x.VOIE or "" for x in a.collect())) or geocoded(a, r))
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load(spark, warehouse, YEARS, 2021, register=golden.REGISTER)
    load(spark, warehouse, YEARS, 2022)
    assert seen == [["", "B", "VICTOR HUGO", "VICTOR HUGO"], ["FOCH"]]


def test_cells_of_years_add_up_to_the_fact(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load(spark, warehouse, YEARS, 2021, 2022, 2023, register=golden.REGISTER)
    cells = {r.ANNEE: r.n for r in warehouse.price_cells.groupBy("ANNEE").agg(F.sum("NB_VENTES").alias("n")).collect()}
    assert cells == {y: len(rows) for y, rows in YEARS.items()}
