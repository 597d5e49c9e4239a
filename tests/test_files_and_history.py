"""CSV loading, naming, change tracking."""

import datetime as dt

import golden
from terrier.operators import history
from terrier.sources import files
from terrier.sources.bronze import SALES_SCHEMA, conform
from terrier.sources.seeds import departement_rows, ref_departements


def test_latin1_csv_is_loaded_by_year_and_departement(spark, tmp_path):
    header = ";".join(SALES_SCHEMA.names)
    lines = [
        ";".join("" if v is None else f'"{v}"' for v in golden.sale(VOIE="rue de l'Évêché; n°3")),
        ";".join(v or "" for v in golden.sale(DATE_MUTATION="01/02/2022", CODE_DEPARTEMENT="01", TYPE_LOCAL="Dépendance")),
    ]
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("\n".join([header, *lines]) + "\n", encoding="ISO-8859-1")
    target = str(tmp_path / "bronze")
    loaded = files.ingest_csv(spark, str(source / "*.csv"), target, sep=";", encoding="ISO-8859-1")
    assert loaded == 2
    rows = files.read_partitioned(spark, target, SALES_SCHEMA, ["annee", "departement"])
    found = {(r.annee, r.departement, r.VOIE, r.TYPE_LOCAL, r.NO_VOLUME) for r in rows.collect()}
    assert found == {
        ("2023", "75", "rue de l'Évêché; n°3", "Appartement", None),
        ("2022", "01", "X", "Dépendance", None),
    }


def test_csv_export_keeps_blanks(spark, tmp_path):
    df = golden.sales(spark, [golden.sale(NO_VOIE=" 12", VOIE='A "B"', NO_VOLUME=None)])
    path = str(tmp_path / "out")
    files.export_csv(df, path)
    assert spark.read.schema(SALES_SCHEMA).csv(path, header=True, escape='"').collect() == df.collect()


def test_names(spark):
    assert files.table_name("t", "dev") == "dev.t"
    assert files.table_name("t", "dev", " GOLD ", catalog="lake") == "lake.GOLD.t"


def test_absent_columns_are_null(spark):
    df = spark.createDataFrame([(5, "x")], "NO_PLAN int, COMMUNE string")
    row = conform(df, SALES_SCHEMA).collect()[0]
    assert (row.NO_PLAN, row.COMMUNE, row.VOIE) == ("5", "x", None)


def test_reference_list(spark):
    codes = [r[0] for r in departement_rows()]
    assert len(codes) == 101 and codes == sorted(codes) and "20" not in codes
    assert ref_departements(spark).where("LATITUDE is null").count() == 0


DAYS = [dt.date(2024, 1, 1), dt.date(2024, 7, 1), dt.date(2025, 1, 1)]


def _load(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, n int")


def test_history_over_three_loads(spark):
    first = history.start_history(_load(spark, [("a", "x", 1), ("b", "x", 1), (None, "x", 1)]), DAYS[0])
    second = history.merge_history(
        first, _load(spark, [("a", "x", 1), ("b", None, 1), ("c", "x", 1), (None, "x", 1)]),
        ["k"], ["v", "n"], DAYS[1],
    )
    third = history.merge_history(
        second, _load(spark, [("a", "y", 1), ("b", None, 1), (None, "z", 1)]), ["k"], ["v", "n"],
        DAYS[2],
    )
    found = {tuple(r) for r in third.collect()}
    assert found == {
        ("a", "x", 1, DAYS[0], DAYS[2], False),
        ("a", "y", 1, DAYS[2], None, True),
        ("b", "x", 1, DAYS[0], DAYS[1], False),
        ("b", None, 1, DAYS[1], None, True),
        ("c", "x", 1, DAYS[1], DAYS[2], False),
        (None, "x", 1, DAYS[0], DAYS[2], False),
        (None, "z", 1, DAYS[2], None, True),
    }


def test_new_rows_treat_null_as_a_key(spark):
    current = _load(spark, [("a", "x", 1), (None, "x", 2), ("c", "x", 3)])
    stored = _load(spark, [("a", "z", 9), (None, "z", 9)])
    assert [r.k for r in history.new_rows(current, stored, ["k"]).collect()] == ["c"]


def test_a_table_is_replaced_by_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = files.overwrite_table(_load(spark, [("a", "x", 1)]), path)
    second = files.overwrite_table(_load(spark, [("b", "y", 2)]), path)
    assert first.collect()[0].k == "a"  # readers of the version before go on
    assert [r.k for r in files.read_table(spark, path).collect()] == ["b"]
    (tmp_path / "t" / "v00000003").mkdir()  # a run that has not ended does not count
    assert [r.k for r in files.read_table(spark, path).collect()] == ["b"]
    assert second.collect()[0].k == "b"
    (tmp_path / "t" / "v00000003").rmdir()
    for i in range(3):
        files.overwrite_table(_load(spark, [(str(i), "z", i)]), path)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v00000004", "v00000005"]


def test_tables_go_to_their_schema():
    assert files.table_path("/w/", "t", "gold") == "/w/gold/t"
    assert files.table_path("/w", "t", "gold", " silver ") == "/w/silver/t"


def test_rows_loaded_since_the_last_run(spark):
    times = [dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "k int, CREATED_AT timestamp")
    assert [r.k for r in history.loaded_since(df, dt.datetime(2024, 3, 1)).collect()] == [1]


def test_a_scope_removes_what_it_wrote(spark):
    import os

    from terrier.session import scratch_scope, written

    kept = written(_load(spark, [("a", "x", 1)]), "kept")
    with scratch_scope(spark):
        gone = written(_load(spark, [("b", "x", 1)]), "gone")
        path = gone.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and gone.count() == 1
    assert not os.path.exists(path) and kept.count() == 1
