"""Planted violations must be found and counted."""

from terrier.operators import checks
from terrier.operators.checks import Check


def _tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 5.0, "x"), (1, "b", 0.0, "x"), (None, "c", None, "y"), (7, "a", -1.0, "x"), (7, "z", 2.0, "y")],
        "fk int, kind string, median double, how string",
    )
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "fk int")
    return {"child": child, "parent": parent}


def test_failing_rows(spark):
    t = _tables(spark)
    assert checks.not_null(t["child"], "fk").count() == 1
    assert [tuple(r) for r in checks.unique(t["parent"], "fk").collect()] == [(2, 2)]
    assert checks.accepted_values(t["child"], "kind", ["a", "b"]).count() == 2
    assert checks.relationships(t["child"], "fk", t["parent"], "fk").count() == 2
    assert checks.positive_median(t["child"], "median").count() == 2


def test_runner_counts(spark):
    declared = [
        Check("child", "fk", "not_null"),
        Check("parent", "fk", "unique"),
        Check("child", "kind", "accepted_values", values=("a", "b")),
        Check("child", "fk", "relationships", to="parent"),
        Check("child", "fk", "relationships", to="parent", where="how = 'y'"),
        Check("child", "median", "prix_median_positif"),
    ]
    result = checks.run_checks(_tables(spark).__getitem__, declared)
    found = sorted((r.model, r.column_name, r.check_name, r.failures) for r in result.collect())
    assert found == [
        ("child", "fk", "not_null", 1),
        ("child", "fk", "relationships", 1),
        ("child", "fk", "relationships", 2),
        ("child", "kind", "accepted_values", 2),
        ("child", "median", "prix_median_positif", 2),
        ("parent", "fk", "unique", 1),
    ]


def test_coordinates_on_the_border_are_inside(spark):
    df = spark.createDataFrame(
        [(41.0, -5.5), (51.5, 10.0), (40.9, 2.0), (45.0, 10.1), (None, None)],
        "LATITUDE double, LONGITUDE double",
    )
    assert checks.coordinates_outside(df, (41.0, 51.5), (-5.5, 10.0)).count() == 2


def test_row_checks_are_counted_by_the_write(spark, tmp_path):
    """One action writes the table and counts; the runner then reads for checks on keys only."""
    child = _tables(spark)["child"]
    declared = [
        Check("child", "fk", "not_null"), Check("child", "kind", "accepted_values", values=("a", "b")),
        Check("child", "median", "prix_median_positif"), Check("child", "fk", "relationships", to="parent"),
        Check("parent", "fk", "unique"),
    ]
    rows, counted = checks.watched("child", child, declared)
    rows.write.parquet(str(tmp_path / "child"))
    assert counted() == {declared[0]: 1, declared[1]: 2, declared[2]: 2}
    read = []

    def table(name):
        read.append(name)
        return _tables(spark)[name]

    given = lambda model: counted() if model == "child" else {}
    result = checks.run_checks(table, declared, given)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, checks.run_checks(table, declared).collect()))
    read.clear()
    assert {r.failures for r in checks.run_checks(table, declared[:3], given).collect()} == {1, 2} and not read


def test_a_store_counts_its_row_checks(spark, tmp_path):
    from terrier.plans.warehouse import parquet_store

    failures = {}
    store = parquet_store(str(tmp_path), checks=[Check("t", "k", "not_null")], failures=failures)
    store("t", spark.createDataFrame([("a",), (None,), (None,)], "k string"))
    assert list(failures.values()) == [2]
    store("t", spark.createDataFrame([], "k string"))
    assert list(failures.values()) == [0]
