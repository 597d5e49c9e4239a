"""Files with bad rows, joins to the version valid at a time, the filter of asked keys."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import golden
from terrier.operators import bloom
from terrier.operators.asof import as_of
from terrier.sources import loads
from terrier.sources.bronze import SALES_SCHEMA
from terrier.sources.loads import load_csv

HEADER = ";".join(SALES_SCHEMA.names)


def line(**values):
    return ";".join("" if v is None else f'"{v}"' for v in golden.sale(**values))


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n", encoding="UTF-8")


def run(spark, tmp_path):
    load = load_csv(spark, str(tmp_path / "in"), str(tmp_path / "good"), str(tmp_path / "bad"), sep=";")
    good = sorted((r.annee, r.departement, r.VOIE) for r in load.accepted.read().collect())
    bad = sorted((r.FICHIER, r.MOTIF) for r in load.rejected.read().collect())
    counts = {r.FICHIER: (r.CHARGEES, r.REJETEES) for r in load.files.collect()}
    return good, bad, counts


def test_bad_rows_are_kept_apart_by_file_and_reason(spark, tmp_path):
    put(tmp_path / "in", "a.csv", line(VOIE="ok; 1"), line(DATE_MUTATION="31/02/2023"), line(DATE_MUTATION=None),
        line(VALEUR_FONCIERE="12.5.3"), line(VALEUR_FONCIERE=None, VOIE="no price"), "05/03/2023;Vente", line() + ";1;2",
        line(CODE_DEPARTEMENT=" "))
    put(tmp_path / "in", "b 1.csv", line(DATE_MUTATION="1/2/2023"), line(VOIE="b", CODE_DEPARTEMENT="01"))
    good, bad, counts = run(spark, tmp_path)
    assert good == [("2023", "01", "b"), ("2023", "75", "no price"), ("2023", "75", "ok; 1")]
    names = sorted(counts)
    assert [counts[n] for n in names] == [(2, 6), (1, 1)] and names[0] == "a.csv"
    assert [m for f, m in bad if f == "a.csv"] == ["COLONNES"] * 2 + ["DATE"] * 2 + ["DEPARTEMENT", "MONTANT"]
    assert run(spark, tmp_path) == (good, bad, counts)  # repeating a load changes nothing


def test_a_corrected_file_replaces_its_rows_and_rejects(spark, tmp_path):
    put(tmp_path / "in", "a.csv", line(VOIE="x"), line(DATE_MUTATION="??"))
    put(tmp_path / "in", "b.csv", line(VOIE="y", DATE_MUTATION="01/01/2020"), line(VALEUR_FONCIERE="??"))
    run(spark, tmp_path)
    (tmp_path / "in" / "b.csv").unlink()
    put(tmp_path / "in", "a.csv", line(VOIE="x"), line(VOIE="z"))
    good, bad, counts = run(spark, tmp_path)
    assert good == [("2020", "75", "y"), ("2023", "75", "x"), ("2023", "75", "z")]
    assert bad == [("b.csv", "MONTANT")] and counts == {"a.csv": (2, 0)}


def test_rows_gathered_in_slices_are_those_of_one_load(spark, tmp_path, monkeypatch):
    """Every partition lies in one slice, so its rows come to one file still."""
    text = [line(CODE_DEPARTEMENT=f"{n % 9:02d}", VOIE=f"v{n}") for n in range(90)] + [line(DATE_MUTATION="??")] * 5
    put(tmp_path / "in", "a.csv", *text[::2])
    put(tmp_path / "in", "b.csv", *text[1::2])
    whole = run(spark, tmp_path)
    size = sum(p.stat().st_size for p in (tmp_path / "in").iterdir())
    assert loads._bytes(spark, [str(tmp_path / "in")]) == loads._bytes(spark, [str(tmp_path / "in" / "*.csv")]) == size
    written_parts, write = [], loads.PartitionedTable._write
    monkeypatch.setattr(loads, "SLICE_BYTES", size // 3 + 1)
    monkeypatch.setattr(loads.PartitionedTable, "_write", lambda *args: (written_parts.append(args[1]), write(*args)))
    assert run(spark, tmp_path) == whole and len(whole[0]) == 90 and len(whole[1]) == 5
    accepted = loads.PartitionedTable(spark, str(tmp_path / "good"), ["annee", "departement"])
    assert len(written_parts) == 3 + 1 and len(accepted.names()) == 9 == len(accepted.read().inputFiles())


def test_rejected_lines_can_be_read_again(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "05/03/2023;Vente;1", line(DATE_MUTATION="??", VOIE="A;B"))
    load = load_csv(spark, str(tmp_path / "in"), str(tmp_path / "g"), str(tmp_path / "b"), sep=";")
    lines = {r.MOTIF: r.LIGNE for r in load.rejected.read().collect()}
    assert lines["COLONNES"] == "05/03/2023;Vente;1" and lines["DATE"].startswith("??;Vente;") and '"A;B"' in lines["DATE"]
    assert load.accepted.manifest()["rows"] == 0


# ---------------------------------------------------------------- as of a time

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(n)


def plain(events, versions):
    out = []
    for k, t, n in events:
        own = sorted((v for v in versions if v[0] == k), key=lambda v: (v[1], v[2] is None, v[2] or DAY))
        at = bisect.bisect_right([v[1] for v in own], t) if t is not None else 0
        last = own[at - 1] if at else None
        valid = last is not None and (last[2] is None or t < last[2])
        out.append((k, t, n, last[3] if valid else None))
    return sorted(out, key=lambda r: tuple((v is not None, v or 0) if not isinstance(v, dt.date) else (True, v.toordinal()) for v in r))


@pytest.mark.parametrize("period", ["month", "year", "day"])
def test_events_meet_the_version_of_their_time(spark, period):
    chance = random.Random(6)
    keys = [None, "a", "b", "hot"]
    versions = []
    for k in keys:
        at = 0
        while at < 500:
            end = at + chance.randrange(1, 90)
            versions.append((k, day(at), day(end) if chance.random() < 0.8 else None, f"{k}{at}"))
            at = end + chance.choice([0, 0, 20])
    events = [(chance.choice(keys + ["unknown"] + ["hot"] * 9), day(chance.randrange(-50, 600)), i) for i in range(1500)]
    events += [("a", v[1], 2000 + i) for i, v in enumerate(versions)] + [("a", None, 1)]
    frame = spark.createDataFrame(events, "k string, t date, n int").repartition(4)
    history = spark.createDataFrame(versions, "k string, VALID_FROM date, VALID_TO date, v string").repartition(3)
    got = [tuple(r) for r in as_of(frame, history, ["k"], "t", ["v"], period=period).collect()]
    key = lambda r: tuple((v is not None, v or 0) if not isinstance(v, dt.date) else (True, v.toordinal()) for v in r)
    assert sorted(got, key=key) == plain(events, versions)
    none = spark.createDataFrame([], history.schema)
    assert as_of(frame, none, ["k"], "t", ["v"]).where("v is not null").count() == 0


def test_a_hot_key_is_split_by_period(spark):
    """No group of the sort holds more of a hot key than one period."""
    events = spark.range(36_000).select(F.lit("hot").alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 360).cast("int")).alias("t"))
    history = spark.createDataFrame([("hot", DAY, None, "v")], "k string, VALID_FROM date, VALID_TO date, v string")
    joined = as_of(events, history, ["k"], "t", ["v"])
    assert joined.where("v = 'v'").count() == 36_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k#" in plan and "_period" in plan and "Join" not in plan


# ---------------------------------------------------------------- asked keys


@pytest.mark.parametrize("words", [1, 50, bloom.MAX_WORDS])
def test_no_asked_key_is_lost(spark, monkeypatch, words):
    monkeypatch.setattr(bloom, "MAX_WORDS", words)
    df = spark.range(5000).select(F.concat(F.lit("key "), F.col("id")).alias("k"), "id").union(
        spark.createDataFrame([(None, -1), ("", -2)], "k string, id long"))
    asked = df.where("id % 50 = 0 or id < 0").select(F.col("k").alias("a"))
    found = {r.id for r in bloom.having_keys(df, "k", asked, "a", 102).collect()}
    wanted = {i for i in range(0, 5000, 50)} | {-2}
    assert wanted <= found and -1 not in found and len(found) <= len(wanted) + 5000 * 0.06
    assert bloom.having_keys(df, "k", asked.limit(0), "a", 0).count() == 0
