"""Word helpers, host rules, decontamination, language and quality models."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import compare
from terrier.llm import decontaminate, gam_quality, host_rules, ppm_language, queries, text
from terrier.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.01"
WORD = "[^\x20\x09-\x0d]+"
SOME = st.text(st.sampled_from("aB1 \n\t\r\x0b\x0c\x1f\xa0é€𝄞,.#|<"), max_size=60)


@pytest.fixture(scope="module")
def con():
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", ["op1_mixing", "op2_host_rules", "op6_decontamination"])
def test_query_agrees_with_sql(spark, con, key):
    assert compare.difference(queries.QUERIES[key](spark, FOLDER), con, ORACLES[key]) == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(SOME, max_size=6), st.integers(1, 40))
def test_words_of_parts(texts, limit):
    got, n = [], 0
    for first, data, offsets in text.parts(pa.array(texts, pa.string()), limit):
        words = text.Words(data, offsets)
        raw = data.tobytes()
        got += [(first + d, raw[a:b].decode()) for d, a, b in zip(words.doc, words.start, words.end)]
        n += words.n_docs
    assert n == len(texts)
    assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(WORD, t)]


@settings(max_examples=200, deadline=None)
@given(st.lists(SOME, min_size=1, max_size=4))
def test_counts(texts):
    counts = host_rules.count_columns(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        words = re.findall(WORD, t)
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        runs = [tuple(words[j : j + 5]) for j in range(len(words) - 4)]
        times = Counter(runs)
        again = {j + k for j, r in enumerate(runs) if times[r] > 1 for k in range(5)}
        assert [int(counts[c][i]) for c in host_rules.COUNTS] == [
            len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(again)]


def test_long_words_differ():
    texts = ["a" * 200 + "b" + "a" * 63, "a" * 136 + "b" + "a" * 127, "a" * 264]
    for _, data, offsets in text.parts(pa.array(texts)):
        assert len(set(text.Words(data, offsets).hashes().tolist())) == 3


def test_a_bad_host_loses_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "short", "bad") for i in range(60)] + [(100 + i, good, "bad") for i in range(5)]
    rows += [(200 + i, good, f"h{i % 9}") for i in range(90)] + [(400, "short", "h1"), (401, good, None),
                                                               (402, None, None), (403, "", "one")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string").withColumn("host", F.lit(1))
    kept = {r.id: r.kept for r in host_rules.host_verdicts(docs).collect()}
    assert not any(kept[i] for i in [*range(60), *range(100, 105), 400, 402, 403])
    assert all(kept[i] for i in [*range(200, 290), 401])
    assert host_rules.host_verdicts(docs.limit(0)).count() == 0


def test_contained_items(spark):
    item = [f"w{i}" for i in range(24)]  # 20 shingles, 16 needed
    docs = [(1, "Before. " + " ".join(item).upper() + " after"), (2, " ".join(item[:20])), (3, " ".join(item[:19])),
            (4, "x tiny phrase x"), (5, None), (6, ""), (None, " ".join(item)), (1, " ".join(item)),
            (7, " ".join(["filler"] * 5000 + item[:12] + ["changed"] + item[13:] + ["end"] * 3000))]
    items = [(10, " ".join(item)), (11, "tiny phrase"), (12, ""), (13, None), (10, " ".join(item))]
    docs = spark.createDataFrame(docs, "doc_id int, text string").withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contained_items(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.n_shingles, r.n_shared) for r in found) == [
        (0, 10, 20, 20), (1, 10, 20, 20), (1, 10, 20, 20), (2, 10, 20, 16), (4, 11, 1, 1)]
    left = decontaminate.without_items(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7]
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0
    assert decontaminate.without_items(docs, items.limit(0)).count() == docs.count()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=30), st.lists(st.integers(0, 6), max_size=60))
def test_sketches_lose_no_item(item, doc):
    item, doc = ([f"w{x}" for x in y] for y in (item, doc))
    size = min(5, len(item))
    runs = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)}
    has = {tuple(doc[i : i + size]) for i in range(len(doc) - size + 1)}
    index = decontaminate.Index([(1, " ".join(item))], 0.8)
    found = decontaminate._found(index, pa.array([" ".join(doc)]))
    shared = len(runs & has)
    assert found == ([(0, 1, len(runs), shared)] if shared >= 0.8 * len(runs) - 1e-9 else [])


def code_lengths(training, order, sample):
    """Bits of ``sample`` after ``training``, straight from the definition."""
    counts: dict[bytes, Counter] = {}
    for t in training:
        for i in range(len(t)):
            for k in range(min(i, order) + 1):
                counts.setdefault(t[i - k : i], Counter())[t[i]] += 1
    bits = 0.0
    for i, byte in enumerate(sample):
        for k in range(min(i, order), -1, -1):
            seen = counts.get(sample[i - k : i])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if seen[byte]:
                bits -= np.log2(seen[byte] / total)
                break
            bits -= np.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "the dog and the cat", "en"), (3, "le chat est là", "fr"),
            (4, "où est le chien", "fr"), (5, "xxyyxy", "zz"), (6, None, "fr"), (7, "no language", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = ppm_language.fit(docs, F.lit(True))
    assert model.languages == ["en", "fr", "zz"]
    samples = ["the chat", "", "là où", "zebra ÿ", "xyxyxyxxyy", "a", "the cat sat on the mat"]
    raw = [s.encode() for s in samples]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw])]
    got = model.lengths(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for j, language in enumerate(model.languages):
        training = [t.encode() for _, t, lang in rows if lang == language and t]
        assert got[:, j] == pytest.approx([code_lengths(training, ppm_language.ORDER, r) for r in raw])
    out = {r.id: r for r in ppm_language.predicted(
        spark.createDataFrame([(1, "the cat"), (2, None), (3, "123 !"), (4, "le chien"), (None, "où")],
                              "doc_id int, text string").withColumn("score", F.lit("x")), model).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4, None)] == ["en", "und", "und", "fr", "fr"]
    assert all(0 <= r.score <= 1 for r in out.values()) and out[2].score == 0
    none = ppm_language.fit(docs, F.lit(False))
    assert {r.lang_pred for r in ppm_language.predicted(docs, none).collect()} == {"und"}
    assert ppm_language.predicted(docs.limit(0), model).count() == 0


def test_language_on_held_out_documents(spark, documents):
    language = {i: lang for i, _, lang in documents}
    rows = queries.op4_ppm_language(spark, FOLDER).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) == len(documents) and all(r.held_out for r in held)
    assert sum(r.lang_pred == language[r.doc_id] for r in held) >= 0.99 * len(held)


def test_quality_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.op7_gam_quality(spark, FOLDER).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_learns_from_a_feature_that_few_texts_have():
    chance = np.random.default_rng(3)
    x = np.zeros((4000, 2))
    x[:, 1] = chance.random(4000)
    rare = chance.random(4000) < 0.015
    x[rare, 0] = chance.uniform(0.05, 0.4, rare.sum())
    model = gam_quality.fitted(x, (~rare & (x[:, 1] > 0.2)).astype(int))
    bins = model.bins(np.array([[0.0, 0.9], [0.1, 0.9]]))
    assert bins[0, 0] != bins[1, 0]
    table = model.tables[0]
    assert table[bins[1, 0]] < table[bins[0, 0]] - 1



def test_scores_are_sums_of_table_entries():
    chance = np.random.default_rng(2)
    x = chance.integers(0, 30, (600, 3)).astype(float)
    y = ((x[:, 0] > 14) ^ (x[:, 1] > 14)).astype(float)  # an interaction that no single feature shows
    model = gam_quality.fitted(x, y)
    scores = model.scores(x)
    assert ((scores > 0.5) == (y > 0)).mean() > 0.9
    bins = model.bins(x[:1])[0]
    total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins))
    total += sum(t[bins[i], bins[j]] for i, j, t in model.pairs)
    assert scores[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_of_odd_input(spark):
    docs = spark.createDataFrame(
        [(1, "some words here", "a"), (2, None, "b"), (3, "", "c"), (None, "x", "d"), (1, "some words here", "a")],
        "doc_id int, text string, score string")
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id int, quality int").withColumn("text", F.lit(1))
    for chosen in (F.lit(True), F.lit(False)):
        model = gam_quality.fit(docs, labels, chosen)
        rows = gam_quality.scored(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert gam_quality.scored(docs.limit(0), model).count() == 0


def test_quality_takes_little_memory_at_a_time():
    chance = random.Random(4)
    words = [f"{chance.choice('abcdef')}{chance.randrange(3000)}" for _ in range(600_000)]
    texts = [" ".join(words[i : i + 300]) for i in range(0, len(words), 300)]
    tracemalloc.start()
    found = gam_quality.features(pa.array(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20e6  # 3 MB of text in parts of a quarter of a MB
    alone = np.concatenate([gam_quality.features(pa.array([t])) for t in texts[::100]])
    assert (found[::100] == alone).all()


def test_quality_brings_back_only_what_is_kept(spark):
    docs = spark.createDataFrame(
        [(1, "some words here", "a"), (2, None, "b"), (None, "x", "c")], "doc_id int, text string, source string")
    model = gam_quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, quality int"), F.lit(True))
    whole = gam_quality.scored(docs, model)
    short = gam_quality.scored(docs, model, keep=["doc_id"])
    assert short.columns == ["doc_id", "score"]
    assert sorted(short.collect(), key=str) == sorted(whole.select("doc_id", "score").collect(), key=str)
    plan = queries.op7_gam_quality(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    returned = [line.split("[", 1)[1] for line in plan.splitlines() if "MapInArrow" in line]
    assert len(returned) == 1 and "doc_id#" in returned[0] and "text#" not in returned[0]
