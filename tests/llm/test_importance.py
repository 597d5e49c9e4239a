"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from compare import difference
from terrier.llm import importance, queries, text
from terrier.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.01"
UPPER = {c: c + 32 for c in range(65, 91)}
TEXTS = ["Hello World foo-bar 12 Ünïcode x", None, "", "a b a b a b " + "z" * 300 + " q Q", "日本語 テキスト a",
         "--- !!! ", "one two three " * 40, "One two four " * 40, "w" * 5000, "\x00a\x00b É"]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))


def features(t, n):
    w = words(t)
    return [" ".join(w[i : i + k]).encode() for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n, buckets, percent=10, min_words=20):
    corpus, wanted = Counter(), Counter()
    for _, t in docs:
        corpus.update(zlib.crc32(f) % buckets for f in features(t, n))
    for t in target:
        wanted.update(zlib.crc32(f) % buckets for f in features(t, n))
    s_all, t_all = corpus.total() + buckets, wanted.total() + buckets
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1.0) * s_all / ((corpus[b] + 1.0) * t_all)))
            for b in range(buckets)}
    rows = []
    for i, t in docs:
        own = [gain[zlib.crc32(f) % buckets] for f in features(t, n)]
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(own) // len(own) if own else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(own), weight, score, len(words(t))))
    fit = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = fit[: percent * len(fit) // 100]
    return rows, drawn


@pytest.mark.parametrize("n", [1, 2, 3])
def test_buckets_with_and_without_head(n):
    for head in (importance.Head([], [], 97), importance.Head(
            [b"hello", b"a", b"b", b"one", b"two"], [(b"a", b"b"), (b"one", b"two"), (b"two", b"one"), (b"a", b"zz")], 97)):
        for _, data, offsets in text.parts(pa.array(TEXTS, pa.string())):
            found = list(importance.Runs(data, offsets).buckets(head, n, 97))
        got = sorted((int(d), int(b)) for doc, bucket in found for d, b in zip(doc, bucket))
        assert got == sorted((i, zlib.crc32(f) % 97) for i, t in enumerate(TEXTS) for f in features(t, n))


def test_moved_states_are_those_of_longer_texts():
    sizes = np.array([0, 1, 2, 3, 64, 1000, 70000])
    states = np.array([zlib.crc32(b"abc")] * len(sizes), np.uint32)
    got = importance.moved(states, sizes)
    for size, state in zip(sizes.tolist(), got.tolist()):
        tail = bytes(size)
        assert state ^ zlib.crc32(tail) == zlib.crc32(b"abc" + tail)


@pytest.mark.parametrize("n", [1, 2])
def test_equals_the_plain_version(spark, n):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    docs += [(100 + i, "hot words in every copy of this text " * 3) for i in range(300)]
    docs += [(500 + i, " ".join(f"w{(i * j) % 37}" for j in range(i % 60))) for i in range(200)]
    docs += [(7, "the same id once more " * 6)] * 3 + [(None, "no id at all " * 9), (None, None)]
    target = ["one two three four", "w1 w2 w3 w4", None, ""]
    frame = spark.createDataFrame(
        [(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, id string, score int, rank int").repartition(5)
    wanted = spark.createDataFrame([(t, 0) for t in target], "text string, weight int")
    got = importance.resampled(frame, wanted, max_words=n, buckets=997).collect()
    rows, drawn = plain(docs, target, n, 997)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(((r.id, r.n_features, r.weight, r.score, r.n_words) for r in got), key=key) == sorted(rows, key=key)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.id, r.score) for r in ranked] == [(r[0], r[3]) for r in drawn]


def test_the_head_does_not_change_the_totals(spark):
    docs = spark.createDataFrame([(i, "a b c a b " + "d" * i) for i in range(50)], "doc_id long, text string")
    head = importance.frequent(docs, "text", 2, 101)
    assert {b"a", b"b", b"c"} <= set(head.words) and len(head.pairs) >= 3
    none = importance.Head([], [], 101)
    with_head, without = (importance.totals(docs, "text", h, 2, 101) for h in (head, none))
    assert (with_head == without).all() and with_head.sum() == sum(len(features(f"a b c a b {'d' * i}", 2)) for i in range(50))


def test_empty_tables(spark):
    schema = "doc_id long, text string"
    none = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(1, "x " * 30), (2, "y " * 30)], schema)
    assert importance.resampled(none, some).collect() == []
    assert [r["rank"] for r in importance.resampled(some, none).collect()] == [None, None]  # a tenth of two
    assert sorted(r["rank"] for r in importance.resampled(some, none, percent=100).collect()) == [1, 2]


def test_query_agrees_with_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(FOLDER) / name}.parquet'")
    assert difference(queries.op11_importance(spark, FOLDER), con, ORACLES["op11_importance"]) == ""
