import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from terrier.llm import queries, suffix_dedup

FOLDER = "/root/testdata/sf0.01"


def brute_force(texts: list[bytes], length: int) -> list[tuple[int, int, int, str]]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not h for g, h in zip(gone, [0, *gone]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    columns = ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=80), st.integers(1, 30))
def test_suffix_order_sorts_by_the_first_bytes(symbols, length):
    order = suffix_dedup.suffix_order(np.array(symbols, np.int64), length)
    keys = [symbols[i : i + length] for i in order]
    assert sorted(order.tolist()) == list(range(len(symbols)))
    assert keys == sorted(keys)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 2 for x in b)), max_size=5, unique=True),
       st.integers(8, 12))
def test_repeated_starts(texts, length):
    if not texts:
        return
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t, found in zip(texts, suffix_dedup.repeated_starts(texts, length)):
        assert found.tolist() == [seen[t[i : i + length]] > 1 for i in range(len(t) - length + 1)]


def test_small_alphabet_in_many_blocks(spark):
    chance = random.Random(5)
    texts = ["".join(chance.choice("ab") for _ in range(chance.randrange(60))) for _ in range(120)]
    texts += ["ab" * 40, "ab" * 40, "a" * 100, "", "é" * 30, "Ä\n" * 9] + texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = brute_force([t.encode() for t in texts], 12)
    got = result(suffix_dedup.without_repeats(docs, 12, block_bytes=500))
    assert got == [(i, *w) for i, w in enumerate(wanted)]


def test_hot_cores_in_many_blocks(spark):
    chance = random.Random(7)
    own = lambda n: "".join(chance.choice("abcdefgh") for _ in range(n))
    passage = own(30)
    texts = [own(chance.randrange(30)) + passage + own(chance.randrange(30)) for _ in range(60)]
    texts += ["".join(chance.choice("ab") for _ in range(chance.randrange(60))) for _ in range(60)]
    texts += ["ab" * 40, "a" * 100, "", "é" * 30] + texts[:3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = [(i, *w) for i, w in enumerate(brute_force([t.encode() for t in texts], 12))]
    for hot in (0, 3, 20):
        assert result(suffix_dedup.without_repeats(docs, 12, block_bytes=500, hot=hot)) == wanted


def test_a_range_gets_few_segments_of_a_core():
    """Documents that share a passage have different segments of one core at its edges."""
    chance = random.Random(8)
    own = lambda n: "".join(chance.choice("abcdefgh") for _ in range(n))
    passage = own(600)
    docs = pa.table({"id": list(range(50)), "text": [own(300) + passage + own(300) for _ in range(50)]})
    asked = suffix_dedup._asking(1, 200, 50)((pa.scalar(0),), docs)
    answers = suffix_dedup._answer(asked)
    most = {}
    for hot in (10, 10**6):
        rows = suffix_dedup._sending(1, 200, 50, hot)(docs, answers).to_pylist()
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows if r["segment"] is not None]
        most[hot] = max(np.unique(k, return_counts=True)[1].max() for k in keys) if keys else 0
    assert most[10] <= 10 < 50 <= most[10**6]


def test_query_on_whole_documents(spark, documents):
    rows = queries.op8_suffix_dedup(spark, FOLDER).withColumnRenamed("doc_id", "id")
    texts = [t.encode() for _, t, _ in documents]
    assert result(rows) == [(i, *w) for (i, _, _), w in zip(documents, brute_force(texts, 200))]


def test_nulls_repeats_and_foreign_columns(spark):
    long = "x".join(str(i) for i in range(200))
    docs = spark.createDataFrame(
        [(1, long, "a", 1), (None, long, "b", 2), (2, None, "c", 3), (3, "", "d", 4), (1, long, "a", 1)],
        "doc_id long, text string, block string, id int")
    rows = suffix_dedup.without_repeats(docs).collect()
    assert sorted((r.id or 0, r.n_bytes, r.n_removed) for r in rows) == [
        (0, len(long), len(long)), (1, len(long), len(long)), (1, len(long), len(long)), (2, 0, 0), (3, 0, 0)]
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


def test_kept_text(spark):
    shared = "".join(chr(97 + i * i % 23) for i in range(260))
    docs = spark.createDataFrame([(1, "before " + shared), (2, shared + " after")], "doc_id int, text string")
    rows = suffix_dedup.without_repeats(docs, with_text=True).sort("id").collect()
    assert [bytes(r.kept) for r in rows] == [b"before ", b" after"]
