import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrier.llm import backoff_lm, queries

FOLDER = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return ["<s>", *re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), "</s>"]


def brute_force(rows, order, strength):
    """Rows of id, text, train: token counts, base score and score."""
    counts = [Counter() for _ in range(order)]
    for _, text, train in rows:
        if train:
            words = tokens(text)
            for k in range(order):
                counts[k].update(tuple(words[i - k : i + 1]) for i in range(k, len(words)))
    n = sum(v for (w,), v in counts[0].items() if w != "<s>")
    distinct = sum(w != "<s>" for (w,) in counts[0])

    def chance(words, i, k):
        if k == 0:
            return (counts[0][(words[i],)] + 0.5) / (n + 0.5 * (distinct + 1))
        if i < k:
            return chance(words, i, k - 1)
        history = counts[k - 1][tuple(words[i - k : i])]
        lower = chance(words, i, k - 1)
        return (counts[k][tuple(words[i - k : i + 1])] + strength * lower) / (history + strength) if history else lower

    out = {}
    for key, text, _ in rows:
        words = tokens(text)
        places = range(1, len(words))
        out[key] = (len(words) - 1, sum(counts[0][(words[i],)] > 0 for i in places), n,
                    sum(math.log10(chance(words, i, 0)) for i in places),
                    sum(math.log10(chance(words, i, order - 1)) for i in places))
    return out


def compare(df, wanted):
    rows = df.collect()
    assert len(rows) == len(wanted)
    for r in rows:
        counts, scores = wanted[r.id][:3], wanted[r.id][3:]
        assert (r.n_tokens, r.n_known, r.train_tokens) == counts
        assert (r.base_score, r.score) == pytest.approx(scores, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("piece", [backoff_lm.PIECE, 5])
def test_small_texts_in_many_blocks(spark, monkeypatch, order, piece):
    monkeypatch.setattr(backoff_lm.Automaton.scores, "__defaults__", (piece,))
    rows = [(i, " ".join("aBcde"[(i * j + j * j) % 5] for j in range(i % 17)), i % 3 != 0) for i in range(90)]
    rows += [(100, "", True), (101, "unknown words only", False), (102, "a " * 40, True), (103, "A\tb c", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = backoff_lm.scored(docs, F.col("learn"), order=order, strength=2.0, block_bytes=300)
    compare(got, brute_force(rows, order, 2.0))


def test_query_on_whole_documents(spark, documents):
    rows = [(i, t, zlib.crc32(str(i).encode()) % 5 != 1) for i, t, _ in documents]
    df = queries.op10_backoff_lm(spark, FOLDER)
    compare(df.withColumnRenamed("doc_id", "id"), brute_force(rows, backoff_lm.ORDER, backoff_lm.STRENGTH))
    held = df.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_nulls_repeats_and_foreign_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b", True, 1), (1, "a b", True, 2), (None, "a c", None, 3), (2, None, False, 4), (3, "", True, 5)],
        "doc_id int, text string, train boolean, block int")
    rows = backoff_lm.scored(docs, F.col("train")).collect()
    assert sorted((r.id or 0, r.n_tokens, r.train_tokens) for r in rows) == [
        (0, 3, 7), (1, 3, 7), (1, 3, 7), (2, 1, 7), (3, 1, 7)]
    none = backoff_lm.scored(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)
    assert backoff_lm.scored(docs.limit(0), F.col("train")).count() == 0


def test_messages_keep_keys_and_counts():
    import numpy as np

    from terrier.llm import exchange

    for keys in ([], [5], [0, 1, 2**63, 2**64 - 1], [7, 8, 2**47]):
        keys = np.array(keys, np.uint64)
        counts = np.arange(len(keys)) * 300
        table = exchange.question(3, keys, counts, 4)
        distinct, total, answer = exchange.totals(table)
        assert distinct.tolist() == keys.tolist() and total.tolist() == counts.tolist()
        replies = table.select(["range"]).append_column(
            "counts", [[answer(i) for i in range(len(table))]])
        assert exchange.answers(replies).tolist() == counts.tolist()


def test_query_reads_trigrams_and_asks_only_for_shared_ones(spark):
    """Failure arcs chain: histories of two words back off to one, then to none."""
    from terrier.llm import exchange

    assert backoff_lm.ORDER == 3
    texts = ["a b c d", "a b c e", "x y z", "b c d", "q b c", "x y z w", "c d e a b"]
    rows = [(i, t, i not in (3, 5)) for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = backoff_lm.scored(docs, F.col("learn"), strength=2.0, block_bytes=20)
    compare(got, brute_force(rows, 3, 2.0))
    assert {r.score for r in got.collect()} != {
        r.score for r in backoff_lm.scored(docs, F.col("learn"), order=2, strength=2.0).collect()}
    pair = exchange.question(0, np.array([10, 18, 26, 34], np.uint64), np.array([3, 0, 1, 0]), 1)
    other = exchange.question(1, np.array([26, 34], np.uint64), np.array([4, 0]), 1)
    replies = backoff_lm._answering(0)(pa.concat_tables([pair, other]))
    # counted here only, not counted, five in several blocks, not counted anywhere
    assert exchange.answers(replies.slice(0, 1)).tolist() == [backoff_lm._LONE, 0, 6, 0]
