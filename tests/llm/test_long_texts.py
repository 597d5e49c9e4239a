"""One text of some megabytes next to short ones: longer than any part, block, piece or cell."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrier.llm import (backoff_lm, bit_packing, decontaminate, gam_quality, host_rules, order_minhash,
                         ppm_language, suffix_dedup)


@pytest.fixture(scope="module")
def docs(spark):
    chance = random.Random(6)
    words = [f"{chance.choice('abcdef')}{chance.randrange(3000)}" for _ in range(400_000)]
    long = " ".join(words)
    near = " ".join(w if i % 400 else "changed" for i, w in enumerate(words))
    rows = [(1, long), (2, "short text of a few words, ten or more of them."), (3, near), (4, "x" * 1_500_000), (5, None)]
    df = spark.createDataFrame([(i, t, "en", "src1") for i, t in rows], "doc_id long, text string, lang string, source string")
    return df, dict(rows)


def test_counts_and_rules(docs):
    df, texts = docs
    rows = {r.id: r for r in host_rules.host_verdicts(df).collect()}
    assert rows[1].n_words == 400_000 and rows[1].word_chars == len(texts[1].replace(" ", ""))
    assert rows[4].n_words == 1 and rows[4].base_failed


def test_near_duplicates(docs):
    df, _ = docs
    assert {r.id: r.class_id for r in order_minhash.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_language_and_quality(spark, docs):
    df, _ = docs
    model = ppm_language.fit(df, F.lit(True))
    assert {r.lang_pred for r in ppm_language.predicted(df, model).collect()} == {"en", "und"}
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0)], "doc_id long, quality int")
    scored = gam_quality.scored(df, gam_quality.fit(df, labels, F.lit(True))).collect()
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) == 5


def test_items_are_found_deep_inside(spark, docs):
    df, texts = docs
    item = " ".join(texts[1].split()[300_000:300_040])
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contained_items(df, items).collect()} == {1, 3}


def test_packing(docs):
    df, texts = docs
    rows = {r.doc_id: r for r in bit_packing.packed(df, corpus_pipeline.tokenizer_path()).collect()}
    assert rows[1].n_tokens > 400_000 and rows[5].n_tokens == 1
    assert rows[5].start + 1 == sum(r.n_tokens for r in rows.values())


def test_repeats_and_scores(docs):
    df, texts = docs
    rows = {r.id: r for r in suffix_dedup.without_repeats(df).collect()}
    assert rows[4].n_removed == rows[4].n_bytes == 1_500_000 and rows[4].n_spans == 1
    assert 0.95 < rows[1].n_removed / rows[1].n_bytes < 1 and rows[1].n_spans > 500
    scores = {r.id: r for r in backoff_lm.scored(df, F.col("doc_id") != 3).collect()}
    assert scores[1].n_tokens == 400_001 and scores[3].score > scores[3].base_score
