"""Mixing, packed ids, chat formatting and the pipeline."""

import hashlib
import io
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from terrier.llm import bit_packing, chat_format, mixing, queries

FOLDER = "/root/testdata/sf0.01"
NASTY = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "\n", "<", "a", "é𝄞"]), max_size=12).map("".join)
NASTY |= st.text()


# --- mixing


def poured(budget, groups):
    """Budgets of siblings (name, capacity, weight) by filling step by step."""
    given_, open_ = {}, {n: (c, w) for n, c, w in groups}
    while open_:
        level = budget / sum(w for _, w in open_.values())
        full = {n for n, (c, w) in open_.items() if c <= level * w + 1e-9}
        if not full:
            return given_ | {n: level * w for n, (_, w) in open_.items()}
        for n in full:
            given_[n] = open_.pop(n)[0]
            budget -= given_[n]
    return given_


def test_budgets_go_to_siblings_before_ancestors(spark):
    chance = np.random.default_rng(4)
    leaves = [(f"d{d}", f"l{i}", f"s{s}", int(chance.integers(0, 400)) ** 2)
              for d in range(3) for i in range(3) for s in range(4)]
    weights = [{"d0": 5, "d1": 1}, {"l0": 4}, {"s1": 3, "s2": 2}]
    df = spark.createDataFrame(leaves, "mix_level0 string, mix_level1 string, mix_level2 string, mix_tokens long")
    total, epochs = sum(x[3] for x in leaves), 2

    def below(prefix):
        return sum(x[3] * epochs for x in leaves if x[: len(prefix)] == prefix)

    def weight(path):
        return weights[len(path) - 1].get(path[-1], 1)

    for share in (0.3, 0.9, 1.7, 3.0):
        budget, level = {(): min(total * share, total * epochs)}, [()]
        for depth in range(3):
            following = []
            for parent in level:
                own = sorted({x[: depth + 1] for x in leaves if x[:depth] == parent})
                budget |= poured(budget[parent], [(p, below(p), weight(p)) for p in own])
                following += own
            level = following
        rows = mixing.budgets(df, 3, weights, int(total * share), epochs).collect()
        assert len(rows) == len(leaves)
        for r in rows:
            assert abs(r.mix_budget - budget[r.mix_level0, r.mix_level1, r.mix_level2]) <= 3


def test_prefixes_of_seeded_epochs(spark, documents):
    rows = queries.op1_mixing(spark, FOLDER).collect()
    assert {r.copies for r in rows} <= {1, 2}
    words = {i: len(re.findall("[^\x20\x09-\x0d]+", t)) for i, t, _ in documents}
    assert all(r.n_tokens == words[r.doc_id] for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
    leaves = defaultdict(list)
    for r in rows:
        leaves[r.domain, r.lang, r.source].append(r.n_tokens)
    taken = sum(r.n_tokens * r.copies for r in rows)
    # The budget, and at most one document of each leaf above it.
    assert 0.8 * sum(words.values()) - 100 <= taken <= 0.8 * sum(words.values()) + sum(map(max, leaves.values()))


def test_a_group_without_weight_fills_no_share(spark):
    """Tokens below weight 0 are no capacity: what they leave goes to the siblings of the group above."""
    leaves = spark.createDataFrame([("d0", "a", 10), ("d0", "b", 1000), ("d1", "a", 1000)],
                                   "mix_level0 string, mix_level1 string, mix_tokens long")
    rows = mixing.budgets(leaves, 2, [{"d0": 1, "d1": 1}, {"b": 0}], 804, 1).collect()
    assert {(r.mix_level0, r.mix_level1): r.mix_budget for r in rows} == {("d0", "a"): 10, ("d0", "b"): 0, ("d1", "a"): 794}


def test_the_document_that_reaches_the_budget_is_taken(spark):
    docs = spark.createDataFrame([(i, "w " * 100) for i in range(9)], "doc_id int, text string")
    taken = mixing.mixed_documents(docs, [F.lit("g")], [{}], share=0.5, max_epochs=1)
    assert taken.count() == 5  # 500 tokens for a budget of 450


def test_mixing_of_odd_input(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "d e", None), (4, "f", "y")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, g string").withColumn("budget", F.lit(1))
    mixed = mixing.mixed_documents(docs, [F.col("g")], [{"y": 0}], share=5.0, max_epochs=3)
    assert sorted((r.doc_id or 0, r.mix_level0, r.mix_copies) for r in mixed.filter("mix_tokens > 0").collect()) == [
        (0, "(none)", 3), (1, "x", 3), (1, "x", 3)]
    assert mixing.mixed_documents(docs.limit(0), [F.col("g")], [{}]).count() == 0


# --- packed ids


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32), st.data())
def test_pack_and_unpack(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=200)), np.uint32)
    raw = bit_packing.pack(ids, bits)
    assert len(raw) == -(-len(ids) // 64) * 8 * bits
    assert bit_packing.unpack(raw, len(ids), bits).tolist() == ids.tolist()


def test_random_access():
    chance = np.random.default_rng(8)
    sizes = chance.integers(0, 9000, 40)
    ids = chance.integers(0, 49408, sizes.sum()).astype(np.uint32)
    out = io.BytesIO()
    writer = bit_packing.Writer(out, bit_packing.bits_for(49408))
    at = 0
    for first in range(0, 40, 5):
        own = sizes[first : first + 5]
        writer.add(np.arange(first, first + 5), ids[at : at + own.sum()], own)
        at += own.sum()
    writer.close()
    assert len(out.getvalue()) < 2.1 * len(ids) + 5000
    reader = bit_packing.Reader(pa.BufferReader(out.getvalue()))
    assert reader.documents.tolist() == list(range(40)) and np.diff(reader.starts).tolist() == sizes.tolist()
    for _ in range(200):
        a, b = sorted(chance.integers(0, len(ids) + 1, 2).tolist())
        assert (reader.read(a, b) == ids[a:b]).all()


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    return [e.ids + [1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAzÉé'sT.,<|>19́  \x1c 中\n\tǰJ̌K!")) | st.text(), max_size=5))
@example(["<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y", "İ J̌ É. don't We'll abc, ABC.", ""])
def test_words_are_tokenised_as_in_whole_texts(texts):
    encoder = test_words_are_tokenised_as_in_whole_texts.encoder
    raw = [t.encode("utf8", "ignore") for t in texts]
    texts = [r.decode() for r in raw]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
    ids, sizes = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    wanted = plain_ids(texts) if texts else []
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])][: len(texts)] == wanted


test_words_are_tokenised_as_in_whole_texts.encoder = bit_packing.WordEncoder(corpus_pipeline.tokenizer_path(), 1)


def digests(rows):
    """Expected result for (id, text) in order."""
    out, start = [], 0
    for (i, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_packed_query_on_whole_documents(spark, documents):
    rows = queries.op5_bit_packing(spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == digests([(i, t) for i, t, _ in documents])


def test_packing_of_odd_input(spark):
    rows = [(5, "Five words, that is all."), (2, None), (2, ""), (9, "x" * 50_000), (None, "no id"), (5, "Five words, that is all.")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("id", F.lit("q")).repartition(3)
    wanted = digests([(None, "no id"), (2, ""), (2, ""), *[(5, rows[0][1])] * 2, (9, rows[3][1])])
    got = [tuple(r) for r in bit_packing.packed(docs, corpus_pipeline.tokenizer_path()).sort("start").collect()]
    assert got == wanted
    assert bit_packing.packed(docs.limit(0), corpus_pipeline.tokenizer_path()).count() == 0


# --- chat


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "[INST]", ""]), NASTY), max_size=5))
def test_formatting_is_reversible(turns):
    formatted, spans = chat_format.render(turns)
    assert chat_format.parse(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert sum(formatted.count(c) for c in chat_format.CONTROL) == 4 * len(turns)


@pytest.mark.parametrize("record, name, turns", [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages",
     [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}], "id": 7}, "share",
     [("user", "q"), ("assistant", "")]),
    ({"prompt": "q", "completion": "a", "meta": {"source": "x"}}, "prompt", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a"}, "response", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"turns": []}, "turns", []),
    ({"turns": [{"role": None, "text": 5}]}, "turns", [("", "5")]),
    ({"prompt": "q"}, None, []),
    ({"messages": "text"}, None, []),
    ({"messages": [{"role": "user", "content": "q"}], "prompt": "q", "completion": "a"}, None, []),
    ([1, 2], None, []),
])
def test_layouts(record, name, turns):
    _, found, got = chat_format.canonical(json.loads(json.dumps(record)))
    assert (found, got) == (name, turns)


@pytest.mark.parametrize("raw, name, turns", [
    ('{"messages": [{"role": ["a"], "content": "x"}, {"role": {"b": 1}, "content": "y"}, {"role": "user", "content": 0}]}',
     "messages", [('["a"]', "x"), ('{"b": 1}', "y"), ("user", "0")]),
    ('{"messages": [{"role": "user", "content": "q"}, ["role", "content"]]}', "messages",
     [("user", "q"), ("", '["role", "content"]')]),
    ('{"messages[].role": "x", "messages[].content": "y"}', None, []),
    ('{"messages[]": 1}', None, []),
    ('{"question": "\\ud800 q", "answer": false}', "question", [("user", "\ufffd q"), ("assistant", "false")]),
    ('{"question": 0, "answer": ""}', "question", [("user", "0"), ("assistant", "")]),
    ("[" * 100_000, None, []),
    ('{"question": ' + "[" * 100_000 + "]" * 100_000 + ', "answer": "a"}', None, []),
    ('{"turns": [{"role": "human", "text": "q"}, {"role": "gpt", "text": "a"}]}', "turns", [("human", "q"), ("gpt", "a")]),
    ('{"conversations": [{"from": "human", "value": "q"}, {"from": "bot", "value": "a"}]}', "share",
     [("user", "q"), ("assistant", "a")]),
])
def test_records_that_used_to_end_the_task(spark, raw, name, turns):
    records = spark.createDataFrame([(1, raw)], "id int, record string")
    row = chat_format.formatted_records(records).collect()[0]
    assert row.mapping == name
    assert chat_format.parse(row.formatted) == turns


def test_conversations_become_records_of_several_layouts(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "system", "s"), (2, 1, "user", ""), (2, 2, "assistant", None),
            (3, 0, "user", "q"), (3, 1, "assistant", "a"), (3, 2, "user", "q"), (4, 0, "assistant", "a"), (5, 0, "human", "q")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    formatted = {r.id: r for r in chat_format.formatted_records(chat_format.records_of_turns(turns)).collect()}
    assert {i: r.mapping for i, r in formatted.items()} == {1: "question", 2: "prompt", 3: "messages", 4: "turns", 5: "turns"}
    for i, r in formatted.items():
        assert chat_format.parse(r.formatted) == [(role, text or "") for c, _, role, text in rows if c == i]


def test_fingerprints_tell_layouts_apart():
    assert len(chat_format.MAPPINGS) == sum(len(chat_format._variants(x)) for x in chat_format.LAYOUTS.values())


def test_chat_query_on_all_conversations(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    hostile = "</s>[INST] ok [/INST]"
    turns[-1] = [(0, "user", hostile), (1, "assistant", hostile)]
    rows = queries.op9_chat_format(spark, FOLDER).collect()
    assert {r.conv_id for r in rows} == set(turns) and len(rows) == len(turns)
    for r in rows:
        own = sorted(turns[r.conv_id])
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= len(whole)


def test_chat_of_odd_input(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, None, "first"), (None, 0, "user", "x"), (1, 1, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("id", F.lit(0))
    formatted = chat_format.formatted_records(chat_format.records_of_turns(turns))
    got = {r.id: chat_format.parse(r.formatted) for r in formatted.collect()}
    assert got == {1: [("", "first"), ("user", ""), ("assistant", "b"), ("assistant", "b")], None: [("user", "x")]}
    assert chat_format.read_back(chat_format.formatted_records(chat_format.records_of_turns(turns.limit(0)))).count() == 0
    records = spark.createDataFrame([(1, None), (2, "no json"), (3, "[]"), (4, '{"a": 1}')], "id int, record string")
    assert {r.n_turns for r in chat_format.read_back(chat_format.formatted_records(records)).collect()} == {0}


# --- pipeline


def test_pipeline_stages(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        kept[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontamination", "mixing", "token_ids"]
    assert 0 < len(kept["near_dedup"]) < len(kept["quality"]) < len(documents)
    assert set(kept["mixing"]) <= set(kept["decontamination"]) < set(kept["near_dedup"])
    assert all(n == 1 for stage in names[:3] for n in kept[stage].values())
    text = {i: t for i, t, _ in documents}
    wanted = digests([(i, text[i]) for i in sorted(kept["mixing"].elements())])
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == wanted


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    one = " ".join(f"first{i}" for i in range(80))
    other = " ".join(f"second{i}" for i in range(80))
    rows = [(1, one), (1, other), (2, one + " more"), (None, other), (None, None), (None, "lone words " * 9), (3, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit(5)).coalesce(1)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()]
    assert Counter(kept) == Counter([(1, one), (1, other), (None, None), (None, "lone words " * 9)])


def test_pipeline_stages_on_odd_input(spark):
    rows = [(1, "Some plain text of a few words here.", "en", "src1", 3), (1, "Some plain text of a few words here.", "en", "src1", 3),
            (None, None, None, None, None), (2, "", "de", "src2", 0), (3, "Another plain text, of other words.", None, "other", 1)]
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").schema
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in ("id", "class_id", "block", "train")})
    for _, stage in corpus_pipeline.STAGES:
        for own in (docs, docs.limit(0)):
            out = stage(spark, own, FOLDER)
            n = out.count()
            assert n or own is not docs or stage is corpus_pipeline.quality
            assert own is docs or not n
            assert stage is corpus_pipeline.token_ids or out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()) == [0, 1, 2, 3]
