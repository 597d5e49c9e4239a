import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from terrier.llm import order_minhash, queries
from terrier.llm.components import components

FOLDER = "/root/testdata/sf0.01"


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def shingles(text):
    words = text.split()
    size = min(5, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []


def classes(rows, similarity=0.8):
    """Brute force over all pairs of (id, text)."""
    label = {i: i for i, _ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    listed = [(i, shingles(t or "")) for i, t in rows]
    for n, (i, a) in enumerate(listed):
        for j, b in listed[:n]:
            if a and b and min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                m = longest_common(a, b)
                if m >= similarity * (len(a) + len(b) - m) - 1e-9:
                    x, y = sorted((root(i), root(j)))
                    label[y] = x
    return {i: root(i) for i, _ in rows}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), max_size=25))
def test_common_is_the_longest_subsequence(a, b):
    a, b = np.array(a, np.uint64), np.array(b, np.uint64)
    assert order_minhash.common(a, b, 30) == longest_common(a.tolist(), b.tolist())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.data())
def test_the_band_does_not_change_the_verdict(a, data):
    b = list(a)
    for _ in range(data.draw(st.integers(0, 6))):
        at = data.draw(st.integers(0, len(b)))
        b[at : at + data.draw(st.integers(0, 2))] = data.draw(st.lists(st.integers(0, 9), max_size=2))
    if not b:
        return
    m = longest_common(a, b)
    wanted = m >= 0.8 * (len(a) + len(b) - m) - 1e-9
    assert order_minhash.similar(np.array(a, np.uint64), np.array(b, np.uint64)) == wanted


def edited(chance, words, n):
    words = list(words)
    for _ in range(n):
        words[chance.randrange(len(words))] = f"w{chance.randrange(10**6)}"
    return words


def test_classes_agree_with_all_pairs(spark):
    chance = random.Random(3)
    rows = []
    for group in range(12):
        base = [f"w{chance.randrange(400)}" for _ in range(chance.choice([6, 60, 150, 300]))]
        for _ in range(chance.randrange(1, 14)):
            # A share of edits around the threshold, and chains of them.
            base = edited(chance, base, chance.randrange(0, max(1, len(base) // 40) + 1))
            rows.append((len(rows), " ".join(base)))
    common = " ".join(f"c{i}" for i in range(60))
    rows += [(len(rows) + i, " ".join(f"o{i}x{j}" for j in range(40)) + " " + common) for i in range(25)]
    chance.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == classes(sorted(rows))


def test_short_texts_agree_with_all_pairs(spark):
    """8 against 9 words share 4 of 5 shingles; 9 against 10, 12 against 14, 16 against 19 are close too."""
    chance = random.Random(5)
    rows = []
    for group in range(120):
        words = [f"g{group}x{i}" for i in range(chance.choice([9, 10, 14, 19, 40, 66]))]
        cut = -(-(len(words) - 4) * 4 // 5) + 4
        rows.append((len(rows), " ".join(words)))
        rows.append((len(rows), " ".join(words[:cut])))
        rows.append((len(rows), " ".join(words[len(words) - cut + chance.randrange(2) :])))
    line = [f"c{i}" for i in range(8)]  # a line that many texts hold, and its like
    rows += [(len(rows) + i, " ".join(line + [f"o{i}"])) for i in range(20)]
    rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(line[:7]))]
    rows += [(len(rows) + i, "ab ab " * i) for i in range(1, 9)]
    docs = spark.createDataFrame(chance.sample(rows, len(rows)), "doc_id long, text string")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == classes(sorted(rows))


def test_query_on_whole_documents(spark, documents):
    got = {r.doc_id: r.class_id for r in queries.op3_order_minhash(spark, FOLDER).collect()}
    lower = {c: c + 32 for c in range(65, 91)}
    wanted = {}
    # Texts that share no shingle cannot be similar: compare within groups of a common shingle.
    label = {i: i for i, _, _ in documents}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    listed = {i: shingles(t.translate(lower)) for i, t, _ in documents}
    owners: dict = {}
    for i, runs in listed.items():
        for run in set(runs):
            owners.setdefault(run, []).append(i)
    pairs = {}
    for own in owners.values():
        for n, i in enumerate(own):
            for j in own[:n]:
                pairs[j, i] = pairs.get((j, i), 0) + 1
    for (i, j), n in pairs.items():
        a, b = listed[i], listed[j]
        if n >= 0.4 * min(len(set(a)), len(set(b))) and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
            m = order_minhash.common(*(np.array([hash(x) % 2**63 for x in y], np.uint64) for y in (a, b)), 10**6)
            if m >= 0.8 * (len(a) + len(b) - m) - 1e-9:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    wanted = {i: root(i) for i in listed}
    assert got == wanted


def test_nulls_repeats_and_foreign_columns(spark):
    long = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame(
        [(5, long, "a"), (5, long, "b"), (3, long.upper(), "c"), (7, None, "d"), (8, "", "e"), (9, "  ", "f"),
         (None, long, "g"), (2, "two words", "h"), (1, "two words", "i"), (4, "x", "j"), (4, long, "k")],
        "doc_id long, text string, id string")
    got = sorted((r.id or 0, r.class_id or 0) for r in order_minhash.near_duplicates(docs).collect())
    assert got == [(0, 0), (1, 1), (2, 1), (3, 3), (4, 3), (4, 3), (5, 3), (5, 3), (7, 7), (8, 8), (9, 9)]
    assert order_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    chance = random.Random(1)
    nodes = list(range(300))
    chance.shuffle(nodes)
    edges = [(nodes[i], nodes[i + 1]) for i in range(120)]  # a long chain
    edges += [(nodes[150], nodes[i]) for i in range(151, 220)]  # a star
    edges += [(nodes[250], nodes[250]), (nodes[251], nodes[252]), (nodes[252], nodes[251])]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    found = {r.node: r.component for r in got.collect()}
    for group in (nodes[:121], nodes[150:220], nodes[251:253]):
        low = min(group)
        assert {found.get(n, low if n == low else None) for n in group} == {low}
    assert nodes[250] not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=12), min_size=1, max_size=6))
def test_shared_shingles_count_repeats(lists):
    from collections import Counter

    got = order_minhash.shared_shingles([np.array(x, np.uint32) for x in lists])
    assert got.tolist() == [[(Counter(a) & Counter(b)).total() if i != j else got[i][i] for j, b in enumerate(lists)]
                            for i, a in enumerate(lists)]


def test_buckets_beyond_one_cell(spark, monkeypatch):
    """A chain of edits whose ends differ, in buckets spread over many cells."""
    monkeypatch.setattr(order_minhash, "CELL", 3)
    chance = random.Random(9)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(40):
        base = edited(chance, base, 2)
        rows.append((i, " ".join(base)))
    chance.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == classes(sorted(rows))
