"""Near-duplicate classes by order MinHash, verified by banded alignment.

Similarity of two texts is that of their sequences of five-word shingles: ``m / (a + b - m)``, where
``a`` and ``b`` count the shingles and ``m`` those that an alignment matches in order (the longest
common subsequence). Texts of 0.8 or more are linked; classes are the connected components.

Sketches. Shingles get their occurrence number, so that repeats count. For each of ``SKETCHES`` hash
functions the ``KEPT`` smallest labelled shingles are listed in the order of the text: unlike a plain
MinHash, equal sketches ask for equal order, as edit similarity does. Texts at 0.8 share one sketch
with probability about 0.33, so 32 sketches miss a pair of them with 3 in a million (6 in a million
at 65 shingles). Texts of fewer shingles than ``KEPT`` smallest ones or little more would be missed far
more often, so pairs of texts of at most ``SHORT`` shingles do not hang on sketches.

Short texts. Similar texts share at least 0.8 of the labelled shingles of either, so in any order of all
shingles their first ``n - ceil(0.8 * n) + 1`` have one in common. These, rarest first, are the keys of
further buckets: two similar short texts always share a bucket. A shingle that no other text has takes
its place in that order but needs no bucket.

Candidates without pairs of whole groups. Equal word sequences are one text first. Then every text is
paired with the smallest and the largest id of each of its buckets only; verified pairs give classes.
A bucket whose texts all are of one class has nothing to add. The others are open and get an exact
round: their texts meet as shingle sequences, in cells of at most ``CELL`` texts (a larger bucket is
spread over all pairs of its cells). There all texts of different classes that lengths allow are
compared by one matrix product, which gives the shingles that two texts share at most; where 0.8 is
still possible they are aligned, unless links found before join them already. A cell sends only the
links that join classes, and these are verified on the texts. No pair is given up: those left out are
known to be of one class or too far apart.

Alignment. Common ends are cut off, then the longest common subsequence is found a machine word of
cells at a time, matches counting only within the band of diagonals that 0.8 allows.

Words are maximal runs of bytes other than white space, A to Z in lower case; a text of fewer than five
words is one shingle. Texts without a word, null or empty, are linked with nothing: their class is
their own id. Rows of one id are one document: if their texts differ, all are in one class. A null id
is a document like others, of class null. Repeated rows give repeated rows. An empty table gives an
empty result. Only the id and the text are read, so further columns may have any name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm import text
from terrier.llm.components import components
from terrier.session import written

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32
KEPT = 5
SHORT = 64
_SEEDS = text.seeds(SKETCHES, 3)
_PLACES = text.seeds(KEPT, 4) | np.uint64(1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CELL = 1024
SALTS = 32
_COLUMNS = 1 << 13  # shingles in one matrix product
_WIDE = 1 << 20  # cells of the table of hash functions and shingles that is held at once


def sketches(values: np.ndarray) -> np.ndarray:
    """Order sketches of one text's labelled shingles, one for each hash function."""
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, _WIDE // max(1, len(values)))
    kept = min(KEPT, len(values))
    for first in range(0, SKETCHES, step):
        seeds = _SEEDS[first : first + step, None]
        ranks = text.mixed(values[None, :] ^ seeds)
        if len(values) > kept:
            at = np.sort(np.argpartition(ranks, kept - 1, axis=1)[:, :kept], axis=1)
            chosen = values[at]
        else:
            chosen = np.broadcast_to(values, ranks.shape)
        out[first : first + step] = text.mixed(
            (chosen * _PLACES[:kept]).sum(1, dtype=np.uint64) ^ seeds[:, 0])
    return out


def _sketched(batches):
    for batch in batches:
        digests, counts, signs, short = [], [], [], []
        for _, data, offsets in text.parts(batch.column(1)):
            words = text.Words(data, offsets)
            hashes = words.hashes()
            values, doc = text.shingles(hashes, words.doc, words.n_docs, SHINGLE)
            label = text.occurrences(values, doc).astype(np.uint64)
            values = text.mixed(values + label * _GOLDEN)
            at = np.searchsorted(doc, np.arange(words.n_docs + 1))
            word_at = np.searchsorted(words.doc, np.arange(words.n_docs + 1))
            for a, b, x, y in zip(at, at[1:], word_at, word_at[1:]):
                counts.append(b - a)
                short.append(values[a:b].view(np.int64) if 0 < b - a <= SHORT else None)
                if b == a:
                    digests.append(None)
                    signs.append(None)
                    continue
                # Two sums with different multipliers by place: 128 bits for the word sequence.
                place = np.arange(1, y - x + 1, dtype=np.uint64)
                own = hashes[x:y]
                digests.append(np.array([
                    text.mixed(own + place * _GOLDEN).sum(dtype=np.uint64),
                    text.mixed((own ^ _GOLDEN) * (2 * place + np.uint64(1))).sum(dtype=np.uint64),
                ], np.uint64).tobytes())
                signs.append(sketches(values[a:b]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()),
             pa.array(signs, pa.list_(pa.int64())), pa.array(short, pa.list_(pa.int64()))],
            names=["id", "digest", "n", "sketches", "short"])


def _sequence(raw: str) -> np.ndarray:
    """The shingles of one text, in order."""
    found = []
    for _, data, offsets in text.parts(pa.array([raw], pa.string())):
        words = text.Words(data, offsets)
        found.append(text.shingles(words.hashes(), words.doc, 1, SHINGLE)[0])
    return np.concatenate(found)


def common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence whose matches lie within ``band`` of the diagonal.

    Row by row over ``b``; one integer holds a row, a zero bit for each step up in the table.
    """
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    shared = np.intersect1d(a, b)
    if not len(shared):
        return head + tail
    places: dict[int, int] = defaultdict(int)
    for i in np.flatnonzero(np.isin(a, shared)).tolist():
        places[int(a[i])] |= 1 << i
    all_ones = (1 << len(a)) - 1
    row = all_ones
    within = (1 << (2 * band + 1)) - 1
    for j in np.flatnonzero(np.isin(b, shared)).tolist():
        near = within << (j - band) if j >= band else within >> (band - j)
        match = places[int(b[j])] & near
        step = row & match
        row = ((row + step) | (row - step)) & all_ones
    return head + tail + len(a) - row.bit_count()


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    need = similarity / (1 + similarity) * (len(a) + len(b))
    if min(len(a), len(b)) < need - 1e-9:
        return False
    # Matched cells of an alignment with ``need`` matches leave so few rows and columns out.
    band = int(max(len(a), len(b)) - need + 1e-9)
    return common(a, b, band) >= need - 1e-9


def _verifying(similarity: float):
    def verify(batches):
        last, sequence = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x = x.as_py()
                if x != last:  # pairs of one representative come one after another
                    last, sequence = x, _sequence(x)
                if similar(sequence, _sequence(y.as_py()), similarity):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return verify


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The ``pairs`` (a, b) of ids in ``texts`` (id, text) that are similar."""
    def side(name):
        return texts.select(F.col("id").alias(name), F.col("text").alias(f"text_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    schema = "a long, b long"
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verifying(similarity), schema)


def _short(batches):
    """Shingle sequences in 32 bits each: an equal pair may look equal, a different one seldom does."""
    for batch in batches:
        found = [_sequence(t).astype(np.uint32).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])


def shared_shingles(sequences: list[np.ndarray]) -> np.ndarray:
    """For all pairs of texts, how many shingles they share, repeats counting."""
    n = len(sequences)
    owner = np.repeat(np.arange(n), [len(x) for x in sequences])
    values = np.concatenate(sequences).astype(np.uint64)
    label = text.occurrences(values, owner).astype(np.uint64)
    _, column, times = np.unique(text.mixed(values + label * _GOLDEN), return_inverse=True, return_counts=True)
    often = np.flatnonzero(times > 1)  # others are shared with nobody
    place = np.full(len(times), -1)
    place[often] = np.arange(len(often))
    column = place[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float32)
    for first in range(0, len(often), _COLUMNS):
        a, b = np.searchsorted(column, [first, first + _COLUMNS])
        has = np.zeros((n, min(_COLUMNS, len(often) - first)), np.float32)
        has[owner[a:b], column[a:b] - first] = 1
        out += has @ has.T
    return out


def joining_links(ids: list[int], classes: list[int], sequences: list[np.ndarray], allowed: np.ndarray,
                  similarity: float) -> list[tuple[int, int]]:
    """Pairs of similar texts that join all classes which similar texts of a cell connect.

    ``allowed`` says which pairs to look at.
    """
    size = np.array([len(x) for x in sequences])
    least, most = np.minimum.outer(size, size), np.maximum.outer(size, size)
    numbers = np.unique(classes, return_inverse=True)[1]
    allowed = allowed & (numbers[:, None] != numbers) & (least >= similarity * most - 1e-9)
    if not allowed.any():
        return []
    need = similarity / (1 + similarity) * np.add.outer(size, size)
    shared = shared_shingles(sequences)
    left, right = np.nonzero(np.triu(allowed & (shared >= need - 1e-3), 1))
    order = np.argsort(-(shared / need)[left, right], kind="stable")
    label, out = numbers.copy(), []
    for i, j in zip(left[order].tolist(), right[order].tolist()):
        if label[i] != label[j] and similar(sequences[i], sequences[j], similarity):
            label[label == label[j]] = label[i]
            out.append((ids[i], ids[j]))
    return out


def _settling(similarity: float):
    """Rows come sorted by cell: ``cell``, ``one``, ``other``, ``side``, ``id``, ``class``, ``shingles``."""

    def settle(rows):
        _, one, other, side, ids, classes, raw = zip(*rows)
        side = np.array(side)
        allowed = np.ones((len(ids), len(ids)), bool)
        if one[0] != other[0]:
            allowed = side[:, None] != side  # texts of one side meet in a cell of their own
        return joining_links(
            ids, classes, [np.frombuffer(x, np.uint32) for x in raw], allowed, similarity)

    def settle_all(batches):
        waiting = []
        for batch in batches:
            links = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if waiting and waiting[0][:3] != row[:3]:
                    links += settle(waiting)
                    waiting = []
                waiting.append(row)
            yield _links(links)
        if waiting:
            yield _links(settle(waiting))

    return settle_all


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())],
        names=["a", "b"])


def settled(open_: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between the classes of open buckets.

    ``open_`` has ``sketch``, ``value``, ``members`` of the bucket, ``id`` and ``class``.
    """
    short = texts.mapInArrow(_short, "id long, shingles binary")
    cells = F.ceil(F.col("members") / F.lit(CELL)).cast("int")
    dealt = (
        open_.withColumn("cells", cells)
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select(F.xxhash64("sketch", "value").alias("cell"), F.least("own", "met").alias("one"),
                F.greatest("own", "met").alias("other"), F.col("own").alias("side"), "id", "class")
    )
    key = ["cell", "one", "other"]
    sorted_ = (
        dealt.join(short, "id").select(*key, "side", "id", "class", "shingles")
        .repartition(*key).sortWithinPartitions(*key)
    )
    return sorted_.mapInArrow(_settling(similarity), "a long, b long")


def prefix_buckets(firsts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``id``, ``sketch``, ``value`` of the buckets in which all similar short texts meet.

    ``firsts`` has ``digest``, ``id`` and the labelled shingles ``short``, null for a longer text.
    """
    own = firsts.select("digest", "id", F.size("short").alias("n"), F.explode("short").alias("value"))
    rows = own.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    ranked = own.join(rows, "value").groupBy("digest", "id", "n").agg(
        F.array_sort(F.collect_list(F.struct("rows", "value"))).alias("known"))
    lone = F.col("n") - F.size("known")
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-9)) + 1
    first = F.slice("known", F.lit(1), F.greatest(prefix - lone, F.lit(0)).cast("int"))
    return ranked.select("id", F.lit(SKETCHES).alias("sketch"), F.explode(first.getField("value")).alias("value"))


def _classed(nodes: DataFrame, classes: DataFrame, key: str = "id") -> DataFrame:
    return nodes.join(classes.withColumnRenamed("node", key), key, "left").withColumn(
        "class", F.coalesce("component", F.col(key))).drop("component")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``id`` and ``class_id`` (the smallest id of its class) for every row."""
    own = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    sketched = written(
        own.mapInArrow(_sketched, "id long, digest binary, n long, sketches array<long>, short array<long>"),
        "sketches")
    known = sketched.filter("digest is not null and id is not null")
    # One row for each word sequence, under its smallest id: copies are reduced on the map side.
    copies = written(known.groupBy("digest").agg(
        F.min(F.struct("id", "sketches", "short")).alias("first"), F.count(F.lit(1)).alias("rows")), "copies")
    firsts = copies.select("digest", "first.id", "first.sketches", "first.short")
    buckets = firsts.select("id", F.posexplode("sketches").alias("sketch", "value")).unionByName(
        written(prefix_buckets(firsts, similarity), "prefixes"))
    hubs = buckets.groupBy("sketch", "value").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("members")
    ).filter("low < high")
    # Only buckets of several texts go on.
    shared = written(buckets.join(hubs, ["sketch", "value"]), "buckets")
    pairs = shared.select("id", F.explode(F.array("low", "high")).alias("hub")).filter("id != hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    pairs = written(pairs, "pairs")
    texts = written(own.join(shared.select("id").distinct(), "id", "left_semi")
                    .filter("text is not null").distinct(), "texts")
    links = written(verified(pairs, texts, similarity), "links")
    classes = components(links)

    # What the first round has left: buckets of several classes.
    labelled = _classed(shared.select("sketch", "value", "members", "id"), classes)
    several = labelled.groupBy("sketch", "value").agg(
        F.min("class").alias("least"), F.max("class").alias("most")).filter("least < most")
    open_ = written(labelled.join(several.select("sketch", "value"), ["sketch", "value"]), "open-buckets")
    open_texts = texts.join(open_.select("id").distinct(), "id", "left_semi")
    found = written(settled(open_, open_texts, similarity).distinct(), "found")
    extra = verified(found, texts, similarity)
    # Copies hang on the first of their word sequence, and rows of one id are one document. Copies of one
    # text may be a third of all rows: they are spread over ``SALTS`` tasks.
    several = copies.filter("rows > 1").select(
        "digest", F.col("first.id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = known.select("digest", F.col("id").alias("b"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    same = salted.join(several, ["digest", "salt"]).filter("a != b").select("a", "b").distinct()
    joined = classes.select(F.col("component").alias("a"), F.col("node").alias("b"))
    whole = components(joined, extra, same)
    return _classed(own.select("id"), whole).select("id", F.col("class").alias("class_id"))
