"""Target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

Features are all runs of 1 to ``max_words`` consecutive words, joined by one space; a feature's bucket
is its bytes' CRC-32 modulo ``buckets``. Words are runs of digits, lower-case letters and bytes from
128 on, after A to Z went to lower case. Three passes read the text, none shuffles it:

1. **Head.** Each part of about a megabyte names the words (and pairs of neighbouring words) that make
   up more than 1/``HEAD`` of it; their counts are added up on Spark, and those above 1/``HEAD`` of the
   whole corpus are the head: at most ``HEAD`` words of up to ``HEAD_BYTES`` bytes and ``HEAD`` pairs,
   whatever the input. It is broadcast: for words the exact CRC states (of the word, and of a space and
   the word), for pairs the bucket.
2. **Totals.** Every task adds its features up by bucket, at most ``buckets`` rows a task are shuffled.
   A word of the head takes its stored state, a tail word its CRC-32 directly; a pair of the head takes
   its stored bucket, other runs combine the states of their words (CRC-32 is linear: the state of the
   longer run is the state of the shorter one moved by the new word's length, xor the new state). Both
   ways give the CRC-32 of the feature's bytes, so the totals are exact and do not depend on the head.
3. **Weights.** A bucket's gain is floor(1000 * ln of the smoothed ratio of its shares in target and
   corpus); a document's weight is the floored mean of the gains of its features.

Drawing: score = weight + a Gumbel number from a hash of seed and id, so the highest scores are a
weighted sample without replacement. Scores are integers within a range given by ln of the corpus size
and of 2^32 (less than 100,000 values), so a histogram on the driver gives the cut exactly. Rows from the
cut on are range-partitioned and sorted; a row's rank is its place plus the rows of the partitions before.

Nulls and odd input: a null or empty text has no feature, weight 0, and is returned undrawn; a null id
counts as empty text in the hash and as smallest in ties. Rows of equal id and score take different
ranks in an arbitrary, but stored, order. Empty documents give no rows; an empty target gives every
feature a gain from smoothing alone. Only id and text are read, further columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm import text
from terrier.session import written

HEAD = 8192
HEAD_BYTES = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _moves() -> np.ndarray:
    """Tables that move a CRC-32 past 2^b zero bytes, for each bit b and byte of the state."""
    one = np.array([zlib.crc32(bytes([v])) ^ zlib.crc32(b"\0") for v in range(256)], np.uint32)
    tables = np.zeros((32, 4, 256), np.uint32)
    states = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    tables[0] = one[states & 255] ^ (states >> np.uint32(8))
    for b in range(1, 32):
        tables[b] = _looked_up(tables[b - 1], tables[b - 1])
    return tables


def _looked_up(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = table[0][state & 255]
    for j in (1, 2, 3):
        out = out ^ table[j][(state >> np.uint32(8 * j)) & 255]
    return out


_MOVES = _moves()
_SPACE = np.uint32(zlib.crc32(b" "))


def moved(state: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 states as they count in a text that goes on for ``n_bytes`` more."""
    state = state.copy()
    for b in range(int(n_bytes.max(initial=0)).bit_length()):
        at = np.flatnonzero(n_bytes >> b & 1)
        state[at] = _looked_up(_MOVES[b], state[at])
    return state


class Head:
    """Frequent words with their states, frequent pairs (by word numbers) with their buckets."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.words = sorted(words)
        self.states = np.array([zlib.crc32(w) for w in self.words], np.uint32)
        self.spaced = np.array([zlib.crc32(b" " + w) for w in self.words], np.uint32)
        number = {w: i for i, w in enumerate(self.words)}
        known = sorted((number[a] * len(words) + number[b], zlib.crc32(a + b" " + b) % buckets)
                       for a, b in pairs if a in number and b in number)
        self.pairs = np.array([k for k, _ in known], np.int64)
        self.pair_buckets = np.array([v for _, v in known], np.int64)


class Runs:
    """The words of a part: their document, distinct words, and buckets of their runs."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.n_docs = len(offsets) - 1
        letter = _LETTER[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        start = np.flatnonzero(letter & (np.r_[True, ~letter[:-1]] | cut[:-1])) if len(data) else offsets[:0]
        end = np.flatnonzero(letter & (np.r_[~letter[1:], True] | cut[1:])) + 1 if len(data) else start
        self.doc = np.searchsorted(offsets, start, "right") - 1
        ends = np.r_[0, np.cumsum(end - start)]
        letters = _LOWER[data[letter]]
        column = pa.Array.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters)])
        coded = column.dictionary_encode()
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def buckets(self, head: Head, max_words: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of run: the documents and buckets of all runs of that length."""
        of_head = pc.index_in(self.distinct, value_set=pa.array(head.words, pa.large_binary()))
        number = of_head.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        tail = np.flatnonzero(number < 0)
        states = np.zeros(len(number), np.uint32)
        states[number >= 0] = head.states[number[number >= 0]]
        direct = self.distinct.take(pa.array(tail)).to_pylist()
        states[tail] = np.array([zlib.crc32(w) for w in direct], np.uint32)
        run = states[self.word]
        yield self.doc, run.astype(np.int64) % buckets
        if max_words == 1:
            return
        sizes = pc.binary_length(self.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        spaced = np.zeros(len(number), np.uint32)
        spaced[number >= 0] = head.spaced[number[number >= 0]]
        spaced[tail] = moved(np.full(len(tail), _SPACE), sizes[tail]) ^ states[tail]
        for n in range(2, max_words + 1):
            whole = self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :]
            added = self.word[n - 1 :]
            run = moved(run[:-1], 1 + sizes[added]) ^ spaced[added] if n > 2 else run
            if n > 2:
                found = run.astype(np.int64) % buckets
            else:
                run, found = self._pairs(run[:-1], number, sizes, spaced, head, buckets)
            yield self.doc[: len(whole)][whole], found[whole]

    def _pairs(self, first, number, sizes, spaced, head, buckets) -> tuple[np.ndarray, np.ndarray]:
        """States of all neighbouring words, and their buckets, of the head's pairs as stored."""
        a, b = self.word[:-1], self.word[1:]
        state = moved(first, 1 + sizes[b]) ^ spaced[b]
        found = state.astype(np.int64) % buckets
        if len(head.pairs):
            key = np.where((number[a] >= 0) & (number[b] >= 0), number[a] * len(head.words) + number[b], -1)
            at = np.minimum(np.searchsorted(head.pairs, key), len(head.pairs) - 1)
            known = head.pairs[at] == key
            found[known] = head.pair_buckets[at[known]]
        return state, found


def frequent(docs: DataFrame, text_column: str, max_words: int, buckets: int) -> Head:
    """The head of a corpus: words, and pairs where runs of two are wanted, above 1/``HEAD`` of it."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text.parts(batch.column(0)):
                runs = Runs(data, offsets)
                sizes = pc.binary_length(runs.distinct).to_numpy(zero_copy_only=False)
                short = sizes <= HEAD_BYTES
                counts = np.bincount(runs.word, minlength=len(sizes))
                often = np.flatnonzero((counts * HEAD > len(runs.word)) & short)
                yield _rows(runs, often, None, counts[often])
                if max_words > 1 and len(runs.word) > 1:
                    both = (runs.doc[1:] == runs.doc[:-1]) & short[runs.word[1:]] & short[runs.word[:-1]]
                    keys, n = np.unique(
                        runs.word[:-1][both] * len(sizes) + runs.word[1:][both], return_counts=True)
                    often = n * HEAD > len(runs.word)
                    yield _rows(runs, *np.divmod(keys[often], len(sizes)), n[often])
                # The number of words, as a row without a word.
                yield pa.record_batch([pa.array([None], pa.binary()), pa.array([None], pa.binary()),
                                       pa.array([len(runs.word)], pa.int64())], ["a", "b", "n"])

    counted = docs.select(text_column).mapInArrow(local, "a binary, b binary, n long")
    summed = written(counted.groupBy("a", "b").agg(F.sum("n").alias("n")), "head-counts")
    total = summed.filter("a is null").agg(F.max("n")).first()[0] or 0
    rows = summed.filter(F.col("a").isNotNull() & (F.col("n") * HEAD > F.lit(total))).collect()
    return Head([bytes(r.a) for r in rows if r.b is None],
                [(bytes(r.a), bytes(r.b)) for r in rows if r.b is not None], buckets)


def _rows(runs: Runs, a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    named = runs.distinct.cast(pa.binary())
    second = pa.nulls(len(a), pa.binary()) if b is None else named.take(pa.array(b))
    return pa.record_batch([named.take(pa.array(a)), second, pa.array(n, pa.int64())], ["a", "b", "n"])


def totals(docs: DataFrame, text_column: str, head: Head, max_words: int, buckets: int) -> np.ndarray:
    """Features of all documents by bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in text.parts(batch.column(0)):
                for _, found in Runs(data, offsets).buckets(shared.value, max_words, buckets):
                    own += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(own)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(own[at])], ["bucket", "n"])

    counted = docs.select(text_column).mapInArrow(local, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of (t + 1) * (S + buckets) / ((s + 1) * (T + buckets))) of every bucket."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, head: Head, gain: np.ndarray, max_words: int = 1,
            id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, gain = shared.value
        for batch in batches:
            for first, data, offsets in text.parts(batch.column(1)):
                runs = Runs(data, offsets)
                n = np.zeros(runs.n_docs, np.int64)
                total = np.zeros(runs.n_docs, np.int64)
                for doc, found in runs.buckets(head, max_words, len(gain)):
                    n += np.bincount(doc, minlength=runs.n_docs)
                    # Documents stand in order: a sum is a difference of running totals.
                    running = np.r_[0, np.cumsum(gain[found])]
                    edges = np.searchsorted(doc, np.arange(runs.n_docs + 1))
                    total += running[edges[1:]] - running[edges[:-1]]
                yield pa.record_batch(
                    [batch.column(0).slice(first, runs.n_docs), pa.array(runs.counts(), pa.int64()),
                     pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["id", "n_words", "n_features", "weight"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(local, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(seed: str, id_column: str):
    """floor(-1000 * ln(-ln(u))) for u from the first 32 bits of SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
                    .cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, max_words: int = 1,
              buckets: int = 10_000, min_words: int = 20, seed: str = "2024",
              id_column: str = "doc_id", text_column: str = "text",
              target_text_column: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document.

    The floor of ``percent`` in 100 of the documents of at least ``min_words`` words are drawn: those of
    the highest scores, ranked from 1, ties to the smaller id. Others have a null rank. Runs jobs.
    """
    head = frequent(docs, text_column, max_words, buckets)
    gain = gains(totals(docs, text_column, head, max_words, buckets),
                 totals(target, target_text_column, head, max_words, buckets))
    weighed = weights(docs, head, gain, max_words, id_column, text_column)
    scores = written(weighed.withColumn("score", F.col("weight") + gumbel(seed, "id"))
                     .withColumn("row", F.monotonically_increasing_id()), "scores")
    fit = F.col("n_words") >= min_words
    cut, wanted = _cut(scores.filter(fit), percent)
    empty = F.lit(None).cast("long")
    if not wanted:
        return scores.drop("row").withColumn("rank", empty)
    high = fit & (F.col("score") >= cut)
    # The row's number only parts equal ids of equal score, so that no key is too large for a range.
    ordered = written(
        scores.filter(high).repartitionByRange(F.desc("score"), F.asc("id"), F.asc("row"))
        .sortWithinPartitions(F.desc("score"), F.asc("id"), F.asc("row"))
        .withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    rows = sorted(ordered.groupBy(part.alias("part")).count().collect())  # one a range partition
    before, starts = 0, []
    for row in rows:
        starts.append((row["part"], before))
        before += row["count"]
    starts = docs.sparkSession.createDataFrame(starts, "part long, start long")
    rank = F.col("start") + F.col("place") - F.shiftleft("part", 33) + 1
    ranked = ordered.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "rank", F.when(rank <= wanted, rank))
    columns = ["id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).union(
        scores.filter(~high).withColumn("rank", empty).select(*columns))


def _cut(fit: DataFrame, percent: int) -> tuple[int, int]:
    """The lowest score that is drawn, and the number drawn."""
    histogram = sorted(fit.groupBy("score").count().collect(), reverse=True)
    wanted = percent * sum(n for _, n in histogram) // 100
    passed = 0
    for score, n in histogram:
        passed += n
        if passed >= wanted:
            return score, wanted
    return 0, 0
