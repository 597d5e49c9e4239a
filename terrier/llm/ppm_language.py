"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of the bytes that
followed them. A byte is coded in its longest context that the tree has: with probability
``c / (C + T)`` if it was seen there (``c`` of ``C`` times, among ``T`` different bytes), otherwise an
escape of probability ``T / (C + T)`` leads to the context without its first byte, and in the end to
``1 / 256``. Counts are frozen after training, so the code length of a text in a language is a plain
sum of logarithms. The language with the shortest code wins (ties: first by name); the score is its
probability among all languages given these exact code lengths.

Training is on a bounded sample: of each language about ``max_rows`` (1,000) rows, those whose hashed
id is below that share of the hash range (rows of one id go together; without an id the text is hashed).
Grams are counted by Spark; the model keeps all contexts of the sample, whose size bounds what is sent to
the executors. Lookup tables hold all languages side by side: one table lookup per byte and context length
finds the gram, one row of numbers its code lengths.
Documents are read once and not shuffled.

Nulls: a null text, or one without a letter, is ``und`` with score 0; rows of null language or text are
not learned. Repeated rows are learned and predicted one by one.
Without any training row every text is ``und``. An empty table gives an empty result. Only the id, the
text and the language are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.llm import text
from terrier.llm.sampling import hashed_share

ORDER = 3
MAX_ROWS = 1_000


class Model:
    """Gram tables. Row 0 of every table stands for a gram that no language has seen."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        """``counts[k]``: sorted grams of k + 1 bytes as numbers, and their counts by language."""
        self.languages = languages
        n = len(languages)
        used = np.unique(counts[0][0]) if counts else np.zeros(0, np.int64)
        self.symbol = np.zeros(256, np.int64)  # 0: never seen
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.children, self.bits, self.escapes = [], [], []
        contexts, above = np.zeros(1, np.int64), np.full((1, n), -8.0)  # a byte without any context
        for k, (grams, seen) in enumerate(counts):
            prefix = np.searchsorted(contexts, grams >> 8) if k else np.zeros(len(grams), np.int64)
            total = np.zeros((len(contexts), n))
            np.add.at(total, prefix, seen)
            different = np.zeros((len(contexts), n))
            np.add.at(different, prefix, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(different / (total + different)), 0.0)
                direct = np.log2(seen / (total + different)[prefix])
            if k:
                suffix = 1 + np.searchsorted(self.grams, grams & ((1 << 8 * k) - 1))
                shorter = self.bits[-1][suffix]
            else:
                shorter = np.broadcast_to(above, seen.shape)
            bits = np.where(seen > 0, direct, escape[prefix] + shorter)
            table = np.zeros((len(contexts) + (k > 0)) * self.width, np.int32)
            table[(prefix + (k > 0)) * self.width + self.symbol[grams & 255]] = np.arange(1, len(grams) + 1)
            self.children.append(table)
            self.bits.append(np.vstack([np.zeros((1, n)), bits]))
            self.escapes.append(escape if k == 0 else np.vstack([np.zeros((1, n)), escape]))
            self.grams = contexts = grams
        self.unseen = above[0]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every document in every language."""
        n = len(data)
        symbols = self.symbol[data]
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        place = np.arange(n) - offsets[doc]
        found, context = [], np.zeros(n, np.int64)
        for k, table in enumerate(self.children):
            gram = table[context * self.width + symbols].astype(np.int64)
            if k:
                gram[(context == 0) | (place < k)] = 0
            found.append(gram)
            context = np.r_[0, gram[:-1]] if n else gram
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        open_ = np.arange(n)
        for k in range(len(found) - 1, -1, -1):
            own = found[k][open_]
            hit = open_[own > 0]
            self._add(out, doc[hit], self.bits[k][own[own > 0]])
            open_ = open_[own == 0]
            if k:  # escape from the context, if the text has one of that length and it is known
                inside = open_[place[open_] >= k]
                self._add(out, doc[inside], self.escapes[k][found[k - 1][inside - 1]])
            else:
                self._add(out, doc[open_], np.broadcast_to(
                    self.escapes[0][0] + self.unseen, (len(open_), len(self.languages))))
        return -out

    @staticmethod
    def _add(out: np.ndarray, doc: np.ndarray, values: np.ndarray) -> None:
        for j in range(out.shape[1]):
            out[:, j] += np.bincount(doc, values[:, j], len(out))

    def predict(self, column) -> tuple[pa.Array, pa.Array]:
        names, scores = [], []
        for _, data, offsets in text.parts(column):
            bits = self.lengths(data, offsets)
            best = bits.argmin(1)
            names.append(best)
            scores.append(1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1))
        best = np.concatenate(names) if names else np.zeros(0, np.int64)
        score = np.concatenate(scores) if scores else np.zeros(0)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        letter = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
        label = pa.array(self.languages).take(pa.array(best))
        return (pc.if_else(letter, label, "und"), pc.if_else(letter, pa.array(score), 0.0))


def _grams(batches):
    for batch in batches:
        names = batch.column(0).to_pylist()
        codes, of = np.unique(names, return_inverse=True) if names else ([], np.zeros(0, np.int64))
        for first, data, offsets in text.parts(batch.column(1)):
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            language = of[first + doc]
            place = np.arange(len(data)) - offsets[doc]
            gram = np.zeros(len(data), np.int64)
            for k in range(ORDER + 1):
                gram[k:] |= data[: len(data) - k].astype(np.int64) << (8 * k) if k <= len(data) else 0
                whole = place >= k
                key, n = np.unique(gram[whole] | (language[whole] << 40), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(codes[i]) for i in key >> 40], pa.string()),
                     pa.array(np.full(len(key), k, np.int32)),
                     pa.array(key & ((1 << 40) - 1)), pa.array(n)],
                    names=["lang", "k", "gram", "n"])


def fit(docs: DataFrame, trainable: Column, id_column: str = "doc_id", text_column: str = "text",
        language_column: str = "lang", max_rows: int = MAX_ROWS) -> Model:
    """A model of the rows for which ``trainable`` holds and text and language are known."""
    rows = docs.filter(trainable).select(
        F.col(language_column).alias("lang"), F.col(text_column).alias("text"), F.col(id_column).alias("id"),
    ).filter("lang is not null and text is not null")
    # One number per language: how many rows there are. Nothing is sorted, whatever its share.
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    chosen = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col("lang") == name) & hashed_share("id", max_rows, n, "text"))
    grams = rows.filter(chosen).select("lang", "text").mapInArrow(
        _grams, "lang string, k int, gram long, n long")
    grams = grams.groupBy("k", "gram", "lang").agg(F.sum("n").alias("n"))
    # As many rows as the sample has distinct contexts: its size bounds the table.
    table = grams.select("lang", "k", "gram", "n").toArrow()
    lang = np.searchsorted(languages, table["lang"].to_pylist()) if languages else np.zeros(0, int)
    order, gram, n = (table[c].to_numpy() for c in ("k", "gram", "n"))
    counts, known = [], np.zeros(1, np.int64)
    for k in range(ORDER + 1 if languages else 0):
        own = order == k
        if k:
            own &= np.isin(gram >> 8, known) & np.isin(gram & ((1 << 8 * k) - 1), known)
        known, at = np.unique(gram[own], return_inverse=True)
        seen = np.zeros((len(known), len(languages)))
        seen[at, lang[own]] = n[own]
        counts.append((known, seen))
    return Model(languages, counts)


def predicted(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
              ) -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` of every row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def predict(batches):
        for batch in batches:
            if model.languages:
                label, score = model.predict(batch.column(1))
            else:
                label, score = pa.array(["und"] * len(batch)), pa.array(np.zeros(len(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), label, score], names=["id", "lang_pred", "score"])

    return docs.select(id_column, text_column).mapInArrow(
        predict, f"id {kind}, lang_pred string, score double")
