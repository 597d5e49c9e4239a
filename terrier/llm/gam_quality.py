"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are cut into quantile bins. Training is cyclic boosting: round after round
each feature in turn gets one shallow tree over its bins, fitted to the current gradient and added,
damped, to the feature's lookup table. Then pairs of features whose joint cells explain most of what
is left get two-way tables the same way. A document's score is the logistic function of a sum of
table entries, so scoring is one vectorised addition per feature and pair.

The model is fitted on the driver on a bounded sample of about ``max_rows`` (20,000) labelled rows, those
whose hashed id is below that share of the hash range. Only these ids are broadcast, which the bound
makes small; features are computed where the documents are. Scoring reads documents once and shuffles nothing.

Nulls: a null text counts as empty and gets a score too; labels that are null, or of an id that is
null, are not learned; an id with several labels has the smallest. With no labelled row, or one class
only, all scores are that of the prior (0.5 without labels). Repeated rows are scored one by one. An
empty table gives an empty result. Further columns may have any name: labels enter by
id and label alone, and the score never sees anything but the text.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terrier.llm import text
from terrier.llm.host_rules import part_counts
from terrier.llm.sampling import hashed_share

MAX_ROWS = 20_000
BINS = 32
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 8
RATE = 0.1
RIDGE = 1.0
#: Bytes of text whose features are computed at a time; that takes about 50 times their memory.
PART_BYTES = 1 << 18

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "marks", "non_ascii",
    "repeated_windows", "duplicate_lines", "distinct_words", "doubled_words", "short_words",
    "long_words", "words_per_line", "word_length_spread", "most_common_word",
)

_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = 1  # upper case
_KIND[97:123] = 2
_KIND[48:58] = 3
_KIND[list(b"#*$%&|<>@^~_=+\\/{}[]")] = 4
_KIND[list(b"!?.,;:'\"()-")] = 5
_KIND[128:] = 6


def _word_features(words: text.Words) -> list[np.ndarray]:
    n, per_doc = words.n_docs, np.maximum(words.counts(), 1)
    hashes = words.hashes()
    sizes = words.end - words.start
    mean = np.bincount(words.doc, sizes, n) / per_doc
    square = np.bincount(words.doc, sizes.astype(float) ** 2, n) / per_doc
    # Runs of equal (document, word) keys: number and longest per document.
    keys = text.mixed(hashes + words.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    keys = keys[order]
    begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    runs = np.diff(np.r_[begins, len(keys)])
    of_run = words.doc[order[begins]] if len(keys) else begins
    most = np.zeros(n)
    np.maximum.at(most, of_run, runs)
    doubled = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    return [
        np.bincount(of_run, minlength=n) / per_doc,
        np.bincount(words.doc[1:][doubled], minlength=n) / per_doc,
        np.bincount(words.doc[sizes <= 2], minlength=n) / per_doc,
        np.bincount(words.doc[sizes >= 12], minlength=n) / per_doc,
        np.sqrt(np.maximum(square - mean**2, 0)),
        most / per_doc,
        mean,
    ]


def features(column) -> np.ndarray:
    """One row per text, one column per name in ``FEATURES``."""
    rows = []
    for _, data, offsets in text.parts(column, PART_BYTES):
        n = len(offsets) - 1
        words = text.Words(data, offsets)
        counts = part_counts(words)
        n_words = np.maximum(counts["n_words"], 1)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        solid = np.maximum(np.bincount(doc[words.solid], minlength=n), 1)
        kinds = np.bincount(doc * 8 + _KIND[data], minlength=8 * n).reshape(n, 8)
        lines = np.bincount(doc[data == 10], minlength=n) + 1
        distinct, doubled, short, long, spread, most, mean = _word_features(words)
        letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
        rows.append(np.column_stack([
            np.log1p(counts["n_words"]), mean, kinds[:, 1] / letters, kinds[:, 3] / solid,
            kinds[:, 4] / solid, kinds[:, 5] / solid, kinds[:, 6] / solid,
            counts["n_repeat_words"] / n_words, counts["n_dup_lines"] / lines,
            distinct, doubled, short, long, n_words / lines, spread, most,
        ]))
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


class Gam:
    """Lookup tables per feature and per pair of features, and the intercept."""

    def __init__(self, cuts, intercept, tables, pairs):
        self.cuts, self.intercept, self.tables, self.pairs = cuts, intercept, tables, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for i, j, table in self.pairs:
            total += table[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-total))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _step(g, h):
    return -g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree with up to four leaves over a row of bins, split twice greedily."""
    def split(begin, end):
        if end - begin < 2:
            return [(begin, end)]
        left_g, left_h = np.cumsum(g[begin : end - 1]), np.cumsum(h[begin : end - 1])
        all_g, all_h = g[begin:end].sum(), h[begin:end].sum()
        gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h)
        cut = begin + 1 + int(np.argmax(gain))
        return [(begin, cut), (cut, end)]

    leaves = [(0, len(g))]
    for _ in range(2):
        leaves = [piece for leaf in leaves for piece in split(*leaf)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = _step(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts both features of a pair once."""
    sg, sh = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def four(s):
        a = s[:-1, :-1]
        b, c = s[:-1, -1:] - a, s[-1:, :-1] - a
        return a, b, c, s[-1, -1] - a - b - c

    cells = list(zip(four(sg), four(sh)))
    gain = sum(_gain(x, y) for x, y in cells)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [_step(x[i, j], y[i, j]) for x, y in cells]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gain[i, j] - _gain(sg[-1, -1], sh[-1, -1])), out


def _cuts(values: np.ndarray) -> np.ndarray:
    """Quantiles of a feature. If it may be zero, also those of the positive values and a cut below them,
    so that what few texts have does not share the bin of zero."""
    if not len(values):
        return np.zeros(0)
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    found = [np.quantile(values, shares)]
    positive = values[values > 0]
    if 0 < len(positive) < len(values):
        found += [np.quantile(positive, shares), positive.min(keepdims=True) / 2]
    return np.unique(np.concatenate(found))


def fitted(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting on features ``x`` and labels ``y`` of 0 and 1."""
    cuts = [_cuts(c) for c in x.T]
    sizes = [len(c) + 1 for c in cuts]
    tables = [np.zeros(n) for n in sizes]
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(cuts, float(np.log(rate / (1 - rate))), tables, [])
    if len(np.unique(y)) < 2:
        return model
    bins = model.bins(x)
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for i, n in enumerate(sizes):
            g, h = slopes()
            step = RATE * _tree(np.bincount(bins[:, i], g, n), np.bincount(bins[:, i], h, n))
            tables[i] += step
            total += step[bins[:, i]]

    def cells(i, j):
        both, shape = bins[:, i] * sizes[j] + bins[:, j], (sizes[i], sizes[j])
        g, h = slopes()
        n = sizes[i] * sizes[j]
        return np.bincount(both, g, n).reshape(shape), np.bincount(both, h, n).reshape(shape)

    ranked = sorted(combinations(range(len(sizes)), 2), key=lambda p: (-_quadrants(*cells(*p))[0], p))
    model.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step = RATE * _quadrants(*cells(i, j))[1]
            table += step
            total += step[bins[:, i], bins[:, j]]
    return model


def _featured(batches):
    for batch in batches:
        x = features(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), *(pa.array(c) for c in x.T)], names=["label", *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, label_column: str = "quality",
        id_column: str = "doc_id", text_column: str = "text", max_rows: int = MAX_ROWS) -> Gam:
    """A model of the rows of ``labels`` for which ``trainable``, a condition on them, holds."""
    known = labels.filter(trainable & F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    known = known.select(F.col(id_column).alias("gam_id"), F.col(label_column).cast("int").alias("gam_label"))
    sample = known.filter(hashed_share("gam_id", max_rows, known.count())).groupBy("gam_id").agg(
        F.min("gam_label").alias("gam_label"))
    own = docs.select(F.col(id_column).alias("gam_id"), F.col(text_column).alias("gam_text"))
    rows = (
        own.join(F.broadcast(sample), "gam_id").select("gam_text", "gam_label")
        .mapInArrow(_featured, "label int, " + ", ".join(f"{c} double" for c in FEATURES))
        .toArrow()
    )
    order = [(c, "ascending") for c in ("label", *FEATURES)]
    rows = rows.sort_by(order)  # sums of doubles then do not depend on the order of arrival
    x = np.column_stack([rows[c].to_numpy() for c in FEATURES])
    return fitted(x, rows["label"].to_numpy().astype(float))


def scored(docs: DataFrame, model: Gam, text_column: str = "text", score_column: str = "score",
           keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the model's probability of label 1 in ``score_column``.

    The other columns pass through, or those of ``keep`` only: Spark does not see that a column is not
    asked for, and texts that nobody reads would come back from Python. One that is named like the score
    is replaced.
    """
    docs = docs.drop(score_column)
    at = docs.columns.index(text_column)
    kept = [i for i, c in enumerate(docs.columns) if keep is None or c in keep]

    def score(batches):
        for batch in batches:
            values = pa.array(model.scores(features(batch.column(at))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), values],
                names=[*(batch.schema.names[i] for i in kept), score_column])

    fields = [docs.schema[i] for i in kept]
    return docs.mapInArrow(score, StructType([*fields, StructField(score_column, DoubleType())]))
