"""Host-level quality rules.

Every document gets its base verdict from whole-text counts. Failures are added up per host; a host's
failure rate is shrunk towards the mean of all hosts with a beta prior fitted to the hosts' own rates
by the method of moments, so that a host of few documents is not condemned by one of them. A host
whose shrunk rate exceeds ``max_rate`` loses all its documents; the verdict is joined back.

Counts travel without texts: they are written once (one short row per document), summed per host on
the map side, and met by one row per host; a host with most rows is split by the adaptive join.

Nulls: a null text has no words and fails; a document of a null host is judged by itself alone.
Repeated rows are judged one by one. An empty table gives an empty result. Only the three named
columns are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm import text
from terrier.session import written

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document."""
    out = np.zeros(len(offsets) - 1, np.int64)
    raw, has_word = data.tobytes(), np.r_[0, np.cumsum(solid)]
    breaks = np.bincount(np.searchsorted(offsets, np.flatnonzero(data == 10), "right") - 1,
                         minlength=len(out))
    for d in np.flatnonzero(breaks):
        seen: set[bytes] = set()
        begin = int(offsets[d])
        for line in raw[begin : offsets[d + 1]].split(b"\n"):
            end = begin + len(line)
            if has_word[end] > has_word[begin]:
                out[d] += line in seen
                seen.add(line)
            begin = end + 1
    return out


def part_counts(words: text.Words) -> dict[str, np.ndarray]:
    """The five counts of the documents that ``words`` were cut from."""
    data, offsets, n = words.data, words.offsets, words.n_docs
    doc_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    points = words.solid & ((data & 0xC0) != 0x80)  # a code point has one byte that leads
    repeated = text.windows_repeated(words.hashes(lower=False), words.doc, n, WINDOW)
    return {
        "n_words": words.counts(),
        "word_chars": np.bincount(doc_of_byte[points], minlength=n),
        "n_symbols": np.bincount(doc_of_byte[_SYMBOLS[data]], minlength=n),
        "n_dup_lines": _duplicate_lines(data, offsets, words.solid),
        "n_repeat_words": np.bincount(words.doc[repeated], minlength=n),
    }


def count_columns(column) -> dict[str, np.ndarray]:
    """The five counts of every text of an Arrow string column."""
    found = [part_counts(text.Words(data, offsets)) for _, data, offsets in text.parts(column)]
    return {c: np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in COUNTS}


def _counted(batches):
    for batch in batches:
        counts = count_columns(batch.column(2))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
            names=["id", "host", *COUNTS])


def document_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   host_column: str = "source") -> DataFrame:
    """``id``, ``host``, the five counts and ``base_failed`` of every row."""
    kind = docs.schema[id_column].dataType.simpleString()
    counted = docs.select(
        F.col(id_column), F.col(host_column).cast("string"), F.col(text_column)
    ).mapInArrow(_counted, f"id {kind}, host string, " + ", ".join(f"{c} long" for c in COUNTS))
    return counted.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def host_rates(rules: DataFrame) -> DataFrame:
    """``host``, ``n_docs``, ``n_failed`` and ``rate`` shrunk by the prior of all hosts."""
    hosts = rules.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    raw = F.col("n_failed") / F.col("n_docs")
    mean, variance = hosts.agg(F.avg(raw), F.var_samp(raw)).first()
    mean = mean or 0.0
    # With no spread at all every host is as good as the others: the prior then weighs most.
    spread = max(variance or 0.0, 1e-6)
    strength = max(mean * (1 - mean) / spread - 1, 1.0)
    return hosts.withColumn(
        "rate", (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength))


def host_verdicts(docs: DataFrame, max_rate: float = 0.5, **columns: str) -> DataFrame:
    """Rows of ``document_rules`` plus the host's ``rate`` and the verdict ``kept``."""
    rules = written(document_rules(docs, **columns), "host-rules")
    hosts = written(host_rates(rules).select("host", "rate"), "host-rates")
    return rules.join(hosts, "host", "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("rate") <= max_rate, F.lit(True)))
