"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is found in a document if at least ``threshold`` of its distinct word shingles occur there.
Items are partitioned by their number of shingles (powers of two). The MinHash sketch of an item
holds its smallest shingle hashes, as many as its size asks for: an item with ``n`` shingles of which
``ceil(threshold * n)`` must be present misses at most the rest, so of its ``rest + 1`` smallest at
least one is in every document that contains it. A document's sketch in a partition is its shingle
hashes below the largest sketch hash of the partition. Hits between sketches are candidates, none is
lost; each is verified by comparing the shingles themselves, word by word.

Items travel in blocks of about ``BLOCK_BYTES`` of text, each sent to all tasks in one scan of the
documents: memory is bounded by the block, however many items there are, and documents are never
shuffled. Within a task a document of any length meets the sketches by binary search.

Words are maximal runs of bytes other than white space, A to Z in lower case. An item of fewer than
five words is one shingle of all its words and is sought as such. Nulls: a null text or an item
without a word is found nowhere; rows of null id are treated like others. Repeated documents and
items give repeated rows (items are made distinct by id and text). Empty tables give no rows.
Further columns may have any name.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm import text

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_BYTES = 1 << 20


def _words(raw: bytes) -> list[bytes]:
    return raw.translate(None if raw.islower() else _LOWER).split()


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Index:
    """Sketches and shingles of a block of items."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.ids, self.found, self.need = [], [], []
        self.sketches: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        collected = defaultdict(lambda: ([], []))
        for item_id, item in items:
            column = pa.array([item], pa.string())
            for _, data, offsets in text.parts(column):
                words = text.Words(data, offsets)
                if not len(words.start):
                    continue
                size = min(SHINGLE, len(words.start))
                hashed, _ = text.shingles(words.hashes(), words.doc, 1, size)
                values = np.unique(hashed)
                raw = _words(item.encode())
                runs = {tuple(raw[i : i + size]) for i in range(len(raw) - size + 1)}
                need = math.ceil(threshold * len(runs) - 1e-9)
                sketch = values[: len(values) - need + 1]
                keep = collected[size, len(runs).bit_length()]
                keep[0].append(sketch)
                keep[1].append(np.full(len(sketch), len(self.ids)))
                self.ids.append(item_id)
                self.found.append(runs)
                self.need.append(need)
        for (size, _), (sketches, owners) in sorted(collected.items()):
            values, owner = np.concatenate(sketches), np.concatenate(owners)
            order = np.argsort(values, kind="stable")
            self.sketches.setdefault(size, []).append((values[order], owner[order]))

    def hits(self, words: text.Words) -> set[tuple[int, int]]:
        """Candidates: documents and items whose sketches share a hash."""
        out: set[tuple[int, int]] = set()
        hashes = words.hashes()
        for size, partitions in self.sketches.items():
            values, doc = text.shingles(hashes, words.doc, words.n_docs, size)
            for sketch, owner in partitions:
                low = np.flatnonzero(values <= sketch[-1])
                begin = np.searchsorted(sketch, values[low], "left")
                n = np.searchsorted(sketch, values[low], "right") - begin
                hit = np.repeat(np.arange(len(low)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[hit]
                out.update(zip(doc[low[hit]].tolist(), owner[at].tolist()))
        return out

    def verified(self, raw: bytes, items: list[int]) -> list[tuple[int, int, int]]:
        """Item, its shingles, and how many of them the document has, where these are enough."""
        split, runs, out = _words(raw), {}, []
        for i in items:
            size = len(next(iter(self.found[i])))
            if size not in runs:
                runs[size] = {tuple(split[j : j + size]) for j in range(len(split) - size + 1)}
            shared = len(self.found[i] & runs[size])
            if shared >= self.need[i]:
                out.append((self.ids[i], len(self.found[i]), shared))
        return out


def _found(index: Index, column) -> list[tuple[int, int, int, int]]:
    """Row number, item, shingles of the item and shared ones for all items found in some texts."""
    out = []
    for first, data, offsets in text.parts(column):
        by_doc = defaultdict(list)
        for d, i in index.hits(text.Words(data, offsets)):
            by_doc[d].append(i)
        for d in sorted(by_doc):
            raw = data[offsets[d] : offsets[d + 1]].tobytes()
            out += [(first + d, *found) for found in index.verified(raw, sorted(by_doc[d]))]
    return out


def _searching(index: Index):
    def search(batches):
        for batch in batches:
            found = _found(index, batch.column(1))
            rows, items, sizes, shared = zip(*found) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 *(pa.array(c, pa.int64()) for c in (items, sizes, shared))],
                names=["doc_id", "item_id", "n_shingles", "n_shared"])

    return search


def _rejecting(index: Index, at: int):
    def reject(batches):
        for batch in batches:
            keep = np.ones(len(batch), bool)
            keep[[row for row, *_ in _found(index, batch.column(at))]] = False
            yield batch.filter(pa.array(keep))

    return reject


def _blocks(items: DataFrame, threshold: float) -> Iterator[Index]:
    items = items.select(F.col("item_id").cast("long"), "text").filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(size / BLOCK_BYTES)
    for block in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield Index([tuple(r) for r in own.sort("item_id", "text").collect()], threshold)


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shingles`` of the item and ``n_shared`` for every item found.

    ``items`` has ``item_id`` and ``text``; they are read in blocks, one scan of ``docs`` for each.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, n_shingles long, n_shared long"
    found = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(items, threshold):
        found = found.union(
            docs.select(id_column, text_column).mapInArrow(_searching(index), schema))
    return found


def without_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                  text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    at = docs.columns.index(text_column)
    for index in _blocks(items, threshold):
        docs = docs.mapInArrow(_rejecting(index, at), docs.schema)
    return docs
