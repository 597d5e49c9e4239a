"""Vectorised helpers over the UTF-8 bytes of Arrow string columns.

Words are maximal runs of bytes other than blank and the control characters 9 to 13, wherever a
document ends a word ends too. All helpers work on parts of a column that hold about ``limit``
bytes (at least one whole document), so memory follows the longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PART_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One random number per place in a word (modulo 64) and byte.
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, (64, 256), dtype=np.uint64).ravel()
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit input (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + np.uint64(salt))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of every key among them, and one place of each in ``keys``."""
    order = np.argsort(keys)
    found = keys[order]
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return found[new], rank, order[new]


def parts(column, limit: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row number of the first document, bytes of all documents, and their n + 1 offsets."""
    done = 0
    for array in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        array = array.fill_null("")
        wide = pa.types.is_large_string(array.type)
        _, places, data = array.buffers()
        at = np.frombuffer(places, np.int64 if wide else np.int32)
        at = at[array.offset : array.offset + len(array) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(array):
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield done + first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last
        done += len(array)


class Words:
    """The words of some documents: byte places ``start`` to ``end``, and their document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n_docs = data, offsets, len(offsets) - 1
        solid = ~_SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.r_[False, solid[:-1]] if len(data) else solid
        after = np.r_[solid[1:], False] if len(data) else solid
        self.start = np.flatnonzero(solid & (~before | cut[:-1]))
        self.end = np.flatnonzero(solid & (~after | cut[1:])) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.solid = solid

    def counts(self) -> np.ndarray:
        """Words per document."""
        return np.bincount(self.doc, minlength=self.n_docs)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit number per word, of its bytes with A to Z in lower case if asked for."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        letters = self.data[self.solid]
        if lower:
            letters = _LOWER[letters]
        sizes = self.end - self.start
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(letters)) - np.repeat(first, sizes)
        value = _TABLE[((place & 63) << 8) | letters]
        far = np.flatnonzero(place > 63)
        if len(far):
            value[far] = mixed(value[far] + (place[far] >> 6).astype(np.uint64) * _GOLDEN)
        return mixed(np.add.reduceat(value, first) + sizes.astype(np.uint64) * _GOLDEN)


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of ``size`` words in text order, and their documents.

    A document of fewer words, but at least one, has one shingle: all of its words.
    """
    per_doc = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(per_doc) - per_doc
    n = np.where(per_doc >= size, per_doc - size + 1, np.minimum(per_doc, 1))
    of = np.repeat(np.arange(n_docs), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[of]
    odd = seeds(size, 5) | np.uint64(1)
    length = np.minimum(per_doc, size)[of]
    total = length.astype(np.uint64) * _GOLDEN
    padded = np.r_[words, np.zeros(size, np.uint64)]
    for j in range(size):
        total = total + np.where(j < length, padded[at + j], 0).astype(np.uint64) * odd[j]
    return mixed(total), of


def occurrences(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How many equal values stand earlier in the same document."""
    keys = mixed(values + doc.astype(np.uint64) * _GOLDEN)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else order
    sizes = np.diff(np.r_[begins, len(ranked)])
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(ranked)) - np.repeat(begins, sizes)
    return out


def windows_repeated(values: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """Which words stand in a run of ``size`` words that occurs twice or more in its document."""
    covered = np.zeros(len(values) + 1, np.int64)
    if len(values) < size:
        return covered[:-1] > 0
    whole = np.flatnonzero(doc[size - 1 :] == doc[: len(doc) - size + 1])
    odd = seeds(size, 9) | np.uint64(1)
    total = doc[whole].astype(np.uint64) * _GOLDEN
    for j in range(size):
        total = total + values[whole + j] * odd[j]
    keys = mixed(total)
    _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
    at = whole[n[inverse] > 1]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + size, -1)
    return np.cumsum(covered[:-1]) > 0
