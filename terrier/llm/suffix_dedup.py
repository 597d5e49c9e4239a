"""Exact removal of repeated byte strings by suffix sorting with a difference cover.

A byte goes if a string of ``length`` (200) bytes that covers it also starts anywhere else. Strings
never cross documents, may overlap, and are judged on the input.

Distribution. Of the ``ANCHOR``-byte windows in a string of 200 bytes, the one with the smallest hash
(leftmost of equals) is the string's anchor. Equal strings have equal anchors at equal places, so the
starts of a text fall into segments: runs that share an anchor, cut into ``BANDS`` by the distance to
it. All strings of a segment cover the same core (about 160 bytes around the anchor), and a string can
only occur twice if its core does. So blocks of documents first ask how often their cores occur (one
hash for about 20 bytes of text, see ``exchange``), then send the segments of cores found twice or
more to the range of the core, equal segments of a block once. A passage that very many documents
share is one segment after another, each of them once. At its two edges cores lie in the passage while
segments run into the text around it, so that each document has a segment of its own with one core.
Therefore cores found more than ``HOT`` times are not sent as segments: each string of 200 bytes goes
alone, as 128 bits of hashes, to the range of the first 64 of them, where all equal strings meet.

Suffix sorting. A range sorts the suffixes of its distinct segments with a difference cover modulo 3:
the triples at places 1 and 2 modulo 3 are sorted and named; unless the names differ or already span
200 bytes, the string of names is sorted recursively; the remaining suffixes are sorted by their
first symbol and the rank of the next, and merged in. Neighbours in that order are then compared over
200 bytes. A range works core by core in batches of ``BATCH_BYTES``; a core has at most ``HOT``
segments, and equal ones count once. Starts found, and hashes of hot strings found twice, go back to the
blocks, which cut their texts.

Nulls: a null text counts as empty; rows of null id are treated like others. A text under 200 bytes
loses nothing. Repeated rows remove each other like any copies. An empty table gives an empty result.
Only the id and the text are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from terrier.llm import exchange, text

LENGTH = 200
ANCHOR = 50
BANDS = 4
BATCH_BYTES = 1 << 17
HOT = 4096

_BYTE = text.seeds(256, 11)
_ODD = 0x9E3779B97F4A7C15
#: Of a second hash, independent of the first.
_OTHER_BYTE = text.seeds(256, 12)
_OTHER_ODD = 0xD1342543DE82EF95

SEGMENTS = ("range int, block int, keys binary, sizes binary, doc binary, start binary, "
            "segment binary, bytes binary")
FOUND = "block int, doc binary, start binary, sizes binary, found binary"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


class _Hashes:
    """Numbers for any runs of bytes, from sums of random numbers times powers."""

    def __init__(self, data: np.ndarray, byte: np.ndarray = _BYTE, odd: int = _ODD):
        self.sums = np.r_[np.uint64(0), np.cumsum(byte[data] * _powers(odd, len(data)))]
        self.scale = _powers(pow(odd, -1, 2**64), len(data) + 1)

    def windows(self, size: int) -> np.ndarray:
        """Of all runs of ``size`` bytes."""
        n = len(self.sums) - size
        return text.mixed((self.sums[size:] - self.sums[:n]) * self.scale[:n])

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return text.mixed((self.sums[end] - self.sums[begin]) * self.scale[begin])


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    whole = np.r_[values, np.full(-n % width, np.iinfo(values.dtype).max, values.dtype)].reshape(-1, width)
    head = np.minimum.accumulate(whole, 1).ravel()
    tail = np.minimum.accumulate(whole[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Core key, document, first start (in its document) and number of starts of every segment."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    width = length - anchor + 1
    if len(data) < length:
        return none
    hashes = _Hashes(data)
    of_window = hashes.windows(anchor)
    place = np.arange(len(of_window), dtype=np.uint64)
    lowest = _sliding_minimum((of_window >> np.uint64(32) << np.uint64(32)) | place, width)
    at = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    start = np.flatnonzero(np.arange(len(at)) + length <= offsets[1:][doc])
    if not len(start):
        return none
    at, doc = at[start], doc[start]
    wide = -(-width // BANDS)
    band = (at - start) // wide
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (band[1:] != band[:-1])])
    n = np.diff(np.r_[first, len(at)])
    at, band, start, doc = at[first], band[first], start[first], doc[first]
    # What every string of the band covers, from the nearest to the farthest of them.
    farthest = np.minimum((band + 1) * wide, width) - 1
    core = hashes.runs(at - band * wide, at - farthest + length)
    return text.mixed(core ^ of_window[at] + band.astype(np.uint64)), doc, start - offsets[doc], n


class _Block:
    """The documents of a block in a fixed order, and their segments."""

    def __init__(self, docs: pa.Table, length: int, anchor: int, cut: bool = True):
        self.docs = docs.sort_by([("id", "ascending"), ("text", "ascending")])
        self.raw: list[memoryview] = []
        found = []
        for first, data, offsets in text.parts(self.docs["text"]):
            view = memoryview(data)
            self.raw += [view[a:b] for a, b in zip(offsets, offsets[1:])]
            if cut:
                key, doc, start, n = segments(data, offsets, length, anchor)
                found.append((key, doc + first, start, n))
        if cut:
            columns = list(zip(*found)) or [[np.zeros(0, np.uint64)], *[[np.zeros(0, np.int64)]] * 3]
            self.key, self.doc, self.start, self.n = (np.concatenate(c) for c in columns)


    def strings(self, chosen: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both hashes of the distinct strings that start in the ``chosen`` segments, sorted, and how
        many starts each has."""
        chosen = np.sort(chosen)  # by document
        found = [np.zeros((0, 2), np.uint64)]
        for first, data, offsets in text.parts(self.docs["text"]):
            a, b = np.searchsorted(self.doc[chosen], [first, first + len(offsets) - 1])
            own = chosen[a:b]
            if len(own):
                n = self.n[own]
                begin = offsets[self.doc[own] - first] + self.start[own] - (np.cumsum(n) - n)
                at = np.repeat(begin, n) + np.arange(n.sum())
                found.append(np.stack([h.runs(at, at + length) for h in _both(data)], 1))
        return _distinct(np.concatenate(found), None)


def _both(data: np.ndarray) -> tuple[_Hashes, _Hashes]:
    return _Hashes(data), _Hashes(data, _OTHER_BYTE, _OTHER_ODD)


def _distinct(pairs: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second numbers of the distinct pairs, sorted, and their summed ``times`` (null: 1)."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]).any(1)][: len(pairs)])
    if times is None:
        total = np.diff(np.r_[first, len(pairs)])
    else:
        total = np.add.reduceat(times[order], first) if len(first) else times
    return pairs[first, 0], pairs[first, 1], total


def _among(pairs: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of the pairs of ``one`` and ``other`` are among ``pairs``, sorted by their first number."""
    a, b = np.searchsorted(pairs[:, 0], one, "left"), np.searchsorted(pairs[:, 0], one, "right")
    hit = np.zeros(len(one), bool)
    for j in range(int((b - a).max(initial=0))):
        at = np.flatnonzero(a + j < b)
        hit[at] |= pairs[a[at] + j, 1] == other[at]
    return hit


def _asking(n: int, length: int, anchor: int):
    def ask(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        block = _Block(docs, length, anchor)
        distinct, counts = np.unique(block.key, return_counts=True)
        return exchange.question(key[0].as_py(), distinct, counts, n)

    return ask


def _answer(messages: pa.Table) -> pa.Table:
    _, _, answer = exchange.totals(messages)
    return pa.table({
        "block": messages["block"], "range": messages["range"],
        "counts": pa.array([answer(i) for i in range(len(messages))], pa.binary()),
    })


def _sending(n: int, length: int, anchor: int, hot: int):
    """Sends every segment whose core occurs twice, equal ones once, with all their places.

    Of cores that occur more than ``hot`` times the strings' hashes are sent, in rows without places.
    """

    def send(docs: pa.Table, messages: pa.Table) -> pa.Table:
        block = _Block(docs, length, anchor)
        number = messages["block"][0].as_py()
        distinct = np.unique(block.key)
        times = exchange.answers(messages)[np.searchsorted(distinct, block.key)]
        chosen = np.flatnonzero((times > 1) & (times <= hot))
        chosen = chosen[np.argsort(block.key[chosen], kind="stable")]
        at = exchange.edges(block.key[chosen], n)
        rows = []
        for r in range(n):
            own = chosen[at[r] : at[r + 1]]
            if not len(own):
                continue
            known: dict[tuple[int, bytes], int] = {}
            places = []
            for key, doc, start, starts in zip(block.key[own].tolist(), block.doc[own].tolist(),
                                               block.start[own].tolist(), block.n[own].tolist()):
                content = bytes(block.raw[doc][start : start + starts + length - 1])
                places.append(known.setdefault((key, content), len(known)))
            rows.append({
                "range": r, "block": number,
                "keys": np.array([k for k, _ in known], np.uint64).tobytes(),
                "sizes": np.array([len(c) for _, c in known], np.int32).tobytes(),
                "doc": block.doc[own].astype(np.int32).tobytes(),
                "start": block.start[own].astype(np.int64).tobytes(),
                "segment": np.array(places, np.int32).tobytes(),
                "bytes": b"".join(c for _, c in known),
            })
        one, other, starts = block.strings(np.flatnonzero(times > max(1, hot)), length)
        at = exchange.edges(one, n)
        rows += [{"range": r, "block": number, "keys": one[a:b].tobytes(),
                  "sizes": starts[a:b].astype(np.int64).tobytes(), "bytes": other[a:b].tobytes()}
                 for r, (a, b) in enumerate(zip(at, at[1:])) if b > a]
        kinds = [("range", pa.int32()), ("block", pa.int32())]
        kinds += [(c, pa.binary()) for c in ("keys", "sizes", "doc", "start", "segment", "bytes")]
        return pa.Table.from_pylist(rows, schema=pa.schema(kinds))

    return send


def _named(columns: list[np.ndarray]) -> np.ndarray:
    """Ranks, from 1, of the rows of several columns."""
    key, room = columns[0].astype(np.uint64), int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if room * width >= 2**63:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            room = int(key.max(initial=0)) + 1
        key = key * np.uint64(width) + column.astype(np.uint64)
        room *= width
    return np.unique(key, return_inverse=True)[1] + 1


def suffix_order(symbols: np.ndarray, length: int, span: int = 1) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``length`` bytes; a symbol spans ``span`` bytes.

    Symbols are at least 1. Suffixes that agree on all those bytes come in any order.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int32)
    padded = np.zeros(n + 4, np.int32)
    padded[:n] = symbols
    place = np.arange(n + (n % 3 == 1), dtype=np.int32)  # an empty suffix more: a full triple ends place 1
    sample = np.r_[place[1::3], place[2::3]]
    names = _named([padded[sample], padded[sample + 1], padded[sample + 2]]).astype(np.int32)
    if names.max() == len(names) or 3 * span >= length:
        order = np.argsort(names, kind="stable").astype(np.int32)
    else:
        order = suffix_order(names, length, 3 * span)
        names[order] = np.arange(1, len(names) + 1, dtype=np.int32)
    rank = np.zeros(n + 4, np.int32)
    rank[sample] = names
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3, dtype=np.int32)
    rest = rest[np.argsort(_named([padded[rest], rank[rest + 1]]), kind="stable")]
    # How many sampled suffixes stand before each of the rest: compare a symbol and a rank with those
    # at place 1, two symbols and a rank with those at place 2.
    before = np.zeros(len(rest), np.int64)
    for residue in (1, 2):
        others = sampled[sampled % 3 == residue]
        both = np.r_[rest, others]
        key = _named([*(padded[both + j] for j in range(residue)), rank[both + residue]])
        before += np.searchsorted(key[len(rest):], key[: len(rest)], "left")
    # Where names already span all bytes, suffixes that agree on them may be counted in any order.
    at = np.arange(len(rest)) + np.maximum.accumulate(before)
    out = np.empty(n, np.int32)
    taken = np.zeros(n, bool)
    out[at] = rest
    taken[at] = True
    out[~taken] = sampled
    return out


def repeated_starts(parts_: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some distinct strings, which of its starts begin a string found elsewhere too."""
    sizes = np.array([len(p) for p in parts_])
    joined = np.frombuffer(b"\0".join(parts_), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    symbols = joined.astype(np.int32) + 2
    symbols[ends[:-1]] = 1
    order = suffix_order(symbols, length)
    end = ends[np.searchsorted(ends, order, "left")]
    order = order[order + length <= end]
    # Eight bytes in one number; neighbours are compared number by number, over those still equal.
    wide = np.zeros(len(joined) + 8, np.uint64)
    for j in range(8):
        wide[: max(0, len(joined) - j)] |= joined[j:].astype(np.uint64) << np.uint64(8 * j)
    steps = [*range(0, length - 7, 8)]
    steps += [length - 8] if length % 8 else []
    same = np.arange(len(order) - 1)
    for j in steps:
        same = same[wide[order[same] + j] == wide[order[same + 1] + j]]
    found = np.zeros(len(joined), bool)
    found[order[same]] = True
    found[order[same + 1]] = True
    begins = ends - sizes
    return [found[b : b + max(0, s - length + 1)] for b, s in zip(begins, sizes)]


def _repeated_strings(messages: pa.Table) -> pa.Table:
    """For every message the hashes of those of its hot strings that occur elsewhere too."""
    keys, others = ([np.frombuffer(x, np.uint64) for x in messages[c].to_pylist()] for c in ("keys", "bytes"))
    asked = [np.stack(x, 1) for x in zip(keys, others)]
    times = np.concatenate([np.frombuffer(x, np.int64) for x in messages["sizes"].to_pylist()])
    one, other, total = _distinct(np.concatenate(asked), times)
    repeated = np.stack([one, other], 1)[total > 1]
    found = [x[_among(repeated, x[:, 0], x[:, 1])].tobytes() for x in asked]
    return messages.select(["block", "doc", "start"]).append_column(
        "sizes", pa.nulls(len(found), pa.binary())).append_column("found", pa.array(found, pa.binary()))


def _sorting(length: int):
    """Marks, in every segment of a range, the starts of strings that occur elsewhere too."""

    def mark_all(messages: pa.Table) -> pa.Table:
        alone = pc.is_null(messages["segment"])
        strings, segments_ = messages.filter(alone), messages.filter(pc.invert(alone))
        done = [f(m) for f, m in ((mark, segments_), (_repeated_strings, strings)) if len(m)]
        return pa.concat_tables(done)

    def mark(messages: pa.Table) -> pa.Table:
        rows = messages.select(["block", "keys", "sizes", "segment", "bytes"]).to_pylist()
        times: dict[tuple[int, bytes], int] = {}
        per_row = []
        for row in rows:
            keys, sizes = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["sizes"], np.int32)
            ends = np.cumsum(sizes)
            own = [(int(k), row["bytes"][e - s : e]) for k, s, e in zip(keys, sizes, ends)]
            n = np.bincount(np.frombuffer(row["segment"], np.int32), minlength=len(own))
            for part, k in zip(own, n.tolist()):
                times[part] = times.get(part, 0) + k
            per_row.append(own)
        found: dict[tuple[int, bytes], np.ndarray] = {}

        def settle(batch):
            for part, starts in zip(batch, repeated_starts([c for _, c in batch], length)):
                # All strings of a segment that occurs twice do so too.
                found[part] = np.ones(len(starts), bool) if times[part] > 1 else starts

        batch, size = [], 0
        for _, group in groupby(sorted(times), key=lambda part: part[0]):
            parts_ = list(group)
            if len(parts_) == 1:  # starts of one segment have one anchor: they all differ
                found[parts_[0]] = np.full(len(parts_[0][1]) - length + 1, times[parts_[0]] > 1)
                continue
            batch += parts_
            size += sum(len(c) for _, c in parts_)
            if size >= BATCH_BYTES:
                settle(batch)
                batch, size = [], 0
        if batch:
            settle(batch)
        return pa.table({
            "block": messages["block"], "doc": messages["doc"], "start": messages["start"],
            "sizes": pa.array([np.array([len(found[own[i]]) for i in np.frombuffer(r["segment"], np.int32)],
                                        np.int32).tobytes() for r, own in zip(rows, per_row)], pa.binary()),
            "found": pa.array([np.packbits(np.concatenate(
                [found[own[i]] for i in np.frombuffer(r["segment"], np.int32)])).tobytes()
                for r, own in zip(rows, per_row)], pa.binary()),
        })

    return mark_all


def _cutting(length: int, with_text: bool):
    def cut(docs: pa.Table, messages: pa.Table) -> pa.Table:
        block = _Block(docs, length, 1, cut=False)
        starts, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        hot = [np.zeros((0, 2), np.uint64)]
        for row in messages.to_pylist():
            if row["doc"] is None:
                hot.append(np.frombuffer(row["found"], np.uint64).reshape(-1, 2))
                continue
            doc, start, sizes = (np.frombuffer(row[c], t) for c, t in
                                 (("doc", np.int32), ("start", np.int64), ("sizes", np.int32)))
            hit = np.unpackbits(np.frombuffer(row["found"], np.uint8), count=int(sizes.sum())).astype(bool)
            offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            starts.append((np.repeat(start, sizes) + offset)[hit])
            of.append(np.repeat(doc, sizes)[hit].astype(np.int64))
        hot = np.concatenate(hot)
        hot = hot[np.argsort(hot[:, 0])]
        for first, data, offsets in text.parts(block.docs["text"]) if len(hot) else ():
            if len(data) < length:
                continue
            one, other = _both(data)
            at = np.flatnonzero(np.isin(one.windows(length), hot[:, 0]))
            doc = np.searchsorted(offsets, at, "right") - 1
            inside = at + length <= offsets[doc + 1]
            at, doc = at[inside], doc[inside]
            hit = _among(hot, one.runs(at, at + length), other.runs(at, at + length))
            starts.append((at - offsets[doc])[hit])
            of.append(doc[hit] + first)
        starts, of = np.concatenate(starts), np.concatenate(of)
        order = np.lexsort((starts, of))
        starts, of = starts[order], of[order]
        edges = np.searchsorted(of, np.arange(len(block.raw) + 1))
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for raw, a, b in zip(block.raw, edges, edges[1:]):
            kept, removed, spans = bytes(raw), 0, 0
            if b > a:
                own = starts[a:b]
                first = np.flatnonzero(np.r_[True, own[1:] > own[:-1] + length])
                begins, ends = own[first], own[np.r_[first[1:] - 1, len(own) - 1]] + length
                removed, spans = int((ends - begins).sum()), len(begins)
                outside = zip([0, *ends.tolist()], [*begins.tolist(), len(raw)])
                kept = b"".join(raw[x:y] for x, y in outside)
            for c, v in zip(out, (len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept)):
                out[c].append(v)
        table = {
            "id": block.docs["id"],
            **{c: pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")},
            "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
        }
        if with_text:
            table["kept"] = pa.array(out["kept"], pa.binary())
        return pa.table(table)

    return cut


def without_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id",
                    text_column: str = "text", anchor: int | None = None, with_text: bool = False,
                    block_bytes: int = exchange.BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept``."""
    anchor = anchor or max(1, min(ANCHOR, length // 4))
    dealt, n = exchange.blocks_of(docs, id_column, text_column, block_bytes)
    answers = (
        dealt.groupBy("block").applyInArrow(_asking(n, length, anchor), exchange.ASKED)
        .repartition(n, "range").groupBy("range").applyInArrow(_answer, exchange.ANSWERED)
    )
    found = (
        dealt.groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_sending(n, length, anchor, hot), SEGMENTS)
        .repartition(n, "range").groupBy("range").applyInArrow(_sorting(length), FOUND)
    )
    kind = dealt.schema["id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        _cutting(length, with_text),
        f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + (", kept binary" if with_text else ""))
