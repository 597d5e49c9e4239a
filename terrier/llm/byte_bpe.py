"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

**Pieces.** A pattern cuts a text into pieces, each encoded by itself. The encoding of a piece merges, time and
again, the neighbours whose joined bytes have the lowest rank; a piece that is a token as a whole is that token.

**Transducer.** The encoding of every prefix of a piece ends in one token, and a token may follow another if
and only if the two, joined and encoded, give just these two. So a nondeterministic transducer reads bytes along
the trie of the vocabulary and, wherever it stands on a token that may follow the one before, also returns to the
root. It is made deterministic lazily: a state is a set of trie nodes, each with the tokens that its path has
found but not emitted; a transition emits what all paths agree on. A path lives only as long as its bytes go on to
spell a token, so a token leaves after a lookahead of at most the longest token. States and transitions
are built when a text first needs them and kept per worker process, up to ``STATES``; then the automaton
starts anew, which changes no result. The work is linear in the length of a piece.

**Decoding.** Ids become bytes a few thousand at a time. A state machine for UTF-8 keeps the unfinished last
character back for the next step, so that a character whose bytes are split over tokens comes out whole; what is
not UTF-8 becomes U+FFFD.

Nothing is shuffled; memory follows the longest document. Pieces, and stretches between blanks, are first
looked up among the last ones of up to ``KEPT_BYTES`` bytes that the same worker has encoded.

Nulls and odd input: a null text is empty and has no ids; strings of special tokens in a text are ordinary
text; null and repeated ids and rows pass through. A null list of ids decodes to an empty text, an id outside
the vocabulary (or null) raises ValueError. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm import text

STATES = 250_000
KEPT_PIECES = 500_000
KEPT_STRETCHES = 400_000
KEPT_BYTES = 48
STEP = 4096
PART_BYTES = 1 << 21
NEVER = 1 << 60
_UNSEEN = object()


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes pieces byte by byte.

    A state lists its paths as pairs of trie node and waiting tokens, the longest open token first and the
    path at the root last; beside them stands the last emitted token, where the next one has to fit it.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.child: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        self.whole: set[int] = set()  # tokens that merging alone arrives at; others only stand for pieces
        self.left: dict[int, list] = {}
        self.right: dict[int, list] = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                following = self.child[node].get(byte)
                if following is None:
                    following = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.token_at.append(-1)
                node = following
            if self._merged(token, rank) == [rank]:
                self.whole.add(rank)
                self.token_at[node] = rank
        self.fits: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.paths: dict[tuple, tuple] = {}
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: dict[int, tuple[int, tuple[int, ...]] | None] = {}
        self._number((((0, ()),), -1))

    def _number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number

    def _merged(self, raw: bytes, token: int | None = None) -> list[int]:
        """Encoding of some bytes by merging, the rule that the transducer is compiled from.

        For a ``token`` it notes what stands at its edges meanwhile: each piece, with the highest rank merged
        while it stood there.
        """
        parts = [raw[i : i + 1] for i in range(len(raw))]
        ranks = self.ranks
        joined = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        left, right = [[parts[0], -1]], [[parts[-1], -1]]
        while joined:
            best = min(joined)
            if best == NEVER:
                break
            i = joined.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joined[i]
            if i:
                joined[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
            if i < len(joined):
                joined[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
            if token is not None:
                for edge, part in ((left, parts[0]), (right, parts[-1])):
                    edge[-1][1] = max(edge[-1][1], best)
                    if len(part) > len(edge[-1][0]):
                        edge.append([part, -1])
        if token is not None:
            left[-1][1] = right[-1][1] = NEVER
            self.left[token], self.right[token] = left, right
        return [ranks[p] for p in parts]

    def _fit(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before``: no merge crosses their border."""
        if before < 0:
            return True
        key = before << 32 | token
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > STATES:
                self.fits.clear()
            found = not self._may_cross(before, token) or self._merged(
                self.tokens[before] + self.tokens[token]) == [before, token]
            self.fits[key] = found
        return found

    def _may_cross(self, before: int, token: int) -> bool:
        """A first crossing merge joins two pieces that stand at the border, in time before they are gone."""
        get = self.ranks.get
        for a, a_until in self.right[before]:
            for b, b_until in self.left[token]:
                rank = get(a + b)
                if rank is not None and rank <= a_until and rank <= b_until:
                    return True
        return False

    def _last(self, number: int, byte: int) -> tuple[int, ...] | None:
        """The tokens that wait after the last byte of a piece; no state is needed for it."""
        paths, last = self.states[number]
        child, token_at = self.child, self.token_at
        for node, waiting in paths:
            node = child[node].get(byte)
            if node is not None:
                token = token_at[node]
                if token >= 0 and self._fit(waiting[-1] if waiting else last, token):
                    return (*waiting, token)
        return None

    def _step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]] | None:
        """Builds the transition of a state on a byte."""
        paths, last = self.states[number]
        child, token_at = self.child, self.token_at
        live, ended = [], None
        for node, waiting in paths:
            node = child[node].get(byte)
            if node is None:
                continue
            if child[node]:
                live.append((node, waiting))
            if ended is None:
                token = token_at[node]
                if token >= 0 and self._fit(waiting[-1] if waiting else last, token):
                    ended = (*waiting, token)
        if ended is None:  # no ranks of this kind are known
            return None
        live.append((0, ended))
        emitted = ended if live[0][1] else ()
        if emitted:
            for _, waiting in live:  # what all paths agree on
                shared = 0
                for a, b in zip(emitted, waiting):
                    if a != b:
                        break
                    shared += 1
                if shared < len(emitted):
                    emitted = emitted[:shared]
                    if not shared:
                        break
        if emitted:
            n, last = len(emitted), emitted[-1]
            live = [(node, waiting[n:]) for node, waiting in live]
        if all([waiting for _, waiting in live]):
            last = -1  # what was emitted no longer matters
        kept = self.paths.setdefault
        return self._number((tuple([kept(path, path) for path in live]), last)), emitted

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self._restart()
        out, state, following = [], 0, self.next
        for byte in piece[:-1]:
            key = state << 8 | byte
            found = following.get(key, _UNSEEN)
            if found is _UNSEEN:
                found = following[key] = self._step(state, byte)
            if found is None:
                return self._merged(piece)
            state, emitted = found
            if emitted:
                out += emitted
        waiting = self._last(state, piece[-1])
        if waiting is None:
            return self._merged(piece)
        out += waiting
        return out


class Recent:
    """Results for short texts; of the older half those that are asked for again stay."""

    def __init__(self, find, size: int, chars: int = KEPT_BYTES):
        self.find, self.size, self.chars = find, size // 2, chars
        self.young: dict[bytes | str, tuple[int, ...]] = {}
        self.old: dict[bytes | str, tuple[int, ...]] = {}

    def missed(self, text) -> tuple[int, ...]:
        """The result for a text that ``young`` does not hold."""
        found = self.old.get(text)
        if found is None:
            found = tuple(self.find(text))
        if len(text) <= self.chars:
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[text] = found
        return found


class Encoder:
    """Encodes parts of a column; keeps the ids of recent pieces, and of recent stretches between blanks.

    A blank between two other characters always begins a piece of ``pattern`` if ``cut_at_blanks`` is set, so
    texts may be cut there before the pattern is applied. Of equal stretches of a part one is encoded.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut_at_blanks: bool = True):
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.cut_at_blanks = cut_at_blanks
        self.recent_pieces = Recent(lambda piece: self.transducer.encode(piece.encode()), KEPT_PIECES)
        self.recent_stretches = Recent(self._pieces, KEPT_STRETCHES)

    def _pieces(self, stretch: bytes) -> list[int]:
        text = stretch.decode()
        # Of a long text the pieces come one by one.
        pieces = self.pattern.findall(text) if len(text) < PART_BYTES else (
            match.group() for match in self.pattern.finditer(text))
        recent, out = self.recent_pieces, []
        for piece in pieces:
            out += recent.young.get(piece) or recent.missed(piece)
        return out

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where stretches begin: documents, and blanks between two characters that are no white space."""
        start = np.zeros(len(data) + 1, bool)
        start[offsets] = True
        if self.cut_at_blanks and len(data) > 2:
            at = np.flatnonzero(data == 32)
            at = at[(at > 0) & (at < len(data) - 1)]
            before, after = data[at - 1], data[at + 1]
            # White space of several bytes begins with one of four; where one stands near, nothing is cut.
            free = ~(_SPACE[before] | _SPACE[after] | _LEAD[after])
            free &= (data[at - 2] != 0xC2) | (at < 2)
            free &= ~_LEAD[data[at - 3]] | (at < 3)
            start[at[free]] = True
        return np.flatnonzero(start[:-1])

    def encode_part(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a part, and where each document ends among them (n + 1 places)."""
        starts = self._starts(data, offsets)
        bounds = np.r_[starts, len(data)].astype(np.int64)
        stretches = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        recent, distinct = self.recent_stretches, stretches.dictionary.to_pylist()
        lists = [recent.young.get(s) for s in distinct]
        # In order, so that neighbours pass the same states.
        for i in sorted((i for i, ids in enumerate(lists) if ids is None), key=distinct.__getitem__):
            lists[i] = recent.missed(distinct[i])
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        which = stretches.indices.to_numpy(zero_copy_only=False)
        n = sizes[which]
        ends = np.r_[0, np.cumsum(n)]
        first = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(first[which] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(starts, offsets)]

    def encode(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_part(raw, np.array([0, len(raw)]))[0]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _utf8_steps() -> np.ndarray:
    """State machine of well-formed UTF-8: states by what may follow, -1 where the byte is wrong.

    0: a character may begin; 1, 2, 3: so many further bytes of 80 to BF; 4 to 7: the second byte is bounded
    (after E0, ED, F0, F4).
    """
    steps = np.full((8, 256), -1, np.int8)
    for state, low, high, to in (
            (0, 0x00, 0x7F, 0), (0, 0xC2, 0xDF, 1), (0, 0xE1, 0xEF, 2), (0, 0xE0, 0xE0, 4), (0, 0xED, 0xED, 5),
            (0, 0xF1, 0xF3, 3), (0, 0xF0, 0xF0, 6), (0, 0xF4, 0xF4, 7), (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1),
            (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)):
        steps[state, low : high + 1] = to
    return steps


_UTF8 = _utf8_steps().tolist()


class StreamDecoder:
    """Text of ids that come in steps; an unfinished character waits for its other bytes."""

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.kept = tokens, b""

    def feed(self, ids: list[int]) -> str:
        raw = self.kept + b"".join([self.tokens[i] for i in ids])
        at = len(raw) - self._unfinished(raw)
        self.kept = raw[at:]
        return raw[:at].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.kept = self.kept.decode("utf-8", "replace"), b""
        return out

    @staticmethod
    def _unfinished(raw: bytes) -> int:
        """How many last bytes begin a character that may still be completed."""
        for n in range(1, min(3, len(raw)) + 1):
            byte = raw[-n]
            if byte & 0xC0 == 0x80:
                continue
            state = 0
            for byte in raw[len(raw) - n :]:
                state = _UTF8[state][byte]
                if state < 0:
                    return 0
            return n if state else 0
        return 0


_KEPT: dict[tuple, object] = {}


def _once(make, *key):
    """One encoder or table of tokens a worker process, which Spark uses again for later tasks."""
    if (make, *key) not in _KEPT:
        _KEPT[(make, *key)] = make(*key)
    return _KEPT[(make, *key)]


def _encoder(path: str, pattern: str, cut_at_blanks: bool) -> Encoder:
    return Encoder(read_ranks(path), pattern, cut_at_blanks)


def _tokens(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    by_rank = {rank: token for token, rank in ranks.items()}
    return [by_rank.get(i) for i in range(max(by_rank) + 1)]


def encoded(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id",
            text_column: str = "text", cut_at_blanks: bool = True, with_text: bool = False) -> DataFrame:
    """``id`` and ``ids`` of every document, on request also the ``text`` that these ids decode to.

    ``path`` names the rank file on every machine. ``cut_at_blanks`` holds for patterns whose pieces have a
    blank at their beginning only (other than pieces of white space), as those of GPT-2 and its kin.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once(_encoder, path, pattern, cut_at_blanks)
        tokens = _once(_tokens, path) if with_text else []
        for batch in batches:
            for first, data, offsets in text.parts(batch.column(1), PART_BYTES):
                found, ends = encoder.encode_part(data, offsets)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int32()))
                columns = [batch.column(0).slice(first, len(ids)), ids]
                if with_text:
                    columns.append(pa.array([_text(tokens, row.values) for row in ids], pa.string()))
                yield pa.record_batch(columns, ["id", "ids", "text"][: len(columns)])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(local, f"id {kind}, ids array<int>" + (", text string" if with_text else ""))


def decoded(ids: DataFrame, path: str, id_column: str = "id", ids_column: str = "ids") -> DataFrame:
    """``id``, ``ids`` and their ``text``."""
    source = ids.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _once(_tokens, path)
        for batch in batches:
            for rows in _parts(batch, pc.list_value_length(batch.column(1))):
                texts = [_text(tokens, row.values) for row in rows.column(1)]
                yield pa.record_batch([*rows.columns, pa.array(texts, pa.string())], ["id", "ids", "text"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(local, f"id {kind}, ids array<int>, text string")


def _text(tokens: list[bytes], ids: pa.Array | None) -> str:
    if ids is None:
        return ""
    numbers = ids.to_numpy(zero_copy_only=False)
    if len(numbers) and (ids.null_count or not 0 <= numbers.min() <= numbers.max() < len(tokens)):
        raise ValueError("an id outside the vocabulary")
    decoder = StreamDecoder(tokens)
    out = [decoder.feed(numbers[at : at + STEP].tolist()) for at in range(0, len(numbers), STEP)]
    return "".join([*out, decoder.end()])


def _parts(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PART_BYTES``, at least one row each."""
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last
