"""Token ids in fixed-width bit-packed files with block offsets.

File format, all numbers little-endian: blocks of up to ``BLOCK`` (4,096) ids, each id in the minimum
number of bits for the vocabulary, ids in groups of 64 that fill whole 64-bit words (the last group of a
block is padded with zeros); then the footer: offsets of all blocks and the file position of the footer
(8 bytes each), first token of every document and the number of tokens, document ids; then the trailer
of six 8-byte numbers: magic, bits, tokens, documents, blocks, footer position. Any range of tokens is
read by seeking to its blocks; 64 ids are unpacked by whole-column shifts in numpy.

Documents are range-partitioned by id and sorted, so files in order of partition hold ascending ids. Each
task streams its documents into a file of its own, under a name that depends on the partition only,
by way of a temporary name: a repeated task replaces its file by an equal one. The manifest has one row
per file; running totals over it give every document its global start. Files go to a folder that driver
and executors share, through ``pyarrow.fs``, which opens local paths and store addresses alike.

Tokenising. The word-level tokenizer never joins text across white space, so each distinct word is
tokenised once per worker process and texts are spelled out by number. The store takes words until
it holds about ``CACHED``; later rare ones are tokenised where they occur, so memory is bounded.

Nulls: a null text is empty, its only id is the end id; a null document id sorts first. Rows of equal id
stand next to each other, ordered by text. An empty table gives no files and an empty result.
Only the id and the text are read, so further columns may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm import text
from terrier.session import scratch_path, written

BLOCK = 4096
CACHED = 2_000_000
END_ID = 1
MAGIC = 0x31534449_4B434150
_NO_ID = np.iinfo(np.int64).min  # stands for a null document id
_NUMBER = np.dtype("<u8")


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """A whole number of 64-bit words for every 64 ids, the last group filled up with zeros."""
    groups = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    groups.ravel()[: len(ids)] = ids
    words = np.zeros((len(groups), bits), _NUMBER)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= groups[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= groups[:, j] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(packed: bytes, n: int, bits: int) -> np.ndarray:
    words = np.frombuffer(packed, _NUMBER).reshape(-1, bits)
    groups = np.empty((len(words), 64), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        groups[:, j] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            groups[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    groups &= np.uint64((1 << bits) - 1)
    return groups.ravel()[:n].astype(np.uint32)


class Writer:
    """Streams documents into one file."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.open, self.waiting = [], 0
        self.blocks, self.documents, self.starts = [], [], []
        self.tokens = self.position = 0

    def add(self, documents: list[int], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.documents.append(np.array(documents, np.int64))
        self.starts.append(self.tokens + np.cumsum(sizes) - sizes)
        self.tokens += len(ids)
        self.open.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * BLOCK:
            self._flush(whole=True)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.open or [np.zeros(0, np.uint32)])
        last = len(ids) // BLOCK * BLOCK if whole else len(ids)
        for at in range(0, last, BLOCK):
            self.blocks.append(self.position)
            packed = pack(ids[at : min(at + BLOCK, last)], self.bits)
            self.out.write(packed)
            self.position += len(packed)
        self.open, self.waiting = [ids[last:]], len(ids) - last

    def close(self) -> None:
        self._flush(whole=False)
        documents = np.concatenate(self.documents or [np.zeros(0, np.int64)])
        starts = np.concatenate([*self.starts, [self.tokens]])
        for numbers in ([*self.blocks, self.position], starts, documents.view(np.uint64),
                        [MAGIC, self.bits, self.tokens, len(documents), len(self.blocks), self.position]):
            self.out.write(np.asarray(numbers).astype(_NUMBER).tobytes())


class Reader:
    """Random access to the tokens of one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        magic, self.bits, self.tokens, n, blocks, footer = self._numbers(size - 48, 6).tolist()
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        self.blocks = self._numbers(footer, blocks + 1)
        self.starts = self._numbers(footer + 8 * (blocks + 1), n + 1).astype(np.int64)
        self.documents = self._numbers(footer + 8 * (blocks + n + 2), n).view(np.int64)

    def _numbers(self, at: int, n: int) -> np.ndarray:
        self.source.seek(at)
        return np.frombuffer(self.source.read(8 * n), _NUMBER)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (end - 1) // BLOCK
        self.source.seek(int(self.blocks[first]))
        raw = self.source.read(int(self.blocks[last + 1] - self.blocks[first]))
        parts = []
        for b in range(first, last + 1):
            own = raw[int(self.blocks[b] - self.blocks[first]) : int(self.blocks[b + 1] - self.blocks[first])]
            parts.append(unpack(own, min(BLOCK, self.tokens - b * BLOCK), self.bits))
        return np.concatenate(parts)[start - first * BLOCK : end - first * BLOCK]


class _Store:
    """Ids of words by the words' hash, in arrays that grow by doubling: about 40 bytes a word."""

    def __init__(self):
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.rows = self.used = 0
        # Sorted hashes and their rows: all but the latest, and the latest.
        self.sorted = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.resize(array, max(n, 2 * len(array)))

    def append(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Puts words behind the kept ones and returns the first one's row; :meth:`keep` keeps them."""
        n, used = self.rows + len(sizes), self.used + len(ids)
        self.begin, self.size = self._room(self.begin, n), self._room(self.size, n)
        self.flat = self._room(self.flat, used)
        self.begin[self.rows : n] = self.used + np.cumsum(sizes) - sizes
        self.size[self.rows : n] = sizes
        self.flat[self.used : used] = ids
        return self.rows

    def keep(self, keys: np.ndarray, rows: np.ndarray, n_ids: int) -> None:
        self.rows += len(rows)
        self.used += n_ids
        old, latest = self.sorted
        latest = self._merged(latest, (keys, rows.astype(np.int32)))
        if len(latest[0]) > max(1 << 16, len(old[0]) // 4):
            old, latest = self._merged(old, latest), (latest[0][:0], latest[1][:0])
        self.sorted = [old, latest]

    @staticmethod
    def _merged(a, b):
        keys, rows = (np.concatenate(x) for x in zip(a, b))
        order = np.argsort(keys, kind="stable")
        return keys[order], rows[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of some hashes, -1 for those that are not kept."""
        out = np.full(len(keys), -1, np.int64)
        for own, rows in self.sorted:
            if len(own):
                at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                hit = own[at] == keys
                out[hit] = rows[at[hit]]
        return out


class WordEncoder:
    """Ids of whole texts from the ids of their distinct words.

    Before words are compared, two things that the tokenizer does to every word anyway are done to the
    bytes: words of ASCII only get lower case, unless they may be a special token, and a full stop or
    comma that ends a word after a letter is a word of its own.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocabulary = max(*vocabulary.values(), end_id) + 1
        self.ends = np.zeros(self.vocabulary, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # The first rows: the end of a document, full stop and comma.
        stop, comma = self._encoded([".", ","])
        self.store = _Store()
        self.store.append(np.array([end_id, *stop, *comma]), np.array([1, len(stop), len(comma)]))
        self.store.rows, self.store.used = 3, 1 + len(stop) + len(comma)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order in which words were tokenised, their ids one after another, and ids per word.

        A word of letters up to U+00FF is one unit, and its last id, and no other, says that a word
        ends there: many are tokenised as one text and told apart by that.
        """
        plain = np.array([w.isalpha() and max(w) <= "ÿ" for w in words], bool)
        order = np.argsort(~plain, kind="stable")
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, int(plain.sum()), 1000):
            own = order[at : min(at + 1000, int(plain.sum()))]
            found = np.array(self._encoded([" ".join([words[i] for i in own])])[0], np.uint32)
            cuts = np.flatnonzero(self.ends[found]) + 1
            if len(cuts) != len(own):
                raise ValueError("the tokenizer does not mark the ends of words")
            ids.append(found)
            sizes.append(np.diff(cuts, prepend=0))
        for at in range(int(plain.sum()), len(words), 1000):
            found = self._encoded([words[i] for i in order[at : at + 1000]])
            ids.append(np.array([i for own in found for i in own], np.uint32))
            sizes.append(np.array([len(own) for own in found], np.int64))
        return order, np.concatenate(ids), np.concatenate(sizes)

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[text.Words, np.ndarray]:
        """Words without a last mark, and that mark's row (or 0) for each."""
        words = text.Words(data, offsets)
        if not len(words.start):
            return words, np.zeros(0, np.int64)
        foreign = np.r_[0, np.cumsum((data >= 128) | (data == ord("<")))]
        bare = foreign[words.end] == foreign[words.start]
        level = np.zeros(len(data) + 1, np.int8)
        level[words.start[bare]] += 1
        level[words.end[bare]] -= 1
        upper = (data >= 65) & (data <= 90) & (np.cumsum(level[:-1]) > 0)
        words.data = data + np.where(upper, 32, 0).astype(np.uint8)
        last, before = data[words.end - 1], data[np.maximum(words.end - 2, 0)]
        mark = np.where(last == ord("."), 1, np.where(last == ord(","), 2, 0))
        letter = ((before | 32) >= 97) & ((before | 32) <= 122)
        # A letter from U+00C0 to U+00FF: C3 and a second byte, which is not that of a sign.
        lead = data[np.maximum(words.end - 3, 0)] == 0xC3
        letter |= lead & (words.end - words.start > 2) & (before >= 128) & (before != 0x97) & (before != 0xB7)
        mark[~letter | (words.end - words.start < 2)] = 0
        cut = mark > 0
        words.solid[words.end[cut] - 1] = False
        words.end = words.end - cut
        return words, mark

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, each with its end id, and their number by document."""
        words, mark = self._units(data, offsets)
        distinct, inverse, first = text.ranked(words.hashes(lower=False))
        known, store = self.store.find(distinct), self.store
        new = np.flatnonzero(known < 0)
        if len(new):
            raw, at = words.data.tobytes(), first[new]
            order, ids, lengths = self._tokenized([
                raw[a:b].decode() for a, b in zip(words.start[at].tolist(), words.end[at].tolist())])
            known[new[order]] = store.append(ids, lengths) + np.arange(len(new))
            if store.rows < CACHED:  # a full store stays as it is: it holds the frequent words
                store.keep(distinct[new], known[new], len(ids))
        # Rows of the text: each word, its mark if any, and the end of each document.
        n_marks = np.cumsum(mark > 0)
        place = np.arange(len(mark)) + words.doc + n_marks - (mark > 0)
        per_doc = np.bincount(words.doc, 1 + (mark > 0), words.n_docs).astype(np.int64) + 1
        rows = np.zeros(per_doc.sum(), np.int64)
        if len(mark):
            rows[place] = known[inverse]
            rows[place[mark > 0] + 1] = mark[mark > 0]
        n = store.size[rows].astype(np.int64)
        at = np.arange(n.sum()) + np.repeat(store.begin[rows] - (np.cumsum(n) - n), n)
        return store.flat[at], np.bincount(np.repeat(np.arange(words.n_docs), per_doc), n, words.n_docs).astype(np.int64)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder_of(path: str, end_id: int) -> WordEncoder:
    """The encoder of this worker process, which serves one task after another."""
    key = (path, end_id)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(path, end_id)
    return _ENCODERS[key]


def _opened(path: str):
    """File system and path; a plain path is one of this machine."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def _writing(folder: str, tokenizer_path: str, end_id: int):
    def write(batches):
        task = TaskContext.get()
        writer = None
        for batch in batches:
            if writer is None:
                encoder = encoder_of(tokenizer_path, end_id)
                system, at = _opened(folder)
                system.create_dir(at, recursive=True)
                name = f"part-{task.partitionId():06d}.ids"
                temporary = f"{at}/_{name}.{task.taskAttemptId()}"
                out = system.open_output_stream(temporary)
                writer = Writer(out, bits_for(encoder.vocabulary))
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            for first, data, offsets in text.parts(batch.column(1)):
                tokens, sizes = encoder.encode(data, offsets)
                writer.add(ids[first : first + len(sizes)], tokens, sizes)
        if writer is not None:
            writer.close()
            out.close()
            system.move(temporary, f"{at}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([task.partitionId()], pa.int64()),
                 pa.array([writer.tokens], pa.int64())], names=["file", "part", "tokens"])

    return write


def _reading(span: int):
    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, at = _opened(path)
                with system.open_input_file(at) as source:
                    reader = Reader(source)
                    first = 0
                    while first < len(reader.documents):
                        limit = reader.starts[first] + span
                        last = max(first + 1, int(np.searchsorted(reader.starts, limit, "right")) - 1)
                        begins = reader.starts[first : last + 1]
                        raw = reader.read(int(begins[0]), int(begins[-1])).astype("<u4").tobytes()
                        offset = 4 * (begins - begins[0])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(reader.documents[first:last],
                                     mask=reader.documents[first:last] == _NO_ID),
                            pa.array(begins[:-1] + start), pa.array(np.diff(begins)),
                            pa.array([zlib.crc32(raw[a:b]) for a, b in zip(offset, offset[1:])], pa.int64()),
                        ], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        first = last

    return read


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
              id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Writes the files and returns the manifest: ``file``, ``part``, ``tokens``, ``start``."""
    sorted_ = (
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        .repartitionByRange("id").sortWithinPartitions("id", "text")
    )
    files = written(sorted_.mapInArrow(
        _writing(folder, tokenizer_path, end_id), "file string, part long, tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_ids(manifest: DataFrame, span: int = 1 << 20) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of all documents, read from the files."""
    n = manifest.count()
    return manifest.select("file", "start").repartition(max(1, n)).mapInArrow(
        _reading(span), "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **options) -> DataFrame:
    """Writes ``docs`` and reads them back; without a folder into one of the shared scratch space."""
    folder = folder or scratch_path(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, tokenizer_path, **options))
