"""Questions from blocks of documents to ranges of 64-bit keys, and the answers back.

Documents are dealt into blocks by a hash of their row; a block holds about ``block_bytes`` of text,
so the number of blocks grows with the input and a block fits a task. A block asks about its own
distinct keys: sorted, cut into as many ranges of the key space as there are blocks, one message for
each range. A range adds up what all blocks say about a key and answers every block in the order it
asked, so keys are not sent back. Keys are hashes: ranges are even, however frequent a key is.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm import text

BLOCK_BYTES = 8 << 20
ASKED = "range int, block int, keys binary, counts binary"
ANSWERED = "block int, range int, counts binary"


def blocks_of(docs: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES,
              ) -> tuple[DataFrame, int]:
    """``id``, ``text`` (null: empty) and ``block`` of every row, dealt, and the number of blocks.

    The number of partitions is given: merging small ones would take work from idle cores.
    """
    own = docs.select(F.col(id_column).alias("id"),
                      F.coalesce(F.col(text_column), F.lit("")).alias("text"),
                      *[c for c in ("train",) if c in docs.columns])
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(n)).cast("int")
    return own.withColumn("block", block).repartition(n, "block"), n


def range_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def edges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` ranges begins in sorted keys, and the end."""
    return np.searchsorted(range_of(keys, n), np.arange(n + 1, dtype=np.uint64), "left")


def _squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences in 6 bytes each, or in 8 if one does not fit."""
    steps = np.diff(keys, prepend=keys[:1])
    narrow = not len(steps) or int(steps.max()) < 1 << 48
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 6 if narrow else 8]
    return (b"\6" if narrow else b"\10") + keys[:1].astype("<u8").tobytes() + raw.tobytes()


def _spread(raw: bytes) -> np.ndarray:
    width = raw[0]
    body = np.frombuffer(raw, np.uint8)[1 + 8 * (len(raw) > 1) :].reshape(-1, width)
    steps = np.zeros((len(body), 8), np.uint8)
    steps[:, :width] = body
    keys = steps.view("<u8").ravel()
    keys[:1] = np.frombuffer(raw, "<u8", min(1, len(keys)), 1)
    return np.cumsum(keys, dtype=np.uint64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, all lowest bytes first, deflated: most are
    small. The first byte tells how many bytes a count has."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    planes = counts.astype(kind.newbyteorder("<")).view(np.uint8).reshape(-1, kind.itemsize).T
    return bytes([kind.itemsize]) + zlib.compress(planes.tobytes(), 1)


def _wide(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").ravel().astype(np.uint64)


def question(block: int, keys: np.ndarray, counts: np.ndarray, n: int) -> pa.Table:
    """Messages about sorted distinct keys, one for each range, empty ones too."""
    at = edges(keys, n)
    return pa.table({
        "range": pa.array(np.arange(n), pa.int32()),
        "block": pa.array(np.full(n, block), pa.int32()),
        "keys": pa.array([_squeezed(keys[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
        "counts": pa.array([_narrow(counts[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
    })


def gathered(messages: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable]:
    """Distinct keys of all messages, their summed counts, how many messages hold each, and a function
    that gives one value for every distinct key as the answer to each message."""
    keys = [_spread(k) for k in messages["keys"].to_pylist()]
    distinct, rank, _ = text.ranked(np.concatenate(keys))
    counts = np.concatenate([_wide(c) for c in messages["counts"].to_pylist()])
    total = np.bincount(rank, counts, len(distinct)).astype(np.uint64)
    places = np.split(rank, np.cumsum([len(k) for k in keys])[:-1])
    return distinct, total, np.bincount(rank, minlength=len(distinct)), lambda i, values: _narrow(values[places[i]])


def totals(messages: pa.Table) -> tuple[np.ndarray, np.ndarray, Callable[[int], bytes]]:
    """Distinct keys of all messages, their summed counts, and the answer to each message."""
    distinct, total, _, answer = gathered(messages)
    return distinct, total, lambda i: answer(i, total)


def answers(messages: pa.Table) -> np.ndarray:
    """Counts from all ranges, in the order of the block's sorted keys."""
    ordered = messages.sort_by("range")["counts"].to_pylist()
    return np.concatenate([_wide(c) for c in ordered] or [np.zeros(0, np.uint64)])
