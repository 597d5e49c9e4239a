"""Cutting a large table to the keys that another table has, before anything is shuffled.

The keys become a Bloom filter of 64-bit words: a key sets ``_BITS`` bits of one word. The words are built by
a hash aggregation and broadcast as a table, so the test is a hash lookup in the scan of the large
table; nothing passes the driver but the broadcast, whose size is bounded by ``MAX_WORDS``. Beyond that
bound a semi join does the same with two shuffles. Rows of other keys may pass the filter (two or three
in a hundred), so it goes before a join on the key, not in place of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits; a row of the broadcast table takes about 40 bytes, so 40 MB at most.
MAX_WORDS = 1 << 20
KEYS_A_WORD = 6
_BITS = 3


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """Word of a key, and the bits it sets there."""
    place = F.xxhash64(key)
    bits = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    mask = F.lit(0).cast("bigint")
    for i in range(_BITS):
        mask = mask.bitwiseOR(F.call_function(
            "shiftleft", one, F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(place, F.lit(words)).cast("bigint"), mask


def having_keys(df: DataFrame, key: str, asked: DataFrame, asked_key: str, n_asked: int) -> DataFrame:
    """Rows of ``df`` whose key may be among the ``n_asked`` rows of ``asked``; none that is gets lost.

    A NULL key is dropped.
    """
    words = max(1, -(-n_asked // KEYS_A_WORD))
    if words > MAX_WORDS:
        keys = asked.select(F.col(asked_key).alias(key)).distinct()
        return df.join(keys, key, "left_semi")
    word, mask = _place(F.col(asked_key), words)
    bits = asked.where(F.col(asked_key).isNotNull()).select(word.alias("_word"), mask.alias("_mask"))
    table = bits.groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    word, mask = _place(F.col(key), words)
    tested = df.where(F.col(key).isNotNull()).withColumns({"_word": word, "_mask": mask})
    found = tested.join(F.broadcast(table), "_word")
    return found.where(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(*df.columns)
