"""Tables in the order of a space-filling curve.

A place falls into a square of ``step`` metres; the bits of its column and row, one from each in turn, make
its Morton key. Near places have near keys: a square of 2^n by 2^n steps is one range of keys, and
any box a few ranges. Stored tables are split by the leading part of the key and sorted by all of it, so a
search reads the folders, and in them the row groups, whose keys lie in the ranges of its box.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
_MIDDLE = 1 << (BITS - 1)
# Shifts and masks that move the bits of a number to every second place.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
           (2, 0x3333333333333333), (1, 0x5555555555555555))

KEY, FOLDER = "PLACE_KEY", "PLACE"
NOWHERE = -1


def _square(coordinate: Column, step: float) -> Column:
    """Number of the square's column or row; far outliers share the outermost one."""
    at = F.floor(coordinate / F.lit(float(step))) + F.lit(_MIDDLE)
    inside = F.greatest(F.lit(0), F.least(F.lit(2 * _MIDDLE - 1), at)).cast("bigint")
    return F.when(coordinate.isNotNull(), inside)


def _spread(number: Column) -> Column:
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def morton(x: Column, y: Column, step: float) -> Column:
    """Morton key of a place, NULL without a position."""
    return _spread(_square(x, step)).bitwiseOR(F.shiftleft(_spread(_square(y, step)), 1))


def _key(column: int, row: int) -> int:
    return sum((column >> i & 1) << 2 * i | (row >> i & 1) << 2 * i + 1 for i in range(BITS))


def box_ranges(x0: float, y0: float, x1: float, y1: float, step: float, most: int = 32) -> list[tuple[int, int]]:
    """Ranges of keys, ends included, that hold every place of a box; about ``most`` at the most.

    Squares of halving size are kept if they lie in the box, dropped if outside, and split if they cross
    its border, until the next halving would need too many ranges.
    """
    def number(v: float) -> int:
        return max(0, min(2 * _MIDDLE - 1, int(v // step) + _MIDDLE))

    left, low, right, high = number(x0), number(y0), number(x1), number(y1)
    inside: list[tuple[int, int]] = []
    border = [(0, 0)]
    size = 1 << BITS
    while border and size > 1:
        half, following, whole = size // 2, [], []
        for cx, cy in border:
            for x, y in ((cx, cy), (cx + half, cy), (cx, cy + half), (cx + half, cy + half)):
                if x > right or y > high or x + half <= left or y + half <= low:
                    continue
                if x >= left and y >= low and x + half - 1 <= right and y + half - 1 <= high:
                    whole.append((_key(x, y), _key(x, y) + half * half - 1))
                else:
                    following.append((x, y))
        if len(_joined(inside + whole)) + len(following) > most:
            break
        inside, border, size = inside + whole, following, half
    return _joined(inside + [(_key(x, y), _key(x, y) + size * size - 1) for x, y in border])


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def store_by_place(df: DataFrame, path: str, step: float, folder_bits: int,
                   x: str = "X_LAMBERT93", y: str = "Y_LAMBERT93") -> DataFrame:
    """Writes a table in Morton order, a folder for each square of 2^``folder_bits`` steps; returns it.

    Rows without a position go to a folder of their own. A folder is written by as many tasks as its size
    asks for, each sorting its range.
    """
    keyed = df.withColumn(KEY, F.coalesce(morton(F.col(x), F.col(y), step), F.lit(NOWHERE)))
    placed = keyed.withColumn(FOLDER, F.when(F.col(KEY) >= 0, F.shiftright(KEY, 2 * folder_bits)).otherwise(F.lit(NOWHERE)))
    placed.repartitionByRange(FOLDER, KEY, F.xxhash64(x, y)).sortWithinPartitions(FOLDER, KEY).write.partitionBy(
        FOLDER).parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def in_box(stored: DataFrame, x0: float, y0: float, x1: float, y1: float, step: float, folder_bits: int,
           x: str = "X_LAMBERT93", y: str = "Y_LAMBERT93") -> DataFrame:
    """Rows of a table of :func:`store_by_place` within a box, from the folders and row groups it meets."""
    keys, folders = F.lit(False), F.lit(False)
    ranges = box_ranges(x0, y0, x1, y1, step)
    for low, high in ranges:
        keys |= F.col(KEY).between(low, high)
    for low, high in _joined([(a >> 2 * folder_bits, b >> 2 * folder_bits) for a, b in ranges]):
        folders |= F.col(FOLDER).between(low, high)
    box = F.col(x).between(x0, x1) & F.col(y).between(y0, y1)
    return stored.where(folders & keys & box)
