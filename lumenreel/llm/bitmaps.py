"""Sets of 64-bit hashes as bitmaps for broadcasting: what is in the set is found, and of the rest few
seem to be in it. Built by a native aggregate. A bitmap has 2 ** POWER bits (16 MB), or, fitted to its hashes, SPARE for
each, up to 2 ** MOST (128 MB): so many the driver and each worker hold at most. Beyond 2 ** MOST / SPARE hashes more and more of the rest seem to be in
the set, in the end all of it: what is then passed on grows up to all there is, and its users find out by
joins what is in the set, so that results stay the same."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The size of a bitmap; bits for a hash, and the least and the greatest size, of a fitted one; bits of a block of Spark's bitmaps.
POWER, SPARE, LEAST, MOST, BLOCK = 27, 32, 20, 30, 1 << 15


def leading(digest: str) -> Column:
    """The first eight bytes of a digest as an integer."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def fitted(hashes: DataFrame, column: str) -> np.ndarray:
    """bitmap() in a size that fits; the table is read twice, so it should be a stored one."""
    n = hashes.where(F.col(column).isNotNull()).count()
    return bitmap(hashes, column, min(MOST, max(LEAST, (SPARE * n).bit_length())))


def bitmap(hashes: DataFrame, column: str, power: int = POWER) -> np.ndarray:
    """The bitmap of the hashes (long) in a column; nulls are left out."""
    bit = F.shiftrightunsigned(column, 64 - power)
    rows = hashes.where(F.col(column).isNotNull()).groupBy(F.shiftright(bit, 15).alias("block")).agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit(BLOCK - 1))).alias("bits"))
    out = np.zeros((1 << power) // 8, np.uint8)
    for r in rows.toLocalIterator():
        out[r["block"] * BLOCK // 8 : (r["block"] + 1) * BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (unsigned) seem to be in the set."""
    power = (8 * len(bits)).bit_length() - 1
    at = (hashes >> np.uint64(64 - power)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
