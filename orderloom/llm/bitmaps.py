"""Bitmaps of hashes, of bounded size, that tell tasks what they need not look at."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 27  # 16 MB, sent to all tasks


class Bitmap(NamedTuple):
    """Hashes of a set, by their last bits. Says yes to all of the set and to some others."""

    cells: np.ndarray
    bits: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        places = keys & np.uint64(self.bits - 1)
        return (self.cells[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) != 0


def bitmap(keys: DataFrame, most: int = BITMAP_BITS) -> Bitmap:
    """The bitmap of the column `key`: 16 bits a key, as a power of two, and never over `most`."""
    bits = 64
    wanted = 16 * keys.count()
    while bits < min(wanted, most):
        bits *= 2
    place = F.col("key").bitwiseAND(F.lit(bits - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    cells = keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    found = cells.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bitmap(out, bits)
