"""Sets of 64-bit hashes as bitmaps over their top bits: bounded in size, without false negatives."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the bits of a bitmap, at most: 16 MB.
BITMAP_BITS = 27


class Bitmap:
    """Set of hash prefixes; it may hold more than was put in, never less."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, np.frombuffer(data, dtype=np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def holds(self, value: int) -> bool:
        at = value >> (64 - self.bits)
        return bool(self.data[at >> 3] >> (at & 7) & 1)


def bitmap_of(hashes: DataFrame) -> tuple[int, bytes]:
    """Bitmap of the column ``h``: 1,024 bits a hash, 2^27 in all at most. ``hashes`` is read twice."""
    n = hashes.count()
    bits = min(BITMAP_BITS, max(15, (1024 * n).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits) + 1
    rows = hashes.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    data = bytearray(1 << bits - 3)
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("b")).collect():  # 4,096 rows of 4 KB at most
        data[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = r["b"]
    return bits, bytes(data)
