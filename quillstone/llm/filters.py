"""A Bloom filter of fixed size over 64-bit hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (8 MB), whatever the number of hashes; what it lets through by chance is sorted out by an exact join or count.
BITS = 1 << 26


def bloom_bits(rows: DataFrame, h: Column) -> np.ndarray:
    """The filter of the hashes ``h`` (bigint), set by the executors; its bits are all that comes to the driver."""
    place = F.explode(F.array(F.pmod(h, F.lit(BITS)), F.pmod(F.shiftright(h, 29), F.lit(BITS))))
    cells = rows.select(place.alias("p")).select((F.col("p") / 32).cast("int").alias("cell"), F.expr("shiftleft(1L, cast(pmod(p, 32) as int))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(BITS // 32, np.uint32)
    for part in cells.toArrow().to_batches():
        bits[part.column(0).to_numpy()] = part.column(1).to_numpy().astype(np.uint32)
    return bits


def passed(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of the hashes (int64): true for all that it holds."""
    hit = np.ones(len(h), bool)
    for p in (h % BITS, (h >> 29) % BITS):
        hit &= (bits[p >> 5] >> (p & 31).astype(np.uint32) & 1).astype(bool)
    return hit
