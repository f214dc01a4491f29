"""A filter of fixed size that tells the tasks which hashes can't be wanted.

A hash sets the bit that its leading bits name. The filter is put together by
Spark, a row for each word of it, so the driver gets the same few megabytes
however many hashes there are; with very many of them it only lets more through.
What passes still has to be joined.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25  # 4 MB


def bit_filter(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Words of 64 bits, with a bit set for every long in ``column``."""
    place = F.shiftrightunsigned(column, 64 - bits)
    rows = hashes.select(F.shiftrightunsigned(place, 6).alias("i"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = rows.filter("i IS NOT NULL").groupBy("i").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("word")).toPandas()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["i"].to_numpy(np.int64)] = found["word"].to_numpy(np.int64)
    return words.view(np.uint64)


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False for hashes that are certainly not in the filter."""
    place = hashes.view(np.uint64) >> np.uint64(64 - (len(words).bit_length() - 1) - 6)
    return (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0
