"""A bitmap of fixed size over the hashes of a distributed column.

Its size is a parameter, not a property of the data: the driver receives at
most ``2**bits / 64`` words however many rows there are.  A test against it
may be true for a row that is not there, never false for one that is, so it
thins a scan before an exact join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 23


def build(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Words of the bitmap whose bits ``column modulo 2**bits`` are set; the
    low bits of the column must be those of a hash."""
    slot = F.col(column).bitwiseAND((1 << bits) - 1)
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(63).cast("int")
    rows = (df.filter(F.col(column).isNotNull()).groupBy(word.alias("w"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("v")).toArrow())
    words = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    words[rows["w"].to_numpy()] = rows["v"].to_numpy()
    return words.view(np.uint64)


def holds(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the unsigned ``values`` may be in the bitmap."""
    bits = int(len(words)).bit_length() - 1 + 6
    slot = values & np.uint64((1 << bits) - 1)
    return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
