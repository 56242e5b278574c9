"""A bit map of fixed size that says which 64-bit values cannot be in a set.

It is never larger than ``2 ** bits`` bits (8 MB), whatever the set holds, so it can be sent to
every task. It has no false negatives: what it lets through is joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def bit_map(df: DataFrame, value: Column) -> np.ndarray:
    """The map of the 64-bit values of ``df``, as 64-bit words; at most ``2 ** (BITS - 6)`` rows are collected."""
    place = value.bitwiseAND(F.lit((1 << BITS) - 1))
    words = (
        df.select(
            F.shiftright(place, 6).alias("word"),
            F.expr("1L").alias("one"),
            place.bitwiseAND(F.lit(63)).cast("int").alias("bit"),
        )
        .select("word", F.expr("shiftleft(one, bit)").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
