"""A bitmap of fixed size that tells which numbers a table may hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The bitmap has 2**BITS bits: 8 MB, however many numbers there are.
BITS = 26


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a long column, built in Spark; at most 2**20 rows of it reach the driver."""
    place = F.col(column).bitwiseAND(F.lit((1 << BITS) - 1))
    words = df.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b")
    )
    out = np.zeros(1 << (BITS - 6), np.uint64)
    found = words.toArrow()
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False for values that the table surely lacks; a table beyond some 2**BITS rows rules out little."""
    place = values.astype(np.int64, copy=False) & ((1 << BITS) - 1)
    return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
