"""A Bloom filter of fixed size before a join.

It keeps rows that can not match out of a shuffle.  The filter is never the answer:
an exact join follows, and the more keys a filter holds, the more rows pass it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 1 << 26  # 8 MB, whatever the number of keys
_BUCKET = 1 << 15  # bits of one aggregated bitmap


class Bloom:
    """The hashes (long) in column ``h`` of ``keys``."""

    def __init__(self, keys: DataFrame, bits: int = BITS):
        at = F.pmod(F.col("h"), F.lit(bits))
        parts = (keys.select((at + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("n"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")).collect())  # bits / 8 bytes at most
        held = np.zeros(bits // 8, np.uint8)
        for r in parts:
            first = (r["n"] - 1) * _BUCKET // 8
            held[first:first + len(r["bitmap"])] = np.frombuffer(bytes(r["bitmap"]), np.uint8)
        self.bits = bits
        self.held = keys.sparkSession.sparkContext.broadcast(held)

    def hits(self, h: np.ndarray) -> np.ndarray:
        """False for hashes that are not among the keys for certain (inside a task)."""
        at = h % self.bits
        return (self.held.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def may_hold(self, h: Column) -> Column:
        """The same as a column."""
        @F.pandas_udf(T.BooleanType())
        def hit(h: pd.Series) -> pd.Series:
            return pd.Series(self.hits(h.to_numpy(np.int64)))

        return hit(h)
