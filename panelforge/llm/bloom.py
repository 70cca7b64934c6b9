"""A Bloom filter of fixed size, to leave rows out of a shuffle that cannot join.

The filter has 2**25 bits whatever the data, and comes to the driver as at most
2**19 words of 64 bits.  When more keys are set than it can tell apart, it lets more
rows through; it never loses one, and the join behind it is exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ship import ship

BITS = 25


def may_be_in(key: Column, keys: DataFrame) -> Column:
    """True wherever the bigint ``key`` may be in the only column of ``keys``; null is false."""
    ship()
    name = keys.columns[0]
    words = (keys.filter(F.col(name).isNotNull())
             .select(F.explode(F.array(*[F.expr(f"pmod(xxhash64(`{name}`, {i}), {1 << BITS})") for i in range(2)])).alias("bit"))
             .groupBy(F.expr("bit div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(bit, 64) AS int))")).alias("mask")).toPandas())
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64)
    packed = table.view(np.uint64)

    @F.pandas_udf("boolean")
    def check(a: pd.Series, b: pd.Series) -> pd.Series:
        ok = np.ones(len(a), bool)
        for s in (a, b):
            bit = s.to_numpy(np.int64)
            ok &= (packed[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return pd.Series(ok)

    first, second = (F.pmod(F.xxhash64(key, F.lit(i)), F.lit(1 << BITS)) for i in range(2))
    return key.isNotNull() & check(first, second)


