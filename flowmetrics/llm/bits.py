"""A set of 64-bit keys as a bit filter of bounded size, for tasks that scan a large table.

The filter lets every key of the set pass, and few others while it has room; what passes is
joined to the set afterwards. Beyond the bound more passes and the join does more, nothing is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 32 MB.
MOST_BITS = 1 << 28
_BITS_PER_KEY = 32


def filter_bits(keys: DataFrame) -> np.ndarray:
    """Two bits for each ``key`` (bigint); at most ``MOST_BITS / 64`` rows reach the driver."""
    wanted = min(_BITS_PER_KEY * keys.count(), MOST_BITS)
    bits = 1 << max(16, (wanted - 1).bit_length() if wanted else 0)
    mask = F.lit(bits - 1).cast("long")
    places = keys.select(F.explode(F.array("key", F.shiftright("key", 32))).alias("place"))
    at = places.select(F.col("place").bitwiseAND(mask).alias("at"))
    word = F.expr("shiftleft(1L, cast(at & 63 as int))")
    filled = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(word).alias("bits"))
    table = filled.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def passes(keys: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Whether each of the keys (uint64) may be in the set."""
    mask = np.uint64(len(filled) * 64 - 1)
    found = np.ones(len(keys), bool)
    for at in (keys & mask, (keys >> np.uint64(32)) & mask):
        found &= (filled[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found
