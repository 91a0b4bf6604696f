"""Bloom filters of a key column, built and asked in column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
HASHES = 3
# A filter travels to every task: 2^26 bits are 8 MB, enough for 6.7 million keys.
MAX_BITS = 1 << 26


def _spots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: str, n: int) -> Column | None:
    """The filter of ``n`` distinct keys as a scalar subquery, an array of 64-bit words; None
    where it would be larger than ``MAX_BITS``."""
    bits = max(64, 1 << (max(n, 1) * BITS_PER_KEY - 1).bit_length())
    if bits > MAX_BITS:
        return None
    spot = keys.select(F.explode(F.array(*_spots(F.col(key), bits))).alias("spot"))
    words = spot.groupBy(F.expr("spot div 64").alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("word")
    )
    every = keys.sparkSession.range(bits // 64).join(words, "id", "left")
    entries = F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))))
    return every.agg(F.transform(entries, lambda e: e["word"]).alias("words")).scalar()


def may_contain(filter_words: Column, key: Column, n: int) -> Column:
    """False only for keys that are not in the filter; ``n`` as in ``bloom_filter``."""
    bits = max(64, 1 << (max(n, 1) * BITS_PER_KEY - 1).bit_length())
    asked = [
        F.getbit(F.get(filter_words, F.floor(s / 64).cast("int")), F.pmod(s, F.lit(64)).cast("int")) == 1
        for s in _spots(key, bits)
    ]
    return asked[0] & asked[1] & asked[2]
