"""Bloom filters as arrays of longs, with DataFrame functions only.

A filter comes to a query as a scalar subquery, so testing a row needs no join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import stage

# Size that a filter of ``likely_in`` never exceeds, in bits: 8 MB in every task.
MAX_BITS = 1 << 26
BITS_A_KEY = 10


def _bits(key: Sequence[str], level: int, size: int, hashes: int) -> list[Column]:
    """Bit positions of a key, each by a hash of its own."""
    return [F.pmod(F.xxhash64(*key, F.lit(level), F.lit(i)), F.lit(size)) for i in range(hashes)]


def word_array(keys: DataFrame, key: Sequence[str], level: int, size: int, hashes: int) -> DataFrame:
    """One row, one column ``words``: ``size`` bits with those of the keys set."""
    bits = keys.select(F.explode(F.array(*_bits(key, level, size, hashes))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("word"))
    every = keys.sparkSession.range((size - 1) // 64 + 1).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    words = words.unionByName(every).groupBy("at").agg(F.bit_or("word").alias("word"))
    # size / 64 small rows, whatever the number of keys.
    return words.agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")).select(F.col("w.word").alias("words"))


def passes(words: Column, key: Sequence[str], level: int, size: int, hashes: int) -> Column:
    """Whether all bits of a row's key are set in ``words``."""
    return reduce(lambda x, y: x & y, [
        F.get(words, F.shiftright(bit, 6).cast("int")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))) != 0
        for bit in _bits(key, level, size, hashes)])


def likely_in(keys: DataFrame, key: Sequence[str], max_bits: int = MAX_BITS) -> Column:
    """True for every row whose ``key`` is in the stored ``keys``, and for few others.

    Split a table by it, and only the rows that may match have to be shuffled to
    the exact join.  The filter has a bounded size: very many keys make it less
    selective, never wrong.
    """
    n = max(1, keys.count())
    size = max(64, min(max_bits, BITS_A_KEY * n))
    hashes = max(1, round(size / n * math.log(2)))
    words = stage(word_array(keys, key, 0, size, hashes), "likely")
    return passes(words.scalar(), key, 0, size, hashes)
