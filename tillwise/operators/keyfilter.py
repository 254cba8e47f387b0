"""A Bloom filter of keys as a small table: rows are reduced, or told apart, before they are shuffled.

Every key sets `PROBES` bits in one of `WORDS` words, so a lookup is one join with a table of at most `WORDS` rows,
whatever the number of keys; that bound is what allows the broadcast. A key of the filter always passes. Some others
pass too, so that what passes is still joined or compared exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.session import durable

WORD_BITS = 18  # the word is chosen by so many bits of the hash
WORDS = 2**WORD_BITS
PROBES = 3
# A filter with more of its bits set lets too many other keys pass to be worth a join.
FULL = 0.5
# About so many keys fill it.
CAPACITY = int(-math.log(1 - FULL) * 64 * WORDS / PROBES)

WORD, MASK, BITS = "_tillwise_word", "_tillwise_mask", "_tillwise_bits"


def _hashed(columns: tuple[str, ...]) -> dict[str, Column]:
    key = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    mask = F.lit(0).cast("bigint")
    for probe in range(PROBES):
        place = F.shiftrightunsigned(key, 6 * probe).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return {WORD: F.shiftrightunsigned(key, 64 - WORD_BITS), MASK: mask}


def key_filter(keys: DataFrame, *columns: str) -> DataFrame | None:
    """The words of a filter of the keys, or None where the keys are too many for it."""
    words = durable(keys.select(*[c.alias(n) for n, c in _hashed(columns).items()]).groupBy(WORD).agg(F.bit_or(MASK).alias(BITS)))
    bits = words.agg(F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0))).first()[0]
    return words if bits <= FULL * 64 * WORDS else None


def with_match(df: DataFrame, words: DataFrame, name: str, *columns: str) -> DataFrame:
    """Add whether the key of a row may be in the filter; its columns need the types they had there."""
    found = df.withColumns(_hashed(columns)).join(F.broadcast(words), WORD, "left")
    passed = F.coalesce(F.col(BITS).bitwiseAND(F.col(MASK)) == F.col(MASK), F.lit(False))
    return found.withColumn(name, passed).drop(WORD, MASK, BITS)


def reduced(df: DataFrame, words: DataFrame, *columns: str) -> DataFrame:
    """The rows whose key may be in the filter."""
    found = df.withColumns(_hashed(columns)).join(F.broadcast(words), WORD)
    return found.where(F.col(BITS).bitwiseAND(F.col(MASK)) == F.col(MASK)).drop(WORD, MASK, BITS)
