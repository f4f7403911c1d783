"""Bloom filter of a batch's keys, to leave most rows of a large table out before it is shuffled."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter, 1 MB whatever the batch: with a million keys one in forty others passes.
BITS = 1 << 23
HASHES = 3


def _positions(columns: Iterable[str], bits: int) -> list[Column]:
    """Places of a key in the filter; NULL parts hash as any other value."""
    columns = list(columns)
    first, second = F.xxhash64(*columns), F.xxhash64(*columns, F.lit(1))
    # Cut before they are added up, so that no sum overflows.
    step, size = F.pmod(second, F.lit(bits)), F.lit(bits)
    return [F.pmod(F.pmod(first, size) + step * k, size) for k in range(HASHES)]


def bloom_filter(keys: DataFrame, columns: Iterable[str], bits: int = BITS) -> DataFrame:
    """One row with ``words``: the filter of all keys as 64-bit words.

    Keys are reduced to words by a map-side step, so that what is shuffled and then brought together
    is bounded by the filter's size.
    """
    places = keys.select(F.explode(F.array(*_positions(columns, bits))).alias("place"))
    masks = places.groupBy(F.shiftright("place", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("mask")
    )
    every = keys.sparkSession.range(bits >> 6).join(masks, "id", "left")
    word = F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask"))
    return every.agg(F.sort_array(F.collect_list(word)).alias("words")).select(
        F.col("words.mask").alias("words")
    )


def might_hold(words: DataFrame, columns: Iterable[str], bits: int = BITS) -> Column:
    """Whether a row's key may be among those of the filter: never false for one that is."""
    filled = words.scalar()

    def lit(place: Column) -> Column:
        word = F.get(filled, F.shiftright(place, 6).cast("int"))
        # The bit is moved to the sign, where it can be read without knowing its place.
        return F.call_function("shiftleft", word, (63 - place.bitwiseAND(63)).cast("int")) < 0

    return reduce(lambda a, b: a & b, map(lit, _positions(columns, bits)))
