"""A Bloom filter of join keys, made by a grouped aggregate and tested where the large side is scanned.

For a semi-join whose small side is too large for a broadcast: rows that match nothing are dropped before the shuffle, but for a known
share of false hits. The filter is one row with an array of 64-bit words, read by the large side as a scalar subquery, so it travels
with the scan's tasks and its tests stay inside generated code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.session import pin

BITS_PER_KEY = 10
# 4 MB. With more keys than this has room for, the filter lets more rows pass; see ``worth_it``.
MOST_BITS = 1 << 25
LEAST_BITS = 1 << 10


def bits_for(keys: int) -> int:
    """A power of two with about BITS_PER_KEY bits a key, within bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, keys * BITS_PER_KEY - 1).bit_length()))


def worth_it(keys: int) -> bool:
    """Whether a filter of so many keys still drops most rows that match nothing (at two bits a key it lets about two thirds pass)."""
    return keys * 3 <= MOST_BITS


def same_hash(large: DataFrame, small: DataFrame, keys: list[str]) -> bool:
    """Whether equal keys of both sides have equal hashes: their types are the same, and none is a floating-point number."""
    kinds = [(large.schema[k].dataType, small.schema[k].dataType) for k in keys]
    return all(a == b and not isinstance(a, (T.FloatType, T.DoubleType)) for a, b in kinds)


def _places(keys: list[str], bits: int) -> list[Column]:
    """Four places for a key: from two 64-bit hashes, two runs of bits each. ``bits`` is a power of two up to MOST_BITS."""
    hashes = [F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)]
    return [F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(bits - 1).cast("long")) for h in hashes for shift in (0, 32)]


def key_filter(small: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """One row with column ``words``: the filter of the keys in ``small``. Its aggregate has a row for each 64 bits at most."""
    places = small.select(F.explode(F.array(*_places(keys, bits))).alias("place"))
    word, bit = F.shiftright("place", 6), F.col("place").bitwiseAND(F.lit(63)).cast("int")
    set_words = places.groupBy(word.alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    every = small.sparkSession.range(bits // 64).join(set_words, "id", "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("id", "bits")))
    return pin(every.agg(F.transform(listed, lambda x: x["bits"]).alias("words")))


def may_be_among(filtered: DataFrame, keys: list[str], bits: int) -> Column:
    """False only for rows whose keys are not among those of the filter."""
    words = filtered.select("words").scalar()

    def is_set(place: Column) -> Column:
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        shifted = F.call_function("shiftrightunsigned", word, place.bitwiseAND(F.lit(63)).cast("int"))
        return shifted.bitwiseAND(F.lit(1).cast("long")) == 1

    return reduce(lambda a, b: a & b, [is_set(place) for place in _places(keys, bits)])
