"""Joins of a large table with a lookup.

A lookup that is a table or a pinned result has a size the planner knows: it is broadcast if that is small,
and else joined by shuffle, where adaptive execution splits large keys. No job runs beforehand for that. Where the rows
per key of the large side are known anyhow, its frequent keys are spread over salts, more of them the more rows
a key has, so that a key holding a third of all rows does not end in one task. All ways give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.session import pin

BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is spread, about this many rows to a salt.
SALT_ROWS = 1_000_000
# Rows whose key is null match nothing; they are spread over this many salts.
NULL_SALTS = 1 << 20


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(column))).cast("long")
    return F.lit(8).cast("long")


def _measures(df: DataFrame) -> list[Column]:
    width = reduce(lambda a, b: a + b, [_width(field) for field in df.schema], F.lit(16).cast("long"))
    return [F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]


def measure(df: DataFrame) -> Size:
    """Rows and approximate bytes, from one small aggregate."""
    row = df.agg(*_measures(df)).first()
    return Size(row["rows"], row["bytes"])


def pinned(df: DataFrame) -> tuple[DataFrame, Size]:
    """The pinned rows and their size, measured while they are written."""
    seen = Observation()
    held = pin(df.observe(seen, *_measures(df)))
    return held, Size(seen.get["rows"], seen.get["bytes"])


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measure(df).bytes <= (BROADCAST_BYTES if limit is None else limit)


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str,
    salt_by: list[str],
    sizes: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """``rows.join(lookup, keys, how)`` for a lookup of unknown size and skewed ``keys``.

    ``how`` is a join that keeps each left row with its own matches: inner, left, left_semi or
    left_anti. ``small`` says whether the lookup was measured to fit a broadcast, where that is known. ``sizes`` gives
    rows per key in column ``n`` where that is known: the frequent keys of a lookup that is not small are then salted by
    ``salt_by``, columns that differ between rows of one key. The lookup of an inner or left join should have few rows per key; for a semi or anti
    join its keys may repeat without bound.
    """
    only_tests = how in ("left_semi", "left_anti")
    if only_tests:
        lookup = lookup.select(*keys)
    extra = [] if only_tests else [c for c in lookup.columns if c not in keys]
    if small:
        joined = rows.join(F.broadcast(lookup), keys, how)
    else:
        # Repeated keys go before the join's shuffle, most of them already in the tasks that read them.
        lookup = lookup.distinct() if only_tests else lookup
        joined = rows.join(lookup, keys, how) if sizes is None else _salted(rows, lookup, keys, how, salt_by, sizes)
    return joined.select(*rows.columns, *extra)


def _salted(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str, salt_by: list[str], sizes: DataFrame) -> DataFrame:
    salts = F.floor(F.col("n") / F.lit(SALT_ROWS)) + 1
    # One row per SALT_ROWS rows at most; pinned, so that the planner knows its size and both sides see the same.
    hot = pin(sizes.where(F.col("n") > SALT_ROWS).select(*keys, salts.alias("_salts")))
    no_match = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    spread = F.when(no_match, F.lit(NULL_SALTS).cast("long")).otherwise(F.coalesce("_salts", F.lit(1)))
    left = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), spread)).drop("_salts")
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)
    right = lookup.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
