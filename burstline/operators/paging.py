"""Row numbers, pages and page counts, with no group ever sorted in one task when it is large."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.operators.joins import pinned
from burstline.session import pin

PAGE_SIZE = 1000
EVENT_ORDER = ("eventtime", "eventid")
# A group with more rows than this is numbered across tasks.
HOT_ROWS = 1_000_000
# A table with no more rows than this, as those of settings have, is numbered in one task.
FEW_ROWS = 100_000
# Pages listed from one row at a time.
PAGES_AT_ONCE = 100_000
# Up to this row, a page is cut from a top-k; beyond it, from ranges.
TOP_ROWS = 10_000


def _marked(df: DataFrame, keys: list[str], *others: str) -> DataFrame:
    """The keys under other names, so that a join with rows they came from is unambiguous."""
    return df.select(*[F.col(key).alias(f"_of_{key}") for key in keys], *others)


def _same_group(keys: list[str]) -> Column:
    """Rows beside their marked keys; nulls are equal, as in grouping."""
    return reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])


def numbered(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    sizes: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` as column ``name``.

    ``order`` must be unique within a group. ``sizes`` gives rows per group in column ``n`` where that is already known;
    otherwise the rows are pinned, counted, and numbered from there, so that what they come from runs once.
    Without ``keys`` all rows are one group, which a single task sorts up to FEW_ROWS.
    """
    if not keys:
        rows, size = pinned(rows)
        if size.rows <= min(FEW_ROWS, HOT_ROWS if hot_rows is None else hot_rows):
            return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
        return _numbered_by_range(rows, [], order, name)
    if sizes is None:
        rows = pin(rows)
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    # One row per HOT_ROWS rows at most.
    hot = pin(_marked(sizes.where(F.col("n") > (HOT_ROWS if hot_rows is None else hot_rows)), keys))
    by_window = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    if hot.isEmpty():
        return rows.withColumn(name, by_window)
    large = rows.join(hot, _same_group(keys), "left_semi")
    small = rows.join(hot, _same_group(keys), "left_anti").withColumn(name, by_window)
    return small.unionByName(_numbered_by_range(large, keys, order, name))


def _numbered_by_range(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Range-partition by keys and order, so a large group is spread over many sorted pieces.

    Each row's position in its piece, less where its group starts there, plus the rows of the
    group in earlier pieces, is its number. Positions are pinned before they are counted:
    both uses must see the same cut into pieces.
    """
    by = [*keys, *order]
    placed = pin(
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_piece", F.shiftright("_at", 33))
    runs = placed.groupBy(*keys, "_piece").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_size")
    )
    # One row per group and piece: hot groups and partitions bound its size, not the rows.
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")
    shifts = _marked(runs.withColumn("_shift", shift), [*keys, "_piece"], "_shift")
    number = F.col("_at") + F.col("_shift") + 1
    return placed.join(shifts, _same_group([*keys, "_piece"])).select(
        *rows.columns, number.alias(name)
    )


def page_number(
    rows: DataFrame,
    keys: list[str],
    page_size: int = PAGE_SIZE,
    order: tuple[str, ...] = EVENT_ORDER,
    sizes: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every row with the page of its group it is on, counted from 0."""
    counted = numbered(rows, keys, list(order), "_number", sizes, hot_rows)
    page = F.floor((F.col("_number") - 1) / F.lit(page_size))
    return counted.withColumn("page", page).drop("_number")


def page(rows: DataFrame, offset: int, page_size: int = PAGE_SIZE,
         order: tuple[str, ...] = EVENT_ORDER) -> DataFrame:
    """One page of the rows, in event order. Rows that ``order`` does not tell apart may stand on either of two pages.

    A deep page is found by its first and last row: the order columns alone are cut into ranges and counted, the ranges that
    the page touches are sorted, and only rows between the two ends are read whole.
    """
    if offset + page_size <= TOP_ROWS:
        return rows.orderBy(*order).offset(offset).limit(page_size)
    cut = pin(rows.select(*order).repartitionByRange(*order).withColumn("_piece", F.spark_partition_id()))
    first, last, before, touched = offset + 1, offset + page_size, 0, {}
    for row in cut.groupBy("_piece").count().orderBy("_piece").collect():  # one row per range
        if before < last and before + row["count"] >= first:
            touched[row["_piece"]] = before
        before += row["count"]
    if not touched:
        return rows.limit(0)
    inside = cut.where(F.col("_piece").isin(list(touched))).select(*order).orderBy(*order)
    skip = first - 1 - min(touched.values())
    ends = inside.offset(skip).limit(page_size).select(F.struct(*order).alias("at")).agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    if ends["low"] is None:
        return rows.limit(0)
    at = F.struct(*order)
    kinds = rows.select(*order).schema
    low, high = (F.struct(*[F.lit(end[f.name]).cast(f.dataType).alias(f.name) for f in kinds]) for end in (ends["low"], ends["high"]))
    found = rows.where((at >= low) & (at <= high))
    # Rows equal to the first one that belong to earlier pages.
    skip -= inside.where(at < low).count()
    if ends["low"][0] is not None:
        # The scan can use this one.
        found = found.where(F.col(order[0]).between(ends["low"][0], ends["high"][0]))
    return found.orderBy(*order).offset(skip).limit(page_size)


def page_counts(sizes: DataFrame, keys: list[str], page_size: int = PAGE_SIZE, rows: str = "events") -> DataFrame:
    """Rows on each page of each group, from the group sizes (column ``rows``) alone; pass them pinned.

    A group with a null key has no pages: drilling down into it finds no rows.
    """
    sizes = sizes.dropna(subset=keys).select(*keys, F.col(rows).alias("n"))
    last = F.floor((F.col("n") - 1) / F.lit(page_size))
    # A large group has many pages: its list is made in parts, and the parts spread over tasks.
    parts = (
        sizes.where(F.col("n") > 0)
        .select(*keys, "n", last.alias("_last"))
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), "_last", F.lit(PAGES_AT_ONCE).cast("long"))))
    )
    if not sizes.where(last >= PAGES_AT_ONCE).isEmpty():
        parts = parts.repartition(*keys, "_from")
    to = F.least(F.col("_from") + PAGES_AT_ONCE - 1, F.col("_last"))
    left = F.col("n") - F.col("page") * page_size
    return parts.withColumn("page", F.explode(F.sequence("_from", to))).select(
        *keys, "page", F.least(F.lit(page_size).cast("long"), left).alias("events")
    )
