"""From groups over the threshold to the events in them: one semi-join for all groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.operators import bloom
from burstline.operators.detect import Rule, equals, matching
from burstline.operators.joins import Size, attach, fits_broadcast, pinned
from burstline.session import pin


HIT = "_hit"


def marked_hits(hits: DataFrame) -> DataFrame:
    """The hits, pinned, with a constant column that ``drilldown`` filters on."""
    return pin(hits.withColumn(HIT, F.lit(1)))


def measured_hits(hits: DataFrame) -> tuple[DataFrame, Size]:
    """The same, and their size."""
    return pinned(hits.withColumn(HIT, F.lit(1)))


def drilldown(events: DataFrame, hits: DataFrame, rule: Rule, event_id: str = "eventid",
              few: bool | None = None, count: int | None = None) -> DataFrame:
    """Whole rows of the matching events whose keys are among ``hits``.

    ``hits`` is used more than once here, so pass it pinned (``marked_hits``). If it fits a broadcast, the wide
    event rows are not shuffled at all. If not, a filter of the hits' keys drops most rows of no hit before the shuffle.
    Rows with a null key belong to no hit. Whatever ``n`` an analyzer gives, a hit is a hit.
    ``few`` says whether the hits fit a broadcast, and ``count`` how many there are; they are measured if it is not told.
    """
    keys = rule.group_keys
    sizes = hits.withColumn("n", F.col("events")) if "events" in hits.columns else None
    if HIT in hits.columns:
        # True of every row. Given a predicate on the hits, the optimizer skips the partitions
        # of the event table that no hit falls in.
        hits = hits.where(F.col(HIT) == 1)
    few = fits_broadcast(hits) if few is None else few
    rows = matching(events, rule)
    return attach(rows if few else near_hits(rows, hits, keys, count), hits.select(*keys), keys, "left_semi", [event_id], sizes, few)


def near_hits(rows: DataFrame, hits: DataFrame, keys: list[str], count: int | None = None) -> DataFrame:
    """All rows of the hits, and few others: the rows that pass a Bloom filter of the hits' keys, tested where they are scanned."""
    count = hits.count() if count is None else count
    if not bloom.worth_it(count) or not bloom.same_hash(rows, hits, keys):
        return rows
    bits = bloom.bits_for(count)
    return rows.where(bloom.may_be_among(bloom.key_filter(hits, keys, bits), keys, bits))


def drilldown_one(events: DataFrame, rule: Rule, key: dict[str, object]) -> DataFrame:
    """Matching events of one given group. The values are bound, never part of a query text."""
    missing = set(rule.group_keys) - set(key)
    if missing:
        raise ValueError(f"no value for {sorted(missing)}")
    return matching(events, rule).where(equals(key))
