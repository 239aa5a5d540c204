"""Burst detection on a stream.

Counts are kept by the rule's keys and by window of arrival, in Spark's state store, and sent in update mode: whenever a
group grows, its new counts go out. The watermark is on the time of arrival, so it is a statement about the source's order
and not about the events: an event that happened long ago still counts when it comes, in a later window of arrival, and is told as late. State
holds open windows of arrival only.

The sink writes each batch's counts to a folder of the batch's number, over what a broken attempt left there. Counts of a group and window only
grow, so the table of bursts is the greatest of them, summed over windows: repeated batches do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from burstline.functions.calendar import out_of_range
from burstline.operators.detect import Rule, matching

ARRIVED = "arrived"
WINDOW = "1 minute"
# How far the source may deliver out of the order of arrival.
DISORDER = "10 minutes"
# An event that arrives this long after it happened is late.
LATE = "10 minutes"


def is_late(event_time: str, arrived: str, late: str) -> Column:
    """Whether an event arrived too long after it happened; one of unknown time did not."""
    happened = F.timestamp_millis(F.when(~out_of_range(F.col(event_time)), F.col(event_time)))
    return F.coalesce(F.col(arrived) > happened + F.expr(f"INTERVAL {late}"), F.lit(False))


def detect_stream(events: DataFrame, rule: Rule, window: str = WINDOW, disorder: str = DISORDER, late: str = LATE,
                  event_time: str = "eventtime", arrived: str = ARRIVED) -> DataFrame:
    """Running counts of the rule's groups by window of arrival: ``n``, ``events`` and, of these, ``late``.

    ``events`` is a stream with a timestamp ``arrived``, which may not be null. Write it in update mode; ``bursts`` makes the groups over the
    threshold from what is written. A partial window of a group may be below the threshold, so none is left out here. Part sums are formed before
    the shuffle to the state, so a key that holds most rows costs a row per task.
    """
    known = F.coalesce(F.col(arrived), F.raise_error(F.lit(f"an event without {arrived}")).cast("timestamp"))
    timed = matching(events, rule).withColumn(arrived, known).withColumn("_late", is_late(event_time, arrived, late))
    return (
        timed.withWatermark(arrived, disorder)
        .groupBy(F.window(arrived, window).alias("arrival"), *rule.group_keys)
        .agg(F.count(rule.counted).alias("n"), F.count("*").alias("events"), F.count_if("_late").alias("late"))
        .select(*rule.group_keys, F.col("arrival.start").alias("arrival"), "n", "events", "late")
    )


def bursts(counts: DataFrame, rule: Rule) -> DataFrame:
    """The groups over the threshold from all counts written so far, with ``n``, ``events`` and ``late``: those of ``detect``, whatever came late."""
    last = counts.groupBy(*rule.group_keys, "arrival").agg(*[F.max(c).alias(c) for c in ("n", "events", "late")])
    return last.groupBy(*rule.group_keys).agg(*[F.sum(c).alias(c) for c in ("n", "events", "late")]).where(F.col("n") > rule.more_than)


class BurstTable:
    """Counts of a stream below ``path``, one folder for each batch of the stream, and the stream's checkpoint."""

    def __init__(self, spark: SparkSession, path: str, rule: Rule):
        self.spark, self.path, self.rule = spark, path.rstrip("/"), rule

    def start(self, events: DataFrame, trigger: dict | None = None, **times: str) -> StreamingQuery:
        """Start (or go on with) the stream; by default it takes what is there and ends. ``times`` as in ``detect_stream``.

        Another rule or other times need another path: the checkpoint holds counts of these.
        """
        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.path}/counts/batch={number}")

        return (
            detect_stream(events, self.rule, **times).writeStream.outputMode("update")
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()
        )

    def drain(self, events: DataFrame, **times: str) -> None:
        """Take what is there, and fail if anything fell behind the watermark: ``disorder`` was too short for the source."""
        query = self.start(events, **times)
        query.awaitTermination()
        if lost := dropped(query):
            raise ValueError(f"{lost} groups of rows arrived out of order by more than the watermark allows")

    def counts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/counts")

    def bursts(self) -> DataFrame:
        return bursts(self.counts(), self.rule)


def dropped(query: StreamingQuery) -> int:
    """Rows (of part sums) that the state refused as behind the watermark, over the query's known progress."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)
