"""Connected components of a link table of any size, in a few joins.

Each round points every node at the first node next to it (or itself) in an order that is shuffled anew, moves the
links onto the nodes pointed at, and drops links that have become loops. A star of any size takes one round,
and in a chain a fixed share of the nodes goes in each, so rounds grow with the logarithm of the largest component. Rounds end at
written tables: a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import written


def _shuffled(node: Column, turn: int) -> Column:
    """Another 64-bit number for each node, one to one, by shifts alone."""
    x = node.bitwiseXOR(F.lit((turn + 1) * 0x2545F4914F6CDD1D & 0x7FFFFFFFFFFFFFFF))
    x = x.bitwiseXOR(F.shiftleft(x, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node in ``links`` (columns a, b: long).

    Loops and repeated links do no harm; null ends are passed over; no links give no rows.
    """
    first = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = first.select(F.col("a").alias("node")).union(first.select("b")).distinct()
    label, pairs, turn = nodes.withColumn("component", F.col("node")), first, 0
    while not pairs.isEmpty():
        new = pairs.select(_shuffled(F.col("a"), turn).alias("a"), _shuffled(F.col("b"), turn).alias("b"))
        ends = new.select(F.col("a").alias("x"), F.col("b").alias("other")).union(new.select("b", "a"))
        points = written(ends.groupBy("x").agg(F.min("other").alias("low")).select("x", F.least("x", "low").alias("low")), "pointers")
        moved = (
            new.join(points.select(F.col("x").alias("a"), F.col("low").alias("low_a")), "a")
            .join(points.select(F.col("x").alias("b"), F.col("low").alias("low_b")), "b").where("low_a <> low_b")
        )
        pairs = written(moved.select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b")).distinct(), "links")
        label = (
            label.withColumn("x", _shuffled(F.col("component"), turn)).join(points, "x", "left")
            .select("node", F.coalesce("low", "x").alias("component"))
        )
        turn += 1
    label = written(label, "labels")
    smallest = label.groupBy("component").agg(F.min("node").alias("smallest"))
    return label.join(smallest, "component").select("node", F.col("smallest").alias("component"))
