"""Finding the groups of events that break a rule."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.schema import GROUP


@dataclass(frozen=True)
class Rule:
    """Too many matching events with equal keys. The defaults are the failed-logon burst."""

    equal: dict[str, object] = field(default_factory=lambda: {"message": "Logon Failed"})
    keys: tuple[str, ...] = ("accountname", "ipaddress", "year", "dayofyear", "hour", "minute")
    counted: str = "accountname"
    more_than: int = 5

    @property
    def group_keys(self) -> list[str]:
        """The keys within one resource group's events, and the group itself."""
        return [GROUP, *self.keys]


def equals(values: dict[str, object]) -> Column:
    """All given columns have the given values. A null value matches no row."""
    return reduce(lambda a, b: a & b, [F.col(name) == F.lit(value) for name, value in values.items()])


def matching(events: DataFrame, rule: Rule) -> DataFrame:
    return events.where(equals(rule.equal)) if rule.equal else events


def detect(events: DataFrame, rule: Rule) -> DataFrame:
    """Keys over the threshold with their counts: ``n`` of the counted column, ``events`` of all matching rows.

    Counts are formed before the shuffle, so one key holding most rows costs one row per task.
    """
    return (
        matching(events, rule)
        .groupBy(*rule.group_keys)
        .agg(F.count(rule.counted).alias("n"), F.count("*").alias("events"))
        .where(F.col("n") > rule.more_than)
    )


def detect_keys(events: DataFrame, rule: Rule) -> DataFrame:
    return detect(events, rule).select(*rule.group_keys)


def hits_per_group(hits: DataFrame) -> DataFrame:
    return hits.groupBy(GROUP).agg(F.count("*").alias("hits"))


def detect_sql(spark: SparkSession, text: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Rows of a query written as SQL text; tables as ``{name}``, values as ``:name``."""
    return spark.sql(text, args=args or {}, **tables)
