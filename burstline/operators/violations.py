"""What a violating event carries: policy, score, tree, sentence values and an id.

The texts that templates and trees look up are put in one map per event (``with_values``), before the event meets
its policies; totals over the event's group are among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.functions.calendar import day_epoch
from burstline.functions.templates import PARSED_FIELDS, render_parsed, value_key, variable_names
from burstline.operators.joins import attach
from burstline.schema import GROUP
from burstline.session import pin

# Policy columns as a violation names them.
VIOLATION_FIELDS = {
    "id": "policy_id",
    "name": "policy_name",
    "violator": "violator",
    "riskthreatid": "risk_threat_id",
    "threatname": "risk_threat_name",
    "risktypeid": "risk_type_id",
    "categoryid": "category_id",
    "category": "category",
    "risk_score": "risk_score",
}
DISPLAY_FIELDS = ["grouping_attribute", "level1_meta", "level2_attribute", "level2_meta", *PARSED_FIELDS]
VALUES = "_values"
# Values are summed with ten places; the sum is rounded once, to two.
SUMMED, MONEY = T.DecimalType(38, 10), T.DecimalType(38, 2)


def tag_policy(events: DataFrame, policies: DataFrame, event_id: str = "eventid") -> DataFrame:
    """Each event once for every policy that applies to its resource group.

    ``policies`` has one row per policy and group (see ``policy_groups``).
    """
    wanted = [F.col(name).alias(alias) for name, alias in VIOLATION_FIELDS.items() if name in policies.columns]
    shown = [name for name in DISPLAY_FIELDS if name in policies.columns]
    return attach(events, policies.select(GROUP, *wanted, *shown), [GROUP], "inner", [event_id])


def with_violation_id(tagged: DataFrame, event_id: str = "eventid") -> DataFrame:
    """A repeatable id, so that a second run can be told from new violations."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("policy_id", GROUP, event_id)])
    return tagged.withColumn("violation_id", F.sha2(text, 256))


def total(name: str, kind: str) -> Column:
    """COUNT is of non-null values. SUM is exact for values of up to ten places, rounded half up to two once it is formed."""
    value = F.count(name) if kind == "COUNT" else F.try_sum(F.col(name).try_cast(SUMMED)).try_cast(MONEY)
    return value.cast("string").alias(value_key(name, kind))


def grouped_values(events: DataFrame, keys: list[str], template: str) -> DataFrame:
    """Per group, the text of each variable of a template, in columns named by ``value_key``.

    A plain variable that is not a key takes the least value of the group.
    """
    wanted = dict.fromkeys(variable_names(template))
    counted = [
        total(name, kind) if kind else F.min(name).cast("string").alias(name)
        for name, kind in wanted if kind or name not in keys
    ]
    return events.groupBy(*keys).agg(*counted) if counted else events.select(*keys).distinct()


def with_values(events: DataFrame, columns: list[str], totals: list[tuple[str, str]] = (),
                keys: list[str] | None = None, few_groups: bool = False, event_id: str = "eventid") -> DataFrame:
    """Events with a map from variable to text: the named columns, and totals of the event's group by ``keys``.

    Without ``keys`` there are no groups, and totals take their defaults. ``few_groups`` says that a row for each group is
    known to fit a broadcast; otherwise the totals are pinned, and their size decides. The wide events stay where they are
    if it is small.
    """
    totals = [t for t in totals if keys and t[0] in events.columns]
    entries = {c: F.col(f"`{c}`").cast("string") for c in columns}
    rows = events
    if totals:
        sums = events.groupBy(*keys).agg(F.struct(*[total(*t) for t in totals]).alias("_totals"))
        sums = F.broadcast(sums) if few_groups else pin(sums)
        rows = attach(events, sums, keys, "left", [event_id])
        entries |= {value_key(*t): F.col("_totals").getField(value_key(*t)) for t in totals}
    names = F.array(*[F.lit(name) for name in entries]).cast("array<string>")
    mapped = F.map_from_arrays(names, F.array(*entries.values()).cast("array<string>"))
    return rows.withColumn(VALUES, mapped).select(*events.columns, VALUES)


def event_day(time: str, zone: str | None) -> Column:
    return day_epoch(F.col(time), F.col(zone) if zone else F.lit(None).cast("string"))


def tree_node() -> Column:
    """One event's place in the display tree of its policy: two levels with their attributes."""
    values = F.col(VALUES)

    def texts(names: str) -> Column:
        return F.transform(F.col(names), lambda name: F.try_element_at(values, name))

    return F.struct(
        F.try_element_at(values, F.col("grouping_attribute")).alias("level1"),
        texts("level1_meta").alias("level1_meta"),
        F.try_element_at(values, F.col("level2_attribute")).alias("level2"),
        texts("level2_meta").alias("level2_meta"),
    )


def tree_rows(tagged: DataFrame, time: str = "eventtime", zone: str | None = None, root: str = "accountname") -> DataFrame:
    """The trees of all violations as rows: policy, day, root, both levels, and events below.

    A plain count, so it forms part sums before the shuffle however large one violator's tree is.
    """
    return (
        tagged.select("policy_id", event_day(time, zone).alias("day_epoch"), F.col(root).alias("root"), tree_node().alias("node"))
        .select("policy_id", "day_epoch", "root", "node.*")
        .groupBy("policy_id", "day_epoch", "root", "level1", "level1_meta", "level2", "level2_meta")
        .agg(F.count("*").alias("events"))
    )


def verbose_map() -> Column:
    """Variables of the policy's template with this event's values; missing ones left out."""
    return F.map_filter(VALUES, lambda k, v: F.array_contains("template_names", k) & v.isNotNull())


def verbose_rows(tagged: DataFrame, time: str = "eventtime", zone: str | None = None, event_id: str = "eventid") -> DataFrame:
    """The verbose values in long form: one row per policy, event and variable."""
    return tagged.select(
        "policy_id", event_id, event_day(time, zone).alias("day_epoch"), F.explode(verbose_map()).alias("variable", "value"),
    )


def violations_nested(tagged: DataFrame, time: str = "eventtime", zone: str | None = None, root: str = "accountname") -> DataFrame:
    """Event columns and ``violations``: a list of one violation with its information by day.

    An event whose day is unknown has no information; one without a root has an empty name there.
    """
    day = event_day(time, zone)
    name = F.coalesce(F.col(root).cast("string"), F.lit(""))

    def by_day(value: Column) -> Column:
        return F.when(day.isNotNull(), F.create_map(day, value))

    info = F.struct(
        by_day(F.create_map(name, tree_node())).alias("violation_details"),
        by_day(verbose_map()).alias("verbose_values"),
    )
    parts = [F.col(alias) for alias in VIOLATION_FIELDS.values() if alias in tagged.columns]
    own = [c for c in tagged.columns if c not in [*VIOLATION_FIELDS.values(), *DISPLAY_FIELDS, VALUES]]
    return tagged.select(*own, F.array(F.struct(*parts, info.alias("info"))).alias("violations"))


def sentences(tagged: DataFrame) -> DataFrame:
    """The sentence of each policy's template for each event."""
    return tagged.withColumn("sentence", render_parsed(F.col(VALUES)))
