"""Registered queries that write and read back: streams, published pages, kept policies, folders of groups."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.functions.parsing import parse_warnings
from burstline.functions.templates import render, value_key
from burstline.operators import paging, policies as p, violations as v
from burstline.operators.drilldown import near_hits
from burstline.operators.detect import detect, matching
from burstline.plans.violation_plan import find_events, publish_violations
from burstline.session import shared_folder
from burstline.sinks.policy_store import PolicyStore
from burstline.sinks.publish import PageLog, page_messages, pages_of
from burstline.sources import activity as a
from burstline.streaming.bursts import BurstTable
from workload import tables as t

RULE = t.DAILY_ERRORS
KEYS = RULE.group_keys
BATCHES = 3


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def detect_stream(spark, sf):
    """Events that arrive in files, up to 24 minutes after they happened; the stream ends and goes on between the files."""
    arriving = t.activity(spark, sf).withColumn("arrived", F.timestamp_millis("eventtime") + F.make_interval(mins=F.col("eventid").cast("int") % 25))
    ends = arriving.agg(F.min("arrived").alias("first"), F.max("arrived").alias("last")).first()
    folder, table = new_folder(spark, "arriving"), BurstTable(spark, new_folder(spark, "bursts"), RULE)
    for batch in range(BATCHES):
        low, high = (ends["first"] + (ends["last"] - ends["first"]) * k / BATCHES for k in (batch, batch + 1))
        there = (F.col("arrived") >= low) & ((F.col("arrived") < high) if batch + 1 < BATCHES else F.lit(True))
        arriving.where(there).write.mode("append").parquet(folder)
        table.drain(spark.readStream.schema(arriving.schema).parquet(folder), window="1 day")
    return table.bursts()


def published_pages(spark, sf):
    """Pages of the drill-down, published by two runs: the first knows half of the groups, the second all."""
    found = find_events(t.activity(spark, sf), RULE, once=True)
    events = found.events.select("rg_id", "eventid", "eventtime", "accountname", "year", "dayofyear")
    paged = paging.page_number(events, KEYS, page_size=2, sizes=found.hits.select(*KEYS, F.col("events").alias("n")))
    log = PageLog(spark, new_folder(spark, "pages"))
    for known in (paged.where("rg_id % 2 = 0"), paged):
        log.publish(known, KEYS, key="eventid", parts=4)
    there = log.messages().groupBy("page_id").agg(F.count("*").alias("messages"))
    pages = pages_of(page_messages(paged, KEYS, "eventid"), KEYS).drop("digest")
    return pages.join(log.published().select("page_id", "digest"), "page_id").join(there, "page_id").select(*KEYS, "page", "events", "digest", "messages")


def published_counts(spark, sf):
    """The whole line to published pages, run twice: what each run read, set aside, formed and sent."""
    log = PageLog(spark, new_folder(spark, "counted"))
    runs = []
    for run in (1, 2):
        done = publish_violations(
            t.tenant_activity(spark, sf), t.segment_policies(spark, sf), t.nation_groups(spark, sf), t.scores(spark), RULE, log, page_size=2)
        runs.append((run, done.read, done.rejected, done.formed, done.sent.events, done.sent.pages, done.sent.known))
    return spark.createDataFrame(runs, "run int, read long, rejected long, formed long, events long, pages long, known_pages long")


def category_lists(spark, sf):
    """Categories of stored policies after each customer with orders sent a list: of two, of none, or no list at all."""
    categories, policies = t.categories(spark), t.numbered_policies(t.customer_policies(spark, sf))
    store = PolicyStore(spark, new_folder(spark, "policies"))
    store.create(p.with_category_name(policies, categories), t.known_threats(spark, sf).select("id", "name"))
    key = F.col("o_custkey")
    given = F.array((key % 13).cast("int"), ((key + 3) % 13).cast("int"))
    lists = t.read(spark, sf, "orders").select(key).distinct().select(
        (key + 1).alias("policyid"), F.when(key % 5 == 0, F.array().cast("array<int>")).when(key % 5 != 1, given).alias("categoryids"))
    store.replace_categories(lists, categories)
    return store.read("categories").select("policyid", "categoryid", "riskthreatid", "risktypeid", "category")


def kept_ids(spark, sf):
    """Ids after some requests made policies, these were deleted, and all requests came: none is given out twice."""
    categories, wanted = t.categories(spark), t.requests(spark, sf)
    policies = t.numbered_policies(t.existing_policies(spark, sf)).withColumn("signatureid", (F.col("id") + 1000000).cast("string"))
    store = PolicyStore(spark, new_folder(spark, "policies"))
    store.create(p.with_category_name(policies, categories), t.known_threats(spark, sf).select("id", "name"))
    early = store.merge(wanted.where("request_no % 2 = 0"), categories)
    store.delete(early.select("id"))
    store.merge(wanted, categories)
    return store.read("policies").select("name", "id", "signatureid", "risktypeid")


def display_config_xml(spark, sf):
    """Display settings written as XML and read back."""
    stored = p.to_display_xml(p.display_config(t.requests(spark, sf))).select("request_no", "violationdisplayconfig")
    return p.from_display_xml(stored).select(
        "request_no", "grouping_attribute", F.array_join("level1_meta", ",").alias("level1_meta"),
        "level2_attribute", F.array_join("level2_meta", ",").alias("level2_meta"),
        F.col("violationdisplayconfig").isNotNull().alias("stored"), "display_unreadable",
    )


def group_folders(spark, sf):
    """A folder of files for each nation but one: events of those there are in one scan, and the one that is skipped."""
    events, root = t.activity(spark, sf), new_folder(spark, "groups")
    groups = [row["n_nationkey"] for row in t.read(spark, sf, "nation").select("n_nationkey").collect()]
    there = events.where(F.col("rg_id") != t.ABSENT_GROUP)
    there.withColumn("_of", F.concat(F.lit("activity"), "rg_id", F.lit("incoming"))).repartition("_of").write.partitionBy("_of").parquet(root)
    rows, skipped = a.scan_group_folders(spark, root, groups, events.drop("rg_id").schema, folder=lambda g: f"_of=activity{g}incoming")
    nothing = F.lit(None).cast("string").alias("eventid")
    return rows.select("rg_id", "eventid", F.lit(False).alias("skipped")).unionByName(
        skipped.select("rg_id", nothing, F.lit(True).alias("skipped")))


def drilldown_filtered(spark, sf):
    """The drill-down as with more hits than a broadcast holds: rows that pass the filter of the hits' keys, and the join."""
    return find_events(t.activity(spark, sf), RULE, few=False).events


def rows_near_hits(spark, sf):
    """How many of the matching rows pass the filter at least: every row of a hit does."""
    events = matching(t.activity(spark, sf), RULE)
    hits = detect(t.activity(spark, sf), RULE)
    passed = near_hits(events, hits, KEYS).select("eventid", *KEYS)
    return passed.join(hits.select(*KEYS), KEYS, "left_semi").select("eventid")


def totals_of_thousandths(spark, sf):
    """Totals of amounts with three decimals: summed exactly and rounded once."""
    found = find_events(t.activity(spark, sf), RULE).events.withColumn("bytesout", F.col("bytesout").cast("decimal(18,3)") * F.lit(0.001).cast("decimal(4,3)"))
    values = v.grouped_values(found, KEYS, t.TOTALS)
    return values.select(*KEYS, render(t.TOTALS, lambda name, kind: F.col(value_key(name, kind))).alias("sentence"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "detect_stream": detect_stream,
        "published_pages": published_pages,
        "published_counts": published_counts,
        "category_lists": category_lists,
        "kept_ids": kept_ids,
        "display_config_xml": display_config_xml,
        "group_folders": group_folders,
        "drilldown_filtered": drilldown_filtered,
        "rows_near_hits": rows_near_hits,
        "parse_warnings": lambda s, f: parse_warnings(t.raw_events(s, f)),
        "totals_of_thousandths": totals_of_thousandths,
    }
