"""The registered queries: one per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.functions.calendar import minute_epoch
from burstline.functions.parsing import parse_failures, parse_fields, quarantined, readable
from burstline.functions.templates import render, template_vars, value_key
from burstline.operators import detect as d
from burstline.operators import paging, policies as p, violations as v
from burstline.operators.drilldown import drilldown_one
from burstline.plans.violation_plan import applied_policies, find_events, find_violations, records, tagged_events
from burstline.session import pin
from burstline.sinks.publish import messages
from burstline.sources import activity as a
from workload import stored, tables as t

RULE = t.DAILY_ERRORS
KEYS = RULE.group_keys
BY_MINUTE = d.Rule(equal={"message": "error"}, more_than=0)
BY_VOLUME = d.Rule(equal={"message": "error"}, keys=t.DAILY_ERRORS.keys, counted="transactionstring1", more_than=1)
BY_ACCOUNT = d.Rule(equal={"message": "error"}, keys=("accountname",), more_than=12)


def many_addresses(events: DataFrame, rule: d.Rule) -> DataFrame:
    """An analyzer as a user would write one: accounts seen at many different addresses."""
    return (
        d.matching(events, rule).groupBy(*rule.group_keys)
        .agg(F.countDistinct("ipaddress").alias("addresses"))
        .where(F.col("addresses") > rule.more_than)
    )


def zero_count(events: DataFrame, rule: d.Rule) -> DataFrame:
    """An analyzer whose ``n`` says nothing: 0 for some hits and null for others."""
    return d.detect_keys(events, rule).withColumn("n", F.when(F.col("dayofyear") % 2 == 0, F.lit(0).cast("long")))


def found(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Hits and the events in them."""
    result = find_events(t.activity(spark, sf), RULE)
    return result.hits, result.events


def applied(spark: SparkSession, sf: str) -> DataFrame:
    scored = p.with_score(p.with_category_name(t.segment_policies(spark, sf), t.categories(spark)), t.scores(spark))
    return applied_policies(scored, t.nation_groups(spark, sf))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Violating events with their policies and values."""
    result = find_events(t.activity(spark, sf), RULE, once=True)
    return tagged_events(result.events, applied(spark, sf), KEYS, result.few)


def scan_activity_multi(spark, sf):
    groups = t.nation_groups(spark, sf).where("functionality = 'ASIA'").select(F.col("id").alias("rg_id"))
    return a.scan_activity_multi(t.activity(spark, sf), groups)


def skipped_groups(spark, sf):
    wanted = t.read(spark, sf, "supplier").select(F.col("s_suppkey").alias("rg_id"))
    return a.skipped_groups(t.activity(spark, sf), wanted)


def bucket_minute(spark, sf):
    parts = ["year", "dayofyear", "hour", "minute"]
    return t.activity(spark, sf).select(
        "eventid", *parts, minute_epoch(*[F.col(c) for c in parts]).alias("minute_epoch")
    )


def detect_sql(spark, sf):
    return d.detect_sql(
        spark,
        "SELECT accountname, ipaddress, count(accountname) AS n FROM {events} WHERE message = :message "
        "GROUP BY accountname, ipaddress HAVING count(accountname) > :more_than",
        {"message": "error", "more_than": 1},
        events=t.activity(spark, sf),
    )


def drill_into_first(spark, sf):
    """The events of one group: the first hit in key order. Without hits there are none."""
    events = t.activity(spark, sf)
    key = d.detect_keys(events, RULE).orderBy(*KEYS).first()
    return drilldown_one(events, RULE, key.asDict()) if key else events.limit(0)


def policy_by_id(spark, sf):
    ids = t.read(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return p.policy_by_id(t.customer_policies(spark, sf), ids).select("id", "name", "functionality")


def policy_by_name(spark, sf):
    wanted = t.requests(spark, sf).select("request_no", "policyname")
    return p.policy_by_name(wanted, t.existing_policies(spark, sf))


def policy_groups(spark, sf):
    return p.policy_groups(t.customer_policies(spark, sf), t.nation_groups(spark, sf)).select("id", "rg_id")


def policy_category_name(spark, sf):
    named = p.with_category_name(t.customer_policies(spark, sf), t.categories(spark))
    return named.select("id", "categoryid", "category")


def tag_score(spark, sf):
    scored = p.with_score(t.customer_policies(spark, sf), t.scores(spark))
    return scored.select("id", "criticality", "risk_score")


def assign_signature_ids(spark, sf):
    return p.assign_signature_ids(t.customer_policies(spark, sf)).select("name", "signatureid")


def policy_defaults(spark, sf):
    return p.policy_defaults(t.requests(spark, sf)).select(
        "request_no", "criticality", "violationentity", "verboseinformation", "grouping_attribute",
        "level1_metadataattribute2", "level1_metadataattribute3",
    )


def display_config(spark, sf):
    return p.display_config(t.requests(spark, sf)).select(
        "request_no", "grouping_attribute", F.array_join("level1_meta", ",").alias("level1_meta"),
        "level2_attribute", F.array_join("level2_meta", ",").alias("level2_meta"),
    )


def policy_threat_id(spark, sf):
    names = t.requests(spark, sf).select(F.col("riskthreatname").alias("threatname"))
    return p.threat_ids(names, pin(t.known_threats(spark, sf))).select("threatname", "riskthreatid", "is_new")


def validate_policies(spark, sf):
    return p.validate(t.requests(spark, sf), t.existing_policies(spark, sf)).select(
        "request_no", "policyname", "exists", "name_ok", "category_ok", "threat_ok", "functionality_ok",
        "criticality_ok", "entity_ok", "functionality_listed", "threat_listed", "accepted",
    )


def replace_categories(spark, sf):
    """Orders name policies, known and unknown ones, and a category for each."""
    categories, policies = t.categories(spark), t.numbered_policies(t.customer_policies(spark, sf))
    old = p.category_rows(p.with_category_name(policies, categories))
    new = t.read(spark, sf, "orders").select(
        (F.col("o_custkey") + 1).alias("policyid"), (F.col("o_custkey") % 13).cast("int").alias("categoryid")
    ).distinct()
    return p.replace_categories(old, new, categories, policies)


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """Requests merged into policies that have ids already, of which one is text that is no number."""
    policies = t.numbered_policies(t.existing_policies(spark, sf)).withColumn(
        "signatureid", F.when(F.col("id") % 2 == 0, F.lit("old")).otherwise((F.col("id") + 1000000).cast("string")))
    return p.merge_policies(t.requests(spark, sf), policies, t.categories(spark), t.known_threats(spark, sf))


def merge_policies(spark, sf):
    return merged(spark, sf).withColumns({c: F.array_join(c, ",") for c in ("level1_meta", "level2_meta")})


def merged_categories(spark, sf):
    """The table of categories after a merge: the new policies' rows join those of the old ones."""
    categories = t.categories(spark)
    policies = merged(spark, sf)
    old = p.category_rows(p.with_category_name(policies.where("not is_new"), categories))
    return p.replace_categories(old, p.category_rows(policies.where("is_new")).drop("category"), categories)


def page_number(spark, sf):
    hits, events = found(spark, sf)
    sizes = hits.select(*KEYS, F.col("events").alias("n"))
    return paging.page_number(events, KEYS, page_size=2, sizes=sizes).select("eventid", *KEYS, "page")


def page_deep(spark, sf):
    """One page of lineitem far behind the first rows."""
    items = t.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return paging.page(items, offset=30_000, page_size=500, order=order)


def group_tables(spark, sf):
    """A view for each nation but one: events of those there are, and the one that is skipped."""
    events = t.activity(spark, sf)
    groups = [row["n_nationkey"] for row in t.read(spark, sf, "nation").select("n_nationkey").collect()]
    for group in groups:
        if group != t.ABSENT_GROUP:
            a.scan_activity(events, group).drop("rg_id").createOrReplaceTempView(a.table_of_group(group))
    rows, skipped = a.scan_group_tables(spark, groups)
    nothing = F.lit(None).cast("string").alias("eventid")
    return rows.select("rg_id", "eventid", F.lit(False).alias("skipped")).unionByName(
        skipped.select("rg_id", nothing, F.lit(True).alias("skipped")))


def rejected_events(spark, sf):
    """Events of violating groups whose tenant cannot be read: no violations, but not lost."""
    result = find_violations(
        t.tenant_activity(spark, sf), t.segment_policies(spark, sf), t.nation_groups(spark, sf), t.scores(spark), RULE, with_rejected=True
    )
    kept = result.violations.groupBy("eventid").agg(F.count("*").alias("violations"))
    return kept.select("eventid", "violations", F.lit(None).cast("string").alias("tenantid")).unionByName(
        result.rejected.select("eventid", F.lit(0).cast("long").alias("violations"), "tenantid"))


def violations_per_page(spark, sf):
    """Pages of the drill-down where the rule counts a column that has nulls."""
    return paging.page_counts(pin(d.detect(t.activity(spark, sf), BY_VOLUME)), KEYS, page_size=2)


def page_number_all(spark, sf):
    """Pages of all events by type: a few groups that grow with the data."""
    events = t.activity(spark, sf).select("eventid", "message", "eventtime")
    return paging.page_number(events, ["message"]).select("eventid", "message", "page")


def parse_strict(spark, sf):
    raw = t.raw_events(spark, sf)
    kept = parse_fields(readable(raw)).select("eventid", "tenantid", F.lit(False).alias("quarantined"))
    set_aside = quarantined(raw).select(
        "eventid", F.lit(None).cast("long").alias("tenantid"), F.lit(True).alias("quarantined")
    )
    return kept.unionByName(set_aside)


def day_epoch(spark, sf):
    return t.activity(spark, sf).select("eventid", "tenanttz", v.event_day("eventtime", "tenanttz").alias("day_epoch"))


def template_variables(spark, sf):
    names = F.array_join(template_vars(F.col("verboseinformation")), ",")
    return t.requests(spark, sf).select("request_no", names.alias("variables"))


def render_template(spark, sf):
    _, events = found(spark, sf)
    return events.select("eventid", render(t.SENTENCE, lambda name, _: F.col(name)).alias("sentence"))


def render_template_agg(spark, sf):
    _, events = found(spark, sf)
    values = v.grouped_values(events, KEYS, t.TOTALS)
    return values.select(*KEYS, render(t.TOTALS, lambda name, kind: F.col(value_key(name, kind))).alias("sentence"))


def render_policy_template(spark, sf):
    return v.sentences(tagged(spark, sf)).select("policy_id", "eventid", "sentence")


def verbose_values(spark, sf):
    return v.verbose_rows(tagged(spark, sf), zone="tenanttz")


def tag_policy(spark, sf):
    return tagged(spark, sf).select(
        "rg_id", "eventid", "eventtime", "accountname", "ipaddress", *v.VIOLATION_FIELDS.values()
    )


def violations(spark, sf):
    rows = find_violations(
        t.activity(spark, sf), t.segment_policies(spark, sf), t.nation_groups(spark, sf), t.scores(spark), RULE
    ).violations
    return rows.select(
        "violation_id", "rg_id", "eventid", "eventtime", "accountname", "policy_id", "policy_name",
        "risk_score", "day_epoch", "sentence",
    )


def violation_tree(spark, sf):
    return v.tree_rows(tagged(spark, sf), zone="tenanttz").withColumns({
        name: F.coalesce(F.array_join(name, "/"), F.lit("")) for name in ("level1_meta", "level2_meta")
    })


def flat(nested: DataFrame) -> DataFrame:
    """All of a record's violation in plain columns: ten fields, both levels of the tree, and the verbose values."""
    violation, text = F.col("violations")[0], lambda names: F.coalesce(F.array_join(names, "/"), F.lit(""))
    tree, verbose = (violation["info"][name] for name in ("violation_details", "verbose_values"))
    root = F.map_entries(F.map_values(tree)[0])[0]
    node, values = root["value"], F.map_values(verbose)[0]
    pairs = F.transform(F.array_sort(F.map_keys(values)), lambda k: F.concat(k, F.lit("="), values[k]))
    return nested.select(
        "eventid", F.size("violations").alias("count"), *[violation[name].alias(name) for name in v.VIOLATION_FIELDS.values()],
        F.map_keys(tree)[0].alias("day_epoch"), F.map_keys(verbose)[0].alias("verbose_day"), root["key"].alias("root"),
        node["level1"].alias("level1"), text(node["level1_meta"]).alias("level1_meta"), node["level2"].alias("level2"),
        text(node["level2_meta"]).alias("level2_meta"), F.array_join(pairs, ",").alias("verbose_values"),
    ).withColumnRenamed("count", "violations")


def violations_nested(spark, sf):
    return flat(v.violations_nested(tagged(spark, sf), zone="tenanttz"))


def violations_json(spark, sf):
    """The messages to publish, read back: event, nested violation, tree and verbose values come through the text."""
    result = find_events(t.activity(spark, sf), RULE, once=True)
    record = records(result.events, applied(spark, sf), KEYS, result.few)
    # Keys of JSON objects are text.
    shape = record.schema.simpleString().replace("map<bigint,", "map<string,")
    back = messages(record).select("key", F.from_json("value", shape).alias("record")).select("key", "record.*")
    days = {name: F.col(name).cast("long") for name in ("day_epoch", "verbose_day")}
    return flat(back.where("key = violation_id")).withColumns(days)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_activity": lambda s, f: a.scan_activity(t.activity(s, f)),
        "scan_activity_multi": scan_activity_multi,
        "skipped_groups": skipped_groups,
        "filter_message": lambda s, f: d.matching(t.activity(s, f), RULE),
        "bucket_minute": bucket_minute,
        "detect": lambda s, f: d.detect(t.activity(s, f), RULE),
        "detect_keys": lambda s, f: d.detect_keys(t.activity(s, f), RULE),
        "detect_sql": detect_sql,
        "burst_hits": lambda s, f: d.detect(t.activity(s, f), BY_MINUTE),
        "hits_per_group": lambda s, f: d.hits_per_group(d.detect(t.activity(s, f), RULE)),
        "drilldown": lambda s, f: found(s, f)[1],
        "drilldown_one": drill_into_first,
        "custom_analyzer": lambda s, f: find_events(t.activity(s, f), BY_ACCOUNT, analyzer=many_addresses).events,
        "policy_by_id": policy_by_id,
        "policy_by_name": policy_by_name,
        "rgs_for_functionality": lambda s, f: p.groups_of_functionality(t.supplier_groups(s, f), "ASIA"),
        "policy_groups": policy_groups,
        "policy_defaults": policy_defaults,
        "display_config": display_config,
        "policy_category_name": policy_category_name,
        "tag_score": tag_score,
        "policy_threat_id": policy_threat_id,
        "validate_policies": validate_policies,
        "replace_categories": replace_categories,
        "assign_signature_ids": assign_signature_ids,
        "merge_policies": merge_policies,
        "merged_categories": merged_categories,
        "page_one": lambda s, f: paging.page(found(s, f)[1], offset=5, page_size=10),
        "page_number": page_number,
        "page_number_all": page_number_all,
        "page_deep": page_deep,
        "violations_per_page": violations_per_page,
        "group_tables": group_tables,
        "rejected_events": rejected_events,
        "analyzer_without_count": lambda s, f: find_events(t.activity(s, f), RULE, analyzer=zero_count).events,
        "parse_fields": lambda s, f: parse_fields(t.raw_events(s, f).withColumn("eventcount", F.length("eventid"))),
        "parse_strict": parse_strict,
        "parse_failures": lambda s, f: parse_failures(t.raw_events(s, f)),
        "day_epoch": day_epoch,
        "template_vars": template_variables,
        "render_template": render_template,
        "render_policy_template": render_policy_template,
        "render_template_agg": render_template_agg,
        "verbose_values": verbose_values,
        "tag_policy": tag_policy,
        "violations": violations,
        "violation_tree": violation_tree,
        "violations_nested": violations_nested,
        "violations_json": violations_json,
        **stored.queries(),
    }
