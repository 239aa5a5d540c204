"""Tags, trees, sentences, sources, sinks, and the whole line."""

import json

import pytest
from pyspark.sql import functions as F

from burstline.functions.templates import render, value_key
from burstline.operators import violations as v
from burstline.operators.detect import Rule
from burstline.operators.policies import with_score
from burstline.plans.violation_plan import (
    applied_policies, describe, find_events, find_violations, records, tagged_events, used_variables,
)
from burstline.schema import event_schema
from burstline.sinks.publish import messages, publish_to_files
from burstline.sources import activity as a

RULE = Rule(keys=("accountname", "year", "dayofyear", "hour", "minute"))
SENTENCE = 'Account ${accountname!"ACCOUNTNAME"} did ${transactionstring1!"ACTIVITY"} from ${ipaddress!"UNKNOWN"}'


@pytest.fixture(scope="module")
def events(spark):
    rows = [(g, f"{g}-{i}", 1522540800000 + i, "ann", "" if i == 0 else "1.1.1.1", "Logon Failed", 2018, 91, 0, 0, "login", "7", "America/New_York")
            for g in (1, 2) for i in range(6)]
    rows.append((1, "bad", 1522540800010, "ann", "1.1.1.1", "Logon Failed", 2018, 91, 0, 0, "login", "x", None))
    return spark.createDataFrame(rows, "rg_id long, eventid string, eventtime long, accountname string, ipaddress string, message string, "
                                 "year int, dayofyear int, hour int, minute int, transactionstring1 string, tenantid string, tenanttz string")


@pytest.fixture(scope="module")
def policies(spark):
    return spark.createDataFrame([
        (10, "burst", -1, "Audit", 1, "INSIDER THREAT", "threat", 3, 4, "High", "Activityaccount", SENTENCE, "message", ["transactionstring1", "nosuch"], "ipaddress", None),
        (11, "single", 2, "Audit", 1, "INSIDER THREAT", "threat", 3, 4, "Severe", "Users", None, None, None, "accountname", ["hour"]),
    ], "id long, name string, resourcegroupid long, functionality string, categoryid int, category string, threatname string, "
       "riskthreatid long, risktypeid long, criticality string, violator string, verboseinfotemplate string, "
       "grouping_attribute string, level1_meta array<string>, level2_attribute string, level2_meta array<string>")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([(1, "Audit"), (2, "Audit"), (3, "Firewall")], "id long, functionality string")


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([("Low", 1.0), ("High", 3.0)], "criticality string, score double")


@pytest.fixture(scope="module")
def result(events, policies, groups, scores):
    # Group 1 has six good rows and one with an unreadable tenant, so the burst is found in both.
    return find_violations(events.where("eventtime >= 0"), policies, groups, scores, RULE).violations


@pytest.fixture(scope="module")
def tagged(events, policies, groups, scores):
    applied = applied_policies(with_score(policies, scores), groups)
    return tagged_events(find_events(events, RULE, applied).events, applied, RULE.group_keys)


def test_whole_line(result):
    rows = result.collect()
    assert {(r["policy_id"], r["eventid"]) for r in rows} == (
        {(10, f"{g}-{i}") for g in (1, 2) for i in range(6)} | {(11, f"2-{i}") for i in range(6)})
    one = next(r for r in rows if r["policy_id"] == 10 and r["eventid"] == "1-0")
    assert one["sentence"] == "Account ann did login from UNKNOWN"
    assert (one["risk_score"], one["category"], one["violator"], one["risk_threat_id"], one["risk_type_id"]) == (3.0, "INSIDER THREAT", "Activityaccount", 3, 4)
    assert one["day_epoch"] == 1522468800000 and one["tenantid"] == 7
    other = next(r for r in rows if r["policy_id"] == 11)
    assert other["risk_score"] is None and other["sentence"] is None


def test_ids_repeat(result, events, policies, groups, scores):
    again = find_violations(events.orderBy(F.desc("eventid")), policies, groups, scores, RULE).violations
    ids = sorted(r["violation_id"] for r in result.collect())
    assert ids == sorted(r["violation_id"] for r in again.collect())
    assert len(set(ids)) == 18


def test_nothing_is_lost_silently(events, policies, groups, scores):
    """Rejected rows and groups without events are part of the result."""
    extra = groups.union(groups.sparkSession.createDataFrame([(77, "Audit")], "id long, functionality string"))
    result = find_violations(events, policies, extra, scores, RULE)
    assert [(r["eventid"], r["tenantid"]) for r in result.rejected.collect()] == [("bad", "x")]
    assert [r["rg_id"] for r in result.skipped.collect()] == [77]
    assert result.violations.where("eventid = 'bad'").count() == 0


@pytest.mark.parametrize("n", [0, -3, None])
def test_hits_of_an_analyzer_count_whatever_n_is(events, policies, groups, scores, n):
    def odd(df, rule):
        return df.where("message = 'Logon Failed'").select(*rule.group_keys).distinct().withColumn("n", F.lit(n).cast("long"))

    assert find_violations(events, policies, groups, scores, RULE, odd).violations.count() == 18


def test_used_variables(events, policies, groups):
    assert used_variables(applied_policies(policies, groups), events) == (["accountname", "ipaddress", "message", "hour", "transactionstring1"], [])


def test_totals_in_a_policy_template(spark, events, policies, groups, scores):
    """Per policy and hit: COUNT is of values that are there, SUM is exact, and a total nobody knows takes its default."""
    text = ('Account ${accountname!"?"} did ${transactionstring1$COUNT!"Unknown"} amounting to ${bytesout$SUM!"UNKNOWN"}, '
            '${nosuch$SUM!"none"}, ${ipaddress}')
    rows = events.withColumns({
        "bytesout": F.when(F.col("rg_id") == 1, F.substring("eventid", 3, 1).cast("int")),
        "transactionstring1": F.when(F.col("eventid") != "1-2", F.col("transactionstring1")),
    })
    counted = policies.where("id = 10").withColumn("verboseinfotemplate", F.lit(text))
    got = {r["eventid"]: r["sentence"] for r in find_violations(rows, counted, groups, scores, RULE).violations.collect()}
    assert got["1-1"] == "Account ann did 5 amounting to 15.00, none, 1.1.1.1"
    assert got["2-0"] == "Account ann did 6 amounting to UNKNOWN, none, "
    # Events found in another way have no groups to count over.
    applied = applied_policies(with_score(counted, scores), groups)
    loose = describe(rows.where("tenantid = '7'"), applied).where("eventid = '1-1'").first()
    assert loose["sentence"] == "Account ann did Unknown amounting to UNKNOWN, none, 1.1.1.1"
    for few in (True, False):
        rendered = describe(find_events(rows, RULE).events, applied, RULE.group_keys, few)
        assert {r["sentence"] for r in rendered.where("eventid = '1-1'").collect()} == {got["1-1"]}


def test_plan_reads_templates_and_maps_once(tagged, capsys):
    """No regular expression and no second map in what runs per row."""
    for df in (v.verbose_rows(tagged), v.tree_rows(tagged), v.violations_nested(tagged), v.sentences(tagged)):
        df.explain("extended")
        plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert "regexp" not in plan and plan.count("map_from_arrays") <= 1


def test_tree(tagged):
    got = {(r["policy_id"], r["root"], r["level1"], tuple(r["level1_meta"] or ()), r["level2"], tuple(r["level2_meta"] or ())): r["events"]
           for r in v.tree_rows(tagged, zone="tenanttz").collect()}
    assert got == {
        (10, "ann", "Logon Failed", ("login", None), "1.1.1.1", ()): 10,
        (10, "ann", "Logon Failed", ("login", None), "", ()): 2,
        (11, "ann", None, (), "ann", ("0",)): 6,
    }


def test_nested_and_verbose(tagged):
    nested = v.violations_nested(tagged, zone="tenanttz").where("eventid = '2-1'").collect()
    assert sorted(len(r["violations"]) for r in nested) == [1, 1]
    violation = next(r["violations"][0] for r in nested if r["violations"][0]["policy_id"] == 10)
    node = violation["info"]["violation_details"][1522468800000]["ann"]
    assert (node["level1"], node["level2"], node["level1_meta"]) == ("Logon Failed", "1.1.1.1", ["login", None])
    assert violation["info"]["verbose_values"][1522468800000] == {"accountname": "ann", "transactionstring1": "login", "ipaddress": "1.1.1.1"}
    long = v.verbose_rows(tagged, zone="tenanttz").where("eventid = '1-1'").collect()
    assert {(r["policy_id"], r["variable"], r["value"]) for r in long} == {
        (10, "accountname", "ann"), (10, "transactionstring1", "login"), (10, "ipaddress", "1.1.1.1")}


def test_published_record(events, policies, groups, scores):
    """One message holds the event, its violation, the tree and the verbose values."""
    applied = applied_policies(with_score(policies, scores), groups)
    message = messages(records(find_events(events, RULE, applied).events, applied, RULE.group_keys)).where("value like '%\"1-1\"%'").first()
    record = json.loads(message["value"])
    violation = record["violations"][0]
    assert record["eventid"] == "1-1" and record["violation_id"] == message["key"] and record["tenantid"] == 7
    assert violation["policy_name"] == "burst" and violation["risk_score"] == 3.0
    assert violation["info"]["violation_details"]["1522468800000"]["ann"]["level1"] == "Logon Failed"
    assert violation["info"]["verbose_values"]["1522468800000"]["accountname"] == "ann"
    assert not {"_values", "template_keys"} & set(record)


def test_sums_and_counts_in_sentences(spark):
    rows = [("a", "x", 5), ("a", None, 7), ("b", None, None)]
    df = spark.createDataFrame(rows, "accountname string, transactionstring1 string, bytesout int")
    text = '${accountname} ${transactionstring1$COUNT!"Unknown"} ${bytesout$SUM!"UNKNOWN"} ${transactionstring1!"?"}'
    values = v.grouped_values(df, ["accountname"], text)
    got = values.select(render(text, lambda n, k: F.col(f"`{value_key(n, k)}`")).alias("s")).collect()
    assert {r["s"] for r in got} == {"a 1 12.00 x", "b 0 UNKNOWN ?"}


def test_scans(spark, events, monkeypatch):
    assert a.scan_activity(events).count() == 7 and a.scan_activity(events, 2).count() == 6
    groups = spark.createDataFrame([(2,), (3,)], "rg_id long")
    assert {r["rg_id"] for r in a.scan_activity_multi(events, groups).collect()} == {2}
    monkeypatch.setattr(a, "IN_LIST", 1)
    assert {r["rg_id"] for r in a.scan_activity_multi(events, groups).collect()} == {2}
    assert a.scan_activity_multi(events, groups.where("false")).count() == 0
    assert [r["rg_id"] for r in a.skipped_groups(events, groups).collect()] == [3]


def test_one_table_per_group(spark, events):
    events.where("rg_id = 1").drop("rg_id").createOrReplaceTempView(a.table_of_group(1))
    events.where("rg_id = 2").drop("rg_id", "tenanttz").createOrReplaceTempView(a.table_of_group(2))
    union, skipped = a.scan_group_tables(spark, [1, 2, 9005])
    assert [r["rg_id"] for r in skipped.collect()] == [9005]
    assert union.groupBy("rg_id").count().orderBy("rg_id").collect() == [(1, 7), (2, 6)]
    nothing, skipped = a.scan_group_tables(spark, [9005])
    assert nothing is None and skipped.count() == 1
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR|INVALID"):
        a.scan_group_tables(spark, [1], lambda group: "no table name at all")


def test_many_group_tables_make_a_shallow_union(spark, events):
    events.where("rg_id = 1").drop("rg_id").createOrReplaceTempView(a.table_of_group(1))
    union, _ = a.scan_group_tables(spark, range(64), lambda group: a.table_of_group(1))
    assert union.count() == 64 * 7 and union.where("rg_id = 3").count() == 7


def test_files_and_messages(spark, result, tmp_path):
    publish_to_files(result, str(tmp_path / "out"))
    back = spark.read.schema(event_schema(["eventid", "eventtime", "rg_id", "violation_id"])).json(str(tmp_path / "out"))
    assert sorted(r["violation_id"] for r in back.collect()) == sorted(r["violation_id"] for r in result.collect())
    assert {r["rg_id"] for r in back.collect()} == {1, 2}
    publish_to_files(result, str(tmp_path / "parquet"), "parquet", by=("rg_id",))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 18
    message = messages(result).first()
    assert json.loads(message["value"])["violation_id"] == message["key"]


def test_odd_rows_do_not_fail_the_job(tagged):
    odd = tagged.withColumns({"eventtime": F.when(F.col("eventid") == "1-1", 2**63 - 1).otherwise(F.lit(None)),
                              "accountname": F.lit(None).cast("string")})
    row = v.violations_nested(odd).where("eventid = '1-1'").first()
    assert row["violations"][0]["info"]["violation_details"] is None
    assert v.tree_rows(odd).agg(F.sum("events")).first()[0] == 18


def test_policies_that_name_no_column(events, policies, groups, scores):
    names = ("grouping_attribute", "level1_meta", "level2_attribute", "level2_meta", "verboseinfotemplate")
    plain = policies.withColumns({c: F.lit(None).cast(k) for c, k in policies.dtypes if c in names})
    applied = applied_policies(with_score(plain, scores), groups)
    assert used_variables(applied, events) == ([], [])
    tagged = tagged_events(find_events(events, RULE, applied).events, applied, RULE.group_keys)
    assert {r["sentence"] for r in v.sentences(tagged).collect()} == {None}
    assert v.verbose_rows(tagged).count() == 0
