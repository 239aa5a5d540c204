"""Filters of hit keys, folders of many groups, warnings, sums, and how often events are read."""

import pytest
from pyspark.sql import functions as F

from burstline.functions.parsing import parse_failures, parse_warnings
from burstline.operators import bloom, joins, paging, violations as v
from burstline.operators.detect import Rule, detect
from burstline.operators.drilldown import drilldown, marked_hits, near_hits
from burstline.operators.policies import assign_ids
from burstline.plans.violation_plan import find_violations
from burstline.sources import activity as a
from tests.test_violations import RULE as BURST, events, groups, policies, scores  # noqa: F401

RULE = Rule(keys=("accountname",), more_than=2)


def many(spark, accounts=4000, hit_every=40):
    """Most accounts have one event, some have four."""
    return spark.range(accounts).select(
        (F.col("id") % 5).alias("rg_id"), F.col("id").cast("string").alias("accountname"), F.lit("Logon Failed").alias("message"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("id") % hit_every == 0, 4).otherwise(1))).alias("k"),
    ).withColumn("eventid", F.concat_ws(".", "accountname", "k"))


def test_a_drill_down_by_shuffle_sends_few_other_rows(spark, monkeypatch, capsys):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    rows = many(spark)
    hits = marked_hits(detect(rows, RULE))
    found = drilldown(rows, hits, RULE, few=False)
    passed = near_hits(rows, hits, RULE.group_keys)
    want = {f"{k}.{j}" for k in range(0, 4000, 40) for j in range(1, 5)}
    assert {r["eventid"] for r in found.collect()} == want
    got = [r["eventid"] for r in passed.collect()]
    assert set(got) >= want and len(got) < 2 * len(want)
    found.explain("formatted")
    plan = capsys.readouterr().out
    # The filter stands where the rows are made, before they are dealt out.
    tree = plan[: plan.index("(1)")] if "Subqueries" not in plan else plan[: plan.index("Subqueries")]
    assert "Subquery" in plan and tree.index("Exchange") < tree.rindex("Filter")


def test_every_key_of_the_filter_passes_and_few_others_do(spark):
    keys = spark.range(0, 30_000, 3).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 6 == 0, F.col("id")).alias("n"))
    other = spark.range(1, 30_000, 3).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"))
    bits = bloom.bits_for(10_000)
    made = bloom.key_filter(keys, ["k", "n"], bits)
    passing = lambda df: df.where(bloom.may_be_among(made, ["k", "n"], bits)).count()
    assert passing(keys) == 10_000 and passing(other) < 500
    assert made.count() == 1 and bits == 1 << 17


def test_sizes_of_filters():
    assert [bloom.bits_for(n) for n in (0, 1, 100, 1000, 10**9)] == [1 << 10, 1 << 10, 1 << 10, 1 << 14, bloom.MOST_BITS]
    assert bloom.worth_it(1000) and bloom.worth_it(10_000_000) and not bloom.worth_it(20_000_000)


def test_no_filter_where_hashes_may_differ(spark):
    rows = many(spark, 100, 10)
    wide = detect(rows, RULE).withColumn("rg_id", F.col("rg_id").cast("int"))
    assert not bloom.same_hash(rows, wide, RULE.group_keys)
    assert near_hits(rows, wide, RULE.group_keys) is rows
    assert drilldown(rows, wide, RULE, few=False).count() == 40
    real = rows.withColumn("rg_id", F.col("rg_id").cast("double"))
    assert not bloom.same_hash(real, detect(real, RULE), RULE.group_keys)
    assert drilldown(rows, detect(rows, RULE).limit(0), RULE, few=False).count() == 0


def test_violations_read_the_events_twice(spark, events, policies, groups, scores, tmp_path):  # noqa: F811
    """Once to detect, once to drill down, whatever of the result is used."""
    events.write.parquet(str(tmp_path / "events"))
    stored = spark.read.schema(events.schema).parquet(str(tmp_path / "events"))
    found = find_violations(stored, policies, groups, scores, BURST, with_rejected=True)
    for df in (found.violations, found.rejected):
        assert str(tmp_path) not in df._jdf.queryExecution().optimizedPlan().toString()
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        files = [f for k in range(leaves.size()) for f in [leaves.apply(k).toString()]]
        assert not any(str(tmp_path) in f for f in files)
    assert set(found.violations.inputFiles()).isdisjoint(stored.inputFiles())
    assert set(found.rejected.inputFiles()).isdisjoint(stored.inputFiles())


def test_building_violations_takes_few_jobs(spark, events, policies, groups, scores):  # noqa: F811
    spark.sparkContext.setJobGroup("violations", "")
    find_violations(events, policies, groups, scores, BURST)
    spark.sparkContext.setLocalProperty("spark.job.description", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("violations")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 15


@pytest.mark.parametrize("values, total", [
    ([0.004, 0.004, 0.004], "0.01"), ([0.005, 0.005], "0.01"), ([1e-10] * 3, "0.00"), ([0.005], "0.01"), ([-0.005], "-0.01"), ([None], None), ([10.0, None, 0.25], "10.25"),
    (["x", "2.125"], "2.13"), ([1e30, 1.0], "1.00"),
])
def test_a_sum_is_rounded_once(spark, values, total):
    kind = "string" if isinstance(values[0], str) else "double"
    rows = spark.createDataFrame([(1, value) for value in values], f"g int, amount {kind}")
    assert v.grouped_values(rows, ["g"], "${amount$SUM}").first()["amount$SUM"] == total


def test_warnings_name_each_bad_value(spark):
    rows = spark.createDataFrame(
        [("1", "12", "80", "x", "7"), ("2", "1.5", None, "1e3", "z"), ("3", str(2**62), "99999999999", "inf", ""), ("4", None, None, None, None)],
        "eventid string, eventtime string, destinationport string, transactionnumber1 string, tenantid string")
    got = {tuple(r) for r in parse_warnings(rows).collect()}
    assert got == {
        ("1", "transactionnumber1", "x"), ("2", "eventtime", "1.5"), ("2", "tenantid", "z"), ("3", "eventtime.day", str(2**62)),
        ("3", "destinationport", "99999999999"), ("3", "transactionnumber1", "inf"), ("3", "tenantid", ""),
    }
    counts = {r["field"]: r["failures"] for r in parse_failures(rows).collect()}
    assert counts == {field: sum(w[1] == field for w in got) for field in counts}
    assert parse_warnings(rows.select("eventid")).count() == 0


def folders(spark, tmp_path, count):
    root = tmp_path / "groups"
    for group in range(count):
        (root / f"activity{group}incoming").mkdir(parents=True)
    rows = spark.range(3).select(F.col("id").cast("string").alias("eventid"), F.lit("x").alias("message"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    file = next((tmp_path / "one").glob("part-*.parquet"))
    for group in range(count):
        (root / f"activity{group}incoming" / "part-0.parquet").write_bytes(file.read_bytes())
    return str(root)


def test_a_thousand_groups_are_one_scan(spark, tmp_path, capsys):
    root = folders(spark, tmp_path, 1000)
    rows, skipped = a.scan_group_folders(spark, root, [*range(1000), 5, 2000, -1], "eventid string, message string")
    assert sorted(r["rg_id"] for r in skipped.collect()) == [-1, 2000]
    rows.explain("formatted")
    assert capsys.readouterr().out.split("\n\n\n")[0].count("Scan parquet") == 1
    some = rows.where("rg_id = 7 or rg_id in (11, 12)")
    assert sorted(r["rg_id"] for r in some.collect()) == [7] * 3 + [11] * 3 + [12] * 3
    # Other groups' files are dropped before they are opened.
    leaves = some._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.size() == 1 and leaves.apply(0).metrics().apply("numFiles").value() == 3
    assert rows.count() == 3000


def test_groups_of_other_columns_and_names(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("1",)], "eventid string").write.parquet(f"{root}/g+1.d")
    spark.createDataFrame([("2", 5, "z")], "eventid string, extra int, unread string").write.parquet(f"{root}/g+2.d")
    rows, skipped = a.scan_group_folders(spark, root, [2, 1, 3], "eventid string, extra int", folder=lambda g: f"g+{g}.d")
    assert sorted(tuple(r) for r in rows.select("rg_id", "eventid", "extra").collect()) == [(1, "1", None), (2, "2", 5)]
    assert [r["rg_id"] for r in skipped.collect()] == [3]
    nothing, skipped = a.scan_group_folders(spark, root, [8, 9], "eventid string")
    assert nothing is None and skipped.count() == 2


def test_few_rows_are_numbered_in_one_task_and_many_across(spark, monkeypatch):
    rows = spark.range(50).select(F.col("id").cast("string").alias("name"))
    few = {(r["name"], r["n"]) for r in assign_ids(rows, "name", {"n": 7}).collect()}
    monkeypatch.setattr(paging, "FEW_ROWS", 10)
    assert few == {(r["name"], r["n"]) for r in assign_ids(rows, "name", {"n": 7}).collect()}
    assert {n for _, n in few} == set(range(8, 58))
