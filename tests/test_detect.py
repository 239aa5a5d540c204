"""Bursts and drill-down on rows the generated tables cannot offer."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from burstline.operators import joins
from burstline.operators.detect import Rule, detect, detect_keys, detect_sql, hits_per_group, matching
from burstline.operators.drilldown import drilldown, drilldown_one, marked_hits
from burstline.plans.violation_plan import find_events

SCHEMA = ("rg_id long, eventid string, accountname string, ipaddress string, message string, "
          "year int, dayofyear int, hour int, minute int")
RULE = Rule()


def rows(count, start=0, rg=1, account="a", ip="1.1.1.1", message="Logon Failed", hour=1, minute=1):
    return [(rg, str(start + i), account, ip, message, 2024, 1, hour, minute) for i in range(count)]


def events(spark, *parts):
    return spark.createDataFrame([row for part in parts for row in part], SCHEMA)


def ids(df):
    return sorted(row["eventid"] for row in df.collect())


def found(df, few=None):
    hits = marked_hits(detect(df, RULE))
    return hits, drilldown(df, hits, RULE, few=few)


@pytest.fixture(autouse=True)
def few_rows_to_a_salt(monkeypatch):
    monkeypatch.setattr(joins, "SALT_ROWS", 4)


@pytest.mark.parametrize("few", [None, False], ids=["broadcast", "salted"])
@pytest.mark.parametrize("name, parts, hits, published", [
    ("at threshold", [rows(5)], 0, 0),
    ("over threshold", [rows(6)], 1, 6),
    ("null account", [rows(7, account=None)], 0, 0),
    ("null address", [rows(7, ip=None)], 1, 0),
    ("quote in account", [rows(6, account="o'neil")], 1, 6),
    ("other message", [rows(6), rows(3, 10, message="Logon")], 1, 6),
    ("message case", [rows(6, message="logon failed")], 0, 0),
    ("minute edge", [rows(3, minute=59), rows(3, 10, hour=2, minute=0)], 0, 0),
    ("two groups", [rows(4), rows(4, 10, rg=2)], 0, 0),
    ("two hits", [rows(6), rows(7, 10, account="b"), rows(2, 20, account="c")], 2, 13),
], ids=lambda value: value if isinstance(value, str) else None)
def test_fixture_rows(spark, name, parts, hits, published, few):
    found_hits, found_events = found(events(spark, *parts), few)
    assert found_hits.count() == hits
    assert found_events.count() == published


def test_keys_and_counts(spark):
    df = events(spark, rows(6), rows(8, 10, rg=2, account="b"))
    assert {(r["rg_id"], r["accountname"], r["n"]) for r in detect(df, RULE).collect()} == {(1, "a", 6), (2, "b", 8)}
    assert detect_keys(df, RULE).columns == RULE.group_keys
    assert {(r["rg_id"], r["hits"]) for r in hits_per_group(detect(df, RULE)).collect()} == {(1, 1), (2, 1)}


def test_semi_join_equals_window_on_keys_that_are_set(spark):
    df = events(spark, rows(6), rows(7, 10, ip=None), rows(5, 20, account="b"), rows(9, 30, account="c"))
    over_keys = F.count("accountname").over(Window.partitionBy(*RULE.group_keys))
    by_window = matching(df, RULE).withColumn("n", over_keys).where("n > 5").dropna(subset=RULE.group_keys)
    assert ids(found(df)[1]) == ids(by_window)


def test_salted_join_on_a_key_with_most_rows(spark):
    df = events(spark, rows(400, account="hot"), *[rows(6, 1000 + 10 * i, account=f"u{i}") for i in range(60)],
                *[rows(3, 5000 + 10 * i, account=f"v{i}") for i in range(20)])
    expected = [str(i) for i in range(400)] + [str(1000 + 10 * i + j) for i in range(60) for j in range(6)]
    assert ids(found(df, few=False)[1]) == sorted(expected)
    assert ids(found(df)[1]) == sorted(expected)


def test_one_group(spark):
    df = events(spark, rows(6, account="o'neil"), rows(6, 10))
    key = dict(zip(RULE.group_keys, (1, "o'neil", "1.1.1.1", 2024, 1, 1, 1)))
    assert ids(drilldown_one(df, RULE, key)) == [str(i) for i in range(6)]
    assert drilldown_one(df, RULE, {**key, "ipaddress": None}).count() == 0
    with pytest.raises(ValueError):
        drilldown_one(df, RULE, {"rg_id": 1})


def test_sql_text(spark):
    df = events(spark, rows(6), rows(2, 10, account="b"))
    got = detect_sql(spark, "SELECT accountname, count(*) AS n FROM {e} WHERE message = :m GROUP BY 1 HAVING count(*) > :t",
                     {"m": "Logon Failed", "t": 5}, e=df).collect()
    assert [(r["accountname"], r["n"]) for r in got] == [("a", 6)]


def test_analyzer_of_a_user(spark):
    def from_many_addresses(df, rule):
        return (matching(df, rule).groupBy(*rule.group_keys)
                .agg(F.countDistinct("ipaddress").alias("addresses")).where(F.col("addresses") > rule.more_than))

    df = events(spark, *[rows(1, i, ip=f"1.1.1.{i}") for i in range(4)], rows(9, 10, account="b"))
    rule = Rule(keys=("accountname",), more_than=3)
    assert ids(find_events(df, rule, analyzer=from_many_addresses).events) == ["0", "1", "2", "3"]


def test_groups_and_rejected_rows(spark):
    df = events(spark, rows(6), rows(6, 10, rg=2), rows(6, 20, rg=3)).withColumn(
        "tenantid", F.when(F.col("eventid") == "3", "x").otherwise("7"))
    result = find_events(df, RULE, spark.createDataFrame([(1,), (2,)], "rg_id long"))
    assert ids(result.events) == sorted(str(i) for i in [*range(6), *range(10, 16)] if i != 3)
    assert ids(result.rejected) == ["3"]
    assert dict(result.events.dtypes)["tenantid"] == "bigint"


def test_result_does_not_depend_on_row_order(spark):
    df = events(spark, rows(6), rows(7, 10, account="b"), rows(5, 30, account="c"))
    assert ids(found(df)[1]) == ids(found(df.repartition(3, "eventid").orderBy(F.desc("eventid")))[1])


def test_plans_push_down_and_prune(spark, tmp_path, capsys):
    df = events(spark, rows(6), rows(6, 10, rg=2))
    df.write.partitionBy("rg_id", "year", "dayofyear").parquet(str(tmp_path / "activity"))
    stored = spark.read.parquet(str(tmp_path / "activity"))
    detect(stored, RULE).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(message,Logon Failed)" in plan
    assert "eventid" not in plan
    assert plan.count("Exchange (") == 1
    hits, out = found(stored)
    out.explain("extended")
    plan = capsys.readouterr().out
    assert "dynamicpruning" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert Counter(r["rg_id"] for r in out.collect()) == {1: 6, 2: 6}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("few", [None, False], ids=["broadcast", "salted"])
def test_against_brute_force(spark, seed, few):
    """One query per hit, as plain Python: count non-null accounts, then look each key up again."""
    chance = random.Random(seed)
    data = [
        (chance.choice([1, 2]), str(i), chance.choice(["a", "a", "a", "o'neil", None]), chance.choice(["1.1.1.1", "1.1.1.1", "", None]),
         chance.choice(["Logon Failed", "Logon Failed", "Logon"]), chance.choice([2024, None]), 1, chance.choice([1, 2]), 0)
        for i in range(300)
    ]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    records = [dict(zip(names, row)) for row in data]
    failed = [r for r in records if r["message"] == "Logon Failed"]
    counts = Counter()
    for r in failed:
        counts[tuple(r[k] for k in RULE.group_keys)] += r["accountname"] is not None
    want_hits = {key: n for key, n in counts.items() if n > 5}
    want = sorted(r["eventid"] for key in want_hits if None not in key
                  for r in failed if tuple(r[k] for k in RULE.group_keys) == key)
    hits, out = found(spark.createDataFrame(data, SCHEMA).repartition(4), few)
    assert {tuple(r[k] for k in RULE.group_keys): r["n"] for r in hits.collect()} == want_hits
    assert want and ids(out) == want
