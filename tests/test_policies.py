"""Policy tables."""

import pytest
from pyspark.sql import functions as F

from burstline.fixed_values import CATEGORIES, FUNCTIONALITIES, THREATS
from burstline.operators import policies as p

REQUEST = ("request_no long, policyname string, functionality string, categoryid string, riskthreatname string, "
           "criticality string, violationentity string, verboseinformation string, grouping_attribute string, "
           "level1_metadataattribute1 string, level1_metadataattribute2 string, level1_metadataattribute3 string, "
           "level2_primaryattribute string, level2_metadataattribute1 string, level2_metadataattribute2 string, "
           "level2_metadataattribute3 string")
POLICY = "id long, name string, resourcegroupid long, functionality string, categoryid int, criticality string"


def request(no, name="new", functionality="Audit", category="1", threat="Lateral Movement", criticality=None,
            entity=None, sentence=None, group=None, level1=(None, None, None), primary=None, level2=(None, None, None)):
    return (no, name, functionality, category, threat, criticality, entity, sentence, group, *level1, primary, *level2)


@pytest.fixture(scope="module")
def policies(spark):
    return spark.createDataFrame([
        (1, "one", -1, "Audit", 3, "Low"), (2, "two", 7, "Audit", 99, "High"), (9, "nine", -1, "Firewall", 11, "Severe"),
    ], POLICY)


@pytest.fixture(scope="module")
def categories(spark):
    return spark.createDataFrame(list(CATEGORIES.items()), "id int, name string")


def test_fixed_values():
    assert (len(FUNCTIONALITIES), len(CATEGORIES), len(THREATS)) == (22, 11, 127)
    assert all(v == v.strip() and "#" not in v for v in THREATS)


def test_by_id(spark, policies):
    assert p.policy_by_id(policies, 2).first()["name"] == "two"
    assert p.policy_by_id(policies, 5).count() == 0
    with pytest.raises(ValueError):
        p.policy_by_id(policies, 0)
    wanted = spark.createDataFrame([(9,), (-1,), (4,)], "id long")
    assert [r["name"] for r in p.policy_by_id(policies, wanted).collect()] == ["nine"]


def test_by_name(spark, policies):
    wanted = spark.createDataFrame([("one",), ("One",), ("none",)], "policyname string")
    assert {tuple(r) for r in p.policy_by_name(wanted, policies).collect()} == {("one", 1), ("One", None), ("none", None)}


def test_groups(spark, policies):
    groups = spark.createDataFrame([(5, "Audit"), (6, "Audit"), (7, "Firewall")], "id long, functionality string")
    assert {r["id"] for r in p.groups_of_functionality(groups, "Audit").collect()} == {5, 6}
    got = {(r["id"], r["rg_id"]) for r in p.policy_groups(policies, groups).collect()}
    assert got == {(1, 5), (1, 6), (2, 7), (9, 7)}


def test_category_and_score(spark, policies, categories):
    named = {r["id"]: r["category"] for r in p.with_category_name(policies, categories).collect()}
    assert named == {1: "TRAFFIC ANOMALY", 2: "", 9: "ALERT"}
    scores = spark.createDataFrame([("Low", 1.0), ("High", 3.0)], "criticality string, score double")
    scored = {r["id"]: r["risk_score"] for r in p.with_score(policies, scores).collect()}
    assert scored == {1: 1.0, 2: 3.0, 9: None}


def test_defaults(spark):
    rows = [request(1), request(2, criticality=" ", entity=" "), request(3, criticality="High", entity="Users", sentence="  s "),
            request(4, criticality="\t", group=" message ")]
    got = {r["request_no"]: r for r in p.policy_defaults(spark.createDataFrame(rows, REQUEST)).collect()}
    assert [got[i]["criticality"] for i in (1, 2, 3, 4)] == ["Low", "Low", "High", "Low"]
    assert [got[i]["violationentity"] for i in (1, 2, 3)] == ["Activityaccount", " ", "Users"]
    assert got[3]["verboseinformation"] == "s" and got[4]["grouping_attribute"] == "message"


def test_display(spark):
    rows = [
        request(1, group=" message ", level1=("a", " ", " c "), primary="ip", level2=(None, "b", None)),
        request(2, level1=("a", "b", "c"), level2=("a", None, None)),
        request(3, group="message", level1=("", None, " "), primary=" "),
    ]
    got = {r["request_no"]: (r["grouping_attribute"], r["level1_meta"], r["level2_attribute"], r["level2_meta"])
           for r in p.display_config(spark.createDataFrame(rows, REQUEST)).collect()}
    assert got == {1: ("message", ["a", "c"], "ip", ["b"]), 2: (None, None, None, None), 3: ("message", None, None, None)}


def test_validation(spark, policies):
    cases = {
        1: (request(1), True), 2: (request(2, name=" "), False), 3: (request(3, name=None), False),
        4: (request(4, category="x"), False), 5: (request(5, category=None), False), 6: (request(6, category=" 5"), False),
        7: (request(7, threat=" "), False), 8: (request(8, functionality=None), False),
        9: (request(9, criticality="Severe"), False), 10: (request(10, criticality=" "), True),
        11: (request(11, entity="Device"), False), 12: (request(12, name="one", threat=None, functionality=None), True),
        15: (request(15, name="one", criticality="Severe", entity="Device"), True),
        16: (request(16, name="one", category="x"), False),
        13: (request(13, functionality="Home", threat="New threat"), True), 14: (request(14, category="99"), True),
    }
    got = {r["request_no"]: r for r in p.validate(spark.createDataFrame([c[0] for c in cases.values()], REQUEST), policies).collect()}
    assert {i: r["accepted"] for i, r in got.items()} == {i: ok for i, (_, ok) in cases.items()}
    assert got[12]["exists"] and not got[1]["exists"]
    assert (got[13]["functionality_listed"], got[13]["threat_listed"], got[1]["threat_listed"]) == (False, False, True)


def test_signature_ids(spark, policies):
    first = {r["name"]: r["signatureid"] for r in p.assign_signature_ids(policies, " ").collect()}
    assert first == {"nine": "1000001", "one": "1000002", "two": "1000003"}
    assert {r["signatureid"] for r in p.assign_signature_ids(policies, "41").collect()} == {"42", "43", "44"}


def test_threat_ids(spark):
    names = spark.createDataFrame([("b",), ("a",), ("known",), ("a",), (None,)], "threatname string")
    known = spark.createDataFrame([("known", 7), ("other", 10)], "name string, id long")
    got = {r["threatname"]: (r["riskthreatid"], r["is_new"], r["level"]) for r in p.threat_ids(names, known).collect()}
    assert got == {"known": (7, False, None), "a": (11, True, "Medium"), "b": (12, True, "Medium")}


def test_replace_categories(spark, categories):
    old = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "policyid long, categoryid int, category string")
    new = spark.createDataFrame([(1, 5), (3, 99)], "policyid long, categoryid int")
    got = {tuple(r) for r in p.replace_categories(old, new, categories).select("policyid", "categoryid", "category").collect()}
    assert got == {(2, 1, "z"), (1, 5, "FRAUD"), (3, 99, "")}


def test_merge(spark, policies, categories):
    rows = [request(3, name="new", criticality="High"), request(2, name="new", criticality=" ", sentence=" s "),
            request(4, name="one"), request(5, name="bad", category="x"), request(6, name="also", threat="Mine", group="g", level1=("a", None, "b"))]
    table = policies.withColumns({"category": F.lit(None).cast("string"), "riskthreatid": F.lit(None).cast("long"),
                                  "risktypeid": F.lit(None).cast("long"), "riskname": F.lit(None).cast("string"),
                                  "signatureid": F.lit(None).cast("string"), "type": F.lit(None).cast("string"),
                                  "weight": F.lit(None).cast("int"), "enabled": F.lit(None).cast("boolean"),
                                  "verboseinfotemplate": F.lit(None).cast("string"), "level1_meta": F.lit(None).cast("array<string>")})
    threats = spark.createDataFrame([("Lateral Movement", 4)], "name string, id long")
    merged = p.merge_policies(spark.createDataFrame(rows, REQUEST), table, categories, threats, "50", 20)
    got = {r["name"]: r for r in merged.collect()}
    assert set(got) == {"one", "two", "nine", "new", "also"}
    also, new = got["also"], got["new"]
    assert (also["id"], new["id"]) == (10, 11)
    assert (also["signatureid"], new["signatureid"], also["risktypeid"]) == ("51", "52", 21)
    assert (new["criticality"], new["verboseinfotemplate"], new["category"]) == ("Low", "s", "INSIDER THREAT")
    assert (new["riskname"], new["type"], new["weight"], new["enabled"], new["resourcegroupid"]) == ("new Risk", "HDFS", 1, True, -1)
    assert (new["riskthreatid"], also["riskthreatid"]) == (4, 5)
    assert also["level1_meta"] == ["a", "b"] and new["level1_meta"] is None
    assert not got["one"]["is_new"] and new["is_new"]


def test_merge_goes_on_from_the_ids_in_the_table(spark, policies, categories):
    table = policies.withColumns({"signatureid": F.when(F.col("id") == 9, "old").otherwise("1000001"), "risktypeid": F.lit(1).cast("long")})
    threats = spark.createDataFrame([("Lateral Movement", 4)], "name string, id long")
    rows = [request(1, name="new", sentence="s ${a}", group="g", level1=("a", None, None), primary="ip", level2=("b", None, None))]
    got = {r["name"]: r for r in p.merge_policies(spark.createDataFrame(rows, REQUEST), table, categories, threats).collect()}
    new = got["new"]
    assert (new["id"], new["signatureid"], new["risktypeid"]) == (10, "1000002", 2)
    # Settings that the table has no column for are not lost.
    assert (new["verboseinfotemplate"], new["grouping_attribute"], new["level1_meta"], new["level2_attribute"], new["level2_meta"]) == (
        "s ${a}", "g", ["a"], "ip", ["b"])
    assert got["one"]["level1_meta"] is None and got["two"]["risktypeid"] == 1


def test_category_rows_of_new_policies(spark, policies, categories):
    table = policies.withColumns({"riskthreatid": F.col("id") + 500, "risktypeid": F.col("id") + 900})
    threats = spark.createDataFrame([("Lateral Movement", 4)], "name string, id long")
    merged = p.merge_policies(spark.createDataFrame([request(1, name="new", category="5")], REQUEST), table, categories, threats)
    rows = [tuple(r) for r in p.category_rows(merged.where("is_new")).collect()]
    assert rows == [(10, 5, 4, 910, "FRAUD")]


def test_replaced_categories_take_the_policies_ids(spark, policies, categories):
    table = policies.withColumns({"riskthreatid": F.col("id") + 500, "risktypeid": F.col("id") + 900})
    old = p.category_rows(p.with_category_name(table, categories))
    new = spark.createDataFrame([(1, 5), (3, 5)], "policyid long, categoryid int")
    got = {tuple(r) for r in p.replace_categories(old, new, categories, table).collect()}
    assert got == {(2, 99, 502, 902, ""), (9, 11, 509, 909, "ALERT"), (1, 5, 501, 901, "FRAUD"), (3, 5, None, None, "FRAUD")}
    with pytest.raises(ValueError, match="riskthreatid"):
        p.replace_categories(old, new, categories)


def test_groups_with_nulls(spark):
    rows = [(1, None, "Audit"), (2, -1, None), (3, -1, "Audit"), (4, 8, None)]
    groups = spark.createDataFrame([(5, "Audit"), (6, None)], "id long, functionality string")
    got = {(r["id"], r["rg_id"]) for r in p.policy_groups(spark.createDataFrame(rows, "id long, resourcegroupid long, functionality string"), groups).collect()}
    assert got == {(3, 5), (4, 8)}
