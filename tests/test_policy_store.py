"""Policies kept as numbered states: lasting ids, replaced categories, two writers at once, and writes that break off."""

import threading

import pytest
from pyspark.sql import functions as F

from burstline.fixed_values import CATEGORIES, FIRST_SIGNATURE_ID
from burstline.operators import policies as p
from burstline.sinks.policy_store import FOLDERS, PolicyStore
from burstline.sinks.versions import State, Taken, Versions
from tests.test_policies import REQUEST, request

POLICY = ("id long, name string, resourcegroupid long, functionality string, categoryid int, criticality string, threatname string, "
          "riskthreatid long, risktypeid long, category string, signatureid string")


@pytest.fixture
def categories(spark):
    return spark.createDataFrame(list(CATEGORIES.items()), "id int, name string")


@pytest.fixture
def store(spark, tmp_path):
    made = PolicyStore(spark, str(tmp_path / "store"), buckets=4)
    policies = spark.createDataFrame([
        (k, f"old {k}", -1, "Audit", 1 + k % 3, "Low", "Lateral Movement", 40, 100 + k, "x", str(FIRST_SIGNATURE_ID + k)) for k in range(1, 9)
    ], POLICY)
    made.create(policies, spark.createDataFrame([(40, "Lateral Movement")], "id long, name string"))
    return made


def ask(spark, *names, threat="Lateral Movement"):
    return spark.createDataFrame([request(n, name, threat=threat) for n, name in enumerate(names)], REQUEST)


def test_states_are_numbered_and_taken_once(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.current() == State()
    first = versions.publish(State(), {"a": 1})
    with pytest.raises(Taken):
        versions.publish(State(), {"a": 2})
    assert versions.current() == first == State(1, {"a": 1})
    assert versions.change(lambda now: {"a": now.content["a"] + 1}).content == {"a": 2}
    assert Versions(spark, f"file://{tmp_path}").current() == State(2, {"a": 2})


def test_writers_of_another_file_system_take_a_number_once(spark, tmp_path):
    """The way of a store that is no folder of this machine."""
    one, two = Versions(spark, str(tmp_path)), Versions(spark, str(tmp_path))
    one._local = two._local = None
    one.publish(State(), {"by": "one"})
    with pytest.raises(Taken):
        two.publish(State(), {"by": "two"})
    assert two.change(lambda now: {"by": now.content["by"] + " two"}).content == {"by": "one two"}
    assert one.current().number == 2 and not [f for f in (tmp_path / "states").iterdir() if f.name.startswith(".draft")]


def test_many_writers_at_once_lose_nothing(spark, tmp_path):
    versions = [Versions(spark, str(tmp_path)) for _ in range(6)]
    add = lambda v: [v.change(lambda now: {"n": now.content.get("n", 0) + 1}, 200) for _ in range(10)]
    threads = [threading.Thread(target=add, args=(v,)) for v in versions]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert versions[0].current() == State(60, {"n": 60})


def test_ids_of_deleted_policies_do_not_come_back(spark, store, categories):
    first = store.merge(ask(spark, "new a", "new b"), categories).orderBy("name").collect()
    assert [(r["id"], r["signatureid"], r["risktypeid"]) for r in first] == [
        (9, str(FIRST_SIGNATURE_ID + 9), 109), (10, str(FIRST_SIGNATURE_ID + 10), 110)]
    store.delete(spark.createDataFrame([(9,), (10,), (None,), (77,)], "id long"))
    assert store.read("policies").count() == 8 and store.read("categories").where("policyid > 8").count() == 0
    again = store.merge(ask(spark, "new c"), categories).first()
    assert (again["id"], again["signatureid"], again["risktypeid"]) == (11, str(FIRST_SIGNATURE_ID + 11), 111)
    assert store.marks() == {"id": 11, "signatureid": FIRST_SIGNATURE_ID + 11, "risktypeid": 111, "riskthreatid": 40}


def test_a_merge_adds_policies_categories_and_new_threats(spark, store, categories):
    made = store.merge(ask(spark, "old 1", "new", "new", " ", threat="Odd threat"), categories)
    assert [r["name"] for r in made.collect()] == ["new"]
    policies = {r["name"]: r for r in store.read("policies").collect()}
    assert len(policies) == 9 and policies["new"]["riskthreatid"] == 41 and policies["old 1"]["riskname"] is None
    assert {(r["id"], r["name"]) for r in store.read("threats").collect()} == {(40, "Lateral Movement"), (41, "Odd threat")}
    own = store.read("categories").where("policyid = 9").collect()
    assert [(r["categoryid"], r["riskthreatid"], r["risktypeid"], r["category"]) for r in own] == [(1, 41, 109, CATEGORIES[1])]
    assert store.merge(ask(spark, "new", "old 3"), categories).count() == 0
    assert store.merge(ask(spark, "other", threat="Odd threat"), categories).first()["riskthreatid"] == 41


def test_two_merges_at_once_do_not_share_ids(spark, store, categories):
    stores = [PolicyStore(spark, store.versions.path, buckets=4) for _ in range(2)]
    gate, done = threading.Barrier(2), []

    def merge(one, names):
        gate.wait()
        done.append(one.merge(ask(spark, *names), categories).count())

    threads = [threading.Thread(target=merge, args=(one, names)) for one, names in zip(stores, (["m1", "m2", "both"], ["n1", "both"]))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rows = store.read("policies").collect()
    assert sorted(done)[-1] >= 1 and len(rows) == 12 and len({r["name"] for r in rows}) == 12
    for kind in ("id", "signatureid", "risktypeid"):
        assert len({r[kind] for r in rows}) == 12
    assert store.marks()["id"] == 12 == max(r["id"] for r in rows)


def test_lists_replace_categories_and_empty_ones_clear_them(spark, store, categories):
    lists = spark.createDataFrame([(1, [5, 5, None, 99]), (2, []), (3, None), (70, [2]), (4, [None])], "policyid long, categoryids array<int>")
    before = {r["policyid"]: r["categoryid"] for r in store.read("categories").collect()}
    store.replace_categories(lists, categories)
    got = sorted((r["policyid"], r["categoryid"], r["risktypeid"], r["category"]) for r in store.read("categories").collect() if r["policyid"] in (1, 2, 3, 4, 70) and r["risktypeid"])
    assert got == [(1, 5, 101, CATEGORIES[5]), (1, 99, 101, ""), (3, before[3], 103, CATEGORIES.get(before[3], ""))] or got[2][:3] == (3, before[3], 103)
    unknown = store.read("categories").where("policyid = 70").collect()
    assert [(r["categoryid"], r["risktypeid"]) for r in unknown] == [(2, None)]
    assert store.read("categories").where("policyid in (5, 6, 7, 8)").count() == 4
    store.replace_categories(lists, categories)
    assert store.read("categories").count() == 8


def test_only_touched_buckets_are_written(spark, store, categories):
    before = store.versions.current().content["tables"]
    store.replace_categories(spark.createDataFrame([(1, [])], "policyid long, categoryids array<int>"), categories)
    after = store.versions.current().content["tables"]
    assert before["policies"] == after["policies"]
    assert len([b for b in before["categories"] if before["categories"][b] != after["categories"].get(b)]) == 1


def test_a_write_that_breaks_off_leaves_the_state_as_it_was(spark, store, categories, monkeypatch):
    before = store.versions.current()

    def broken(after, content):
        raise OSError("lost")

    monkeypatch.setattr(store.versions, "publish", broken)
    with pytest.raises(OSError):
        store.merge(ask(spark, "new"), categories)
    monkeypatch.undo()
    assert store.versions.current() == before and store.read("policies").count() == 8
    assert store.merge(ask(spark, "new"), categories).first()["id"] == 9


def test_an_older_state_can_still_be_read(spark, store, categories):
    before = store.versions.current()
    store.merge(ask(spark, "new"), categories)
    store.delete(spark.createDataFrame([(1,)], "id long"))
    assert store.read("policies", before).count() == 8 == store.read("policies").count()
    assert store.versions.state(before.number) == before


def test_many_merges_keep_few_folders(spark, store, categories):
    one = PolicyStore(spark, store.versions.path, buckets=4)
    state = one.versions.current()
    tables = state.content["tables"]
    for _ in range(FOLDERS + 2):
        tables = one._added(tables, state, "threats", spark.createDataFrame([(41, "more")], "id long, name string"))
    assert max(len(folders) for folders in tables["threats"].values()) <= FOLDERS
    held = [f for folders in tables["threats"].values() for f in folders]
    assert one.versions.rows(held, "id long, name string").count() == 1 + FOLDERS + 2


def test_empty_tables_make_a_store(spark, tmp_path, categories):
    store = PolicyStore(spark, str(tmp_path / "empty"))
    store.create(spark.createDataFrame([], POLICY), spark.createDataFrame([], "id long, name string"), {"id": 500})
    assert store.read("policies").count() == 0 and store.marks()["id"] == 500
    assert store.merge(ask(spark, "first", threat="T"), categories).first()["id"] == 501
    assert store.read("threats").first()["id"] == 1


def test_marks_lift_ids_of_a_plain_merge(spark, categories):
    policies = spark.createDataFrame([(1, "old", -1, "Audit", 1, "Low", "T", 3, 4, "x", "1000002")], POLICY)
    threats = spark.createDataFrame([(3, "T")], "id long, name string")
    marks = {"id": 30, "signatureid": 2_000_000, "risktypeid": 2, "riskthreatid": 60}
    made = p.merge_policies(ask(spark, "new", threat="U"), policies, categories, threats, marks=marks).where("is_new").first()
    assert (made["id"], made["signatureid"], made["risktypeid"], made["riskthreatid"]) == (31, "2000001", 5, 61)


def test_display_settings_come_back_from_their_document(spark):
    rows = [
        (1, "a<b>&\"c\"'", ["x", "y & z"], "two", ["h"]), (2, None, None, None, None), (3, "g", None, None, ["q", None]),
        (4, " in  side ", ["one", "one"], "l\n2\tz", [" "]), (5, "\x01", ["a\x02b", ""], None, []), (6, "é漢 ]]> &amp;", ["<!-- -->", "<a/>"], None, None),
    ]
    df = spark.createDataFrame(rows, "id int, grouping_attribute string, level1_meta array<string>, level2_attribute string, level2_meta array<string>")
    stored = p.to_display_xml(df).drop(*p.DISPLAY_COLUMNS)
    got = {r["id"]: (r["grouping_attribute"], r["level1_meta"], r["level2_attribute"], r["level2_meta"]) for r in p.from_display_xml(stored).collect()}
    want = {i: tuple(rest) for i, *rest in rows} | {3: ("g", None, None, ["q"]), 5: (None, ["ab"], None, None)}
    assert got == want
    assert stored.where("id = 2").first()["violationdisplayconfig"] is None


def test_a_document_that_cannot_be_read_is_told(spark):
    texts = spark.createDataFrame([("<oops",), (None,), ("",), ("<violationDisplayConfig/>",), ("<violationDisplayConfig><other>1</other></violationDisplayConfig>",)],
                                  "violationdisplayconfig string")
    got = p.from_display_xml(texts).collect()
    assert [r["display_unreadable"] for r in got] == [True, False, True, False, False]
    assert all(r[c] is None for r in got for c in p.DISPLAY_COLUMNS)


def test_lists_of_categories(spark):
    lists = spark.createDataFrame([(1, [2, 2, None]), (2, []), (3, None)], "policyid long, categoryids array<int>")
    rows, replaced = p.listed_categories(lists)
    assert [tuple(r) for r in rows.collect()] == [(1, 2)]
    assert sorted(r["policyid"] for r in replaced.collect()) == [1, 2]
    assert rows.where(F.col("categoryid").isNull()).count() == 0
