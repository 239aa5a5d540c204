"""Both ways of joining a lookup give what a plain join gives."""

import random

import pytest

from burstline.operators import joins
from burstline.operators.joins import attach, fits_broadcast, measure


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(5)
    rows = [(i, "hot" if i % 3 == 0 else random.choice(["a", "b", "c", "d", None]), i % 2) for i in range(300)]
    rows += [(1000 + i, None, 0) for i in range(30)]
    lookup = [("hot", 0, "x"), ("hot", 0, "y"), ("hot", 1, "z"), ("a", 0, "p"), ("b", 1, "q"), (None, 0, "never"), ("zz", 0, "none")]
    return (spark.createDataFrame(rows, "id int, k string, p int"),
            spark.createDataFrame(lookup, "k string, p int, v string"))


@pytest.mark.parametrize("way", ["small", "unknown", "salted"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_as_plain_join(tables, how, way, monkeypatch):
    monkeypatch.setattr(joins, "SALT_ROWS", 7)
    rows, lookup = tables
    sizes = rows.dropna(subset=["k"]).groupBy("k", "p").count().withColumnRenamed("count", "n") if way == "salted" else None
    got = attach(rows, lookup, ["k", "p"], how, ["id"], sizes, way == "small" or None)
    want = rows.join(lookup, ["k", "p"], how)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.columns[:3] == rows.columns


def test_hot_key_is_spread(tables, monkeypatch):
    monkeypatch.setattr(joins, "SALT_ROWS", 10)
    rows, _ = tables
    seen = {}
    plain = type(rows).join

    def spy(self, other, on=None, how=None):
        if on == ["k", "_salt"]:
            seen.update({(r["k"], r["_salt"]): r["count"] for r in self.groupBy("k", "_salt").count().collect()})
        return plain(self, other, on, how)

    monkeypatch.setattr(type(rows), "join", spy)
    attach(rows, rows.select("k"), ["k"], "left_semi", ["id"], rows.groupBy("k").count().withColumnRenamed("count", "n"))
    hot = [n for (k, _), n in seen.items() if k == "hot"]
    assert sum(hot) == 100 and len(hot) >= 9 and max(hot) <= 30
    assert max(n for (k, _), n in seen.items() if k is None) <= 3


def test_keys_that_repeat_in_the_lookup_are_merged_before_the_join(spark, tables):
    rows, _ = tables
    lookup = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS k")
    got = attach(rows, lookup, ["k"], "left_semi", ["id"])
    assert got.count() == rows.where("k = 'hot'").count() == 100
    assert attach(rows, lookup, ["k"], "left_anti", ["id"]).count() == 230


def test_measure(spark, tables):
    rows, _ = tables
    size = measure(rows)
    assert size.rows == 330 and size.bytes >= 330 * (16 + 8 + 8)
    assert measure(rows.where("false")).bytes == 0
    nested = spark.createDataFrame([([1, 2, 3],)], "xs array<int>")
    assert measure(nested).bytes > 16
    assert not fits_broadcast(rows, 10)

