"""Row numbers and pages against a plain sort in Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from burstline.operators.paging import numbered, page, page_counts, page_number
from burstline.operators import paging


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    data = [(random.choice(["hot", "hot", "hot", "a", "b", None]), random.randrange(40), f"e{i:04d}") for i in range(600)]
    return spark.createDataFrame(data, "k string, eventtime long, eventid string").repartition(5), data


def expected(data):
    groups = defaultdict(list)
    for k, time, event in data:
        groups[k].append((time, event))
    return {event: i + 1 for members in groups.values() for i, (_, event) in enumerate(sorted(members))}


@pytest.mark.parametrize("hot_rows", [10_000, 150, 10])
def test_numbers_within_groups(rows, hot_rows):
    df, data = rows
    got = numbered(df, ["k"], ["eventtime", "eventid"], "no", hot_rows=hot_rows)
    assert got.columns == [*df.columns, "no"]
    assert {r["eventid"]: r["no"] for r in got.collect()} == expected(data)


def test_numbers_with_known_sizes(rows):
    df, data = rows
    sizes = df.groupBy("k").agg(F.count("*").alias("n"))
    got = numbered(df, ["k"], ["eventtime", "eventid"], "no", sizes=sizes, hot_rows=50)
    assert {r["eventid"]: r["no"] for r in got.collect()} == expected(data)


def test_numbers_over_all_rows(rows):
    df, data = rows
    got = {r["eventid"]: r["no"] for r in numbered(df, [], ["eventtime", "eventid"], "no").collect()}
    assert got == {event: i + 1 for i, (_, _, event) in enumerate(sorted(data, key=lambda d: d[1:]))}


@pytest.mark.parametrize("count, pages", [(5, [0, 0, 1, 1, 2]), (4, [0, 0, 1, 1]), (1, [0])])
@pytest.mark.parametrize("hot_rows", [100, 0])
def test_pages(spark, count, pages, hot_rows):
    df = spark.createDataFrame([("g", i, str(i)) for i in range(count)], "k string, eventtime long, eventid string")
    paged = page_number(df, ["k"], 2, hot_rows=hot_rows)
    assert [r["page"] for r in paged.orderBy("eventtime").collect()] == pages
    sizes = df.groupBy("k").agg(F.count("*").alias("n"))
    counts = {r["page"]: r["events"] for r in page_counts(sizes, ["k"], 2, rows="n").collect()}
    assert counts == {p: pages.count(p) for p in set(pages)}


@pytest.mark.parametrize("top_rows", [10_000, 0], ids=["top-k", "ranges"])
def test_one_page(rows, monkeypatch, top_rows):
    monkeypatch.setattr(paging, "TOP_ROWS", top_rows)
    df, data = rows
    order = [event for _, _, event in sorted(data, key=lambda d: d[1:])]
    for offset, size in ((20, 10), (0, 7), (190, 200), (595, 10), (600, 10), (10_000, 5)):
        assert [r["eventid"] for r in page(df, offset, size).collect()] == order[offset : offset + size]


@pytest.mark.parametrize("top_rows", [10_000, 0])
def test_pages_of_equal_and_null_times(spark, monkeypatch, top_rows):
    """Pages are full and in order also where the order does not tell rows apart, or is null."""
    monkeypatch.setattr(paging, "TOP_ROWS", top_rows)
    df = spark.createDataFrame([(None if i % 4 == 0 else i // 10, i) for i in range(200)], "eventtime long, no long").repartition(4)
    times = [None] * 50 + sorted(i // 10 for i in range(200) if i % 4)
    for offset in (0, 45, 60, 150, 195):
        assert [r["eventtime"] for r in page(df, offset, 10, ("eventtime",)).collect()] == times[offset : offset + 10]


def test_deep_page_reads_only_between_its_ends(spark, monkeypatch, tmp_path, capsys):
    monkeypatch.setattr(paging, "TOP_ROWS", 0)
    spark.range(1000).selectExpr("id AS eventtime", "cast(id AS string) AS eventid", "repeat('x', 10) AS wide").write.parquet(f"{tmp_path}/t")
    found = page(spark.read.parquet(f"{tmp_path}/t"), 500, 10)
    found.explain("formatted")
    assert "GreaterThanOrEqual(eventtime,500), LessThanOrEqual(eventtime,509)" in capsys.readouterr().out
    assert [r["eventtime"] for r in found.collect()] == list(range(500, 510))


def test_numbering_runs_its_input_once(rows):
    df, data = rows
    seen = df.sparkSession.sparkContext.accumulator(0)
    counted = df.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(df.schema)
    assert numbered(counted, ["k"], ["eventtime", "eventid"], "no", hot_rows=150).count() == len(data)
    assert seen.value == len(data)

def test_page_counts_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(paging, "PAGES_AT_ONCE", 3)
    sizes = spark.createDataFrame([("big", 41), ("small", 4), ("none", 0), (None, 9)], "k string, n long")
    got = sorted(tuple(r) for r in page_counts(sizes, ["k"], 4, rows="n").collect())
    assert got == [("big", p, 4) for p in range(10)] + [("big", 10, 1), ("small", 0, 4)]
