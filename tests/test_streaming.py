"""Bursts on a stream against the same counts in a batch: late events, restarts, broken batches, disorder."""

import datetime as dt

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from burstline.operators.detect import Rule, detect
from burstline.streaming import bursts as b

RULE = Rule(more_than=2)
START = dt.datetime(2024, 5, 1, 12, 0)
SCHEMA = ("rg_id long, eventid string, accountname string, ipaddress string, message string, eventtime long, "
          "year int, dayofyear int, hour int, minute int, arrived timestamp")


def event(no, minute, arrives, account="a", message="Logon Failed", rg=1):
    """An event of minute ``minute`` that arrives in minute ``arrives``, both counted from the start."""
    at = START + dt.timedelta(minutes=minute)
    ms = int(at.replace(tzinfo=dt.UTC).timestamp() * 1000)
    return (rg, str(no), account, "1.1.1.1", message, ms, at.year, at.timetuple().tm_yday, at.hour, at.minute, START + dt.timedelta(minutes=arrives))


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def as_set(df, *columns):
    return {tuple(r[c] for c in [*RULE.group_keys, "n", "events", *columns]) for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return b.BurstTable(spark, str(tmp_path / "bursts"), RULE)


def test_counts_equal_those_of_a_batch(spark, tmp_path, table):
    folder = str(tmp_path / "in")
    rows = [event(k, k % 4, k % 4, account=["a", "b", None][k % 3]) for k in range(60)] + [event(90, 1, 1, message="Logon")]
    rows += [(1, "n", "a", None, "Logon Failed", None, None, None, None, None, START) for _ in range(4)]
    put(spark, folder, rows)
    table.drain(stream(spark, folder))
    batch = detect(spark.read.schema(SCHEMA).parquet(folder), RULE)
    assert batch.count() > 5 and as_set(table.bursts()) == as_set(batch)
    assert all(r["late"] == 0 for r in table.bursts().collect())


def test_late_events_are_counted_and_told(spark, tmp_path, table):
    """The last event of a group comes hours after the watermark has passed its minute; without it there is no burst."""
    folder = str(tmp_path / "in")
    files = [
        [event(1, 0, 0), event(2, 0, 1)],
        [event(k, 200, 200, account="b") for k in range(10, 13)],
        [event(3, 0, 300)],
        [event(4, 300, 309, account="c"), event(5, 300, 310, account="c"), event(6, 300, 311, account="c")],
    ]
    for rows in files:
        put(spark, folder, rows)
        table.drain(stream(spark, folder))
    assert as_set(table.bursts()) == as_set(detect(spark.read.schema(SCHEMA).parquet(folder), RULE))
    assert {(r["accountname"], r["n"], r["late"]) for r in table.bursts().collect()} == {("a", 3, 1), ("b", 3, 0), ("c", 3, 1)}


def test_a_stream_goes_on_where_it_ended(spark, tmp_path, table):
    folder = str(tmp_path / "in")
    put(spark, folder, [event(1, 0, 0), event(2, 0, 0)])
    table.drain(stream(spark, folder))
    assert table.bursts().count() == 0
    put(spark, folder, [event(3, 0, 0)])
    again = b.BurstTable(spark, table.path, RULE)
    again.drain(stream(spark, folder))
    assert [(r["n"], r["events"]) for r in again.bursts().collect()] == [(3, 3)]
    before = again.counts().count()
    again.drain(stream(spark, folder))
    assert again.counts().count() == before and [r["n"] for r in again.bursts().collect()] == [3]


def test_a_batch_that_broke_off_is_done_again(spark, tmp_path, table):
    """The sink fails after it wrote, so the batch runs twice; its folder is written over, and nothing counts twice."""
    folder = str(tmp_path / "in")
    put(spark, folder, [event(k, 0, 0) for k in range(3)])
    counts = b.detect_stream(stream(spark, folder), RULE)

    def broken(batch, number):
        batch.write.mode("overwrite").parquet(f"{table.path}/counts/batch={number}")
        raise OSError("lost")

    query = counts.writeStream.outputMode("update").option("checkpointLocation", f"{table.path}/checkpoint").foreachBatch(broken).trigger(availableNow=True).start()
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    table.drain(stream(spark, folder))
    put(spark, folder, [event(7, 0, 0)])
    table.drain(stream(spark, folder))
    assert [(r["n"], r["events"]) for r in table.bursts().collect()] == [(4, 4)]


def test_repeated_counts_do_no_harm(spark):
    rows = [(1, "a", "x", 2024, 1, 1, 1, START, n, n, 0) for n in (2, 2, 5, 3)] + [(1, "a", "x", 2024, 1, 1, 1, START + dt.timedelta(hours=1), 1, 1, 1)]
    counts = spark.createDataFrame(rows, "rg_id long, accountname string, ipaddress string, year int, dayofyear int, hour int, minute int, "
                                         "arrival timestamp, n long, events long, late long")
    assert [(r["n"], r["events"], r["late"]) for r in b.bursts(counts, RULE).collect()] == [(6, 6, 1)]


def test_disorder_beyond_the_watermark_is_an_error(spark, tmp_path, table):
    folder = str(tmp_path / "in")
    for arrives in (0, 500, 1000):
        put(spark, folder, [event(arrives, arrives, arrives)])
        table.drain(stream(spark, folder))
    put(spark, folder, [event(9, 0, 0)])
    with pytest.raises(ValueError, match="out of order"):
        table.drain(stream(spark, folder))


def test_an_event_without_arrival_is_an_error(spark, tmp_path, table):
    folder = str(tmp_path / "in")
    put(spark, folder, [(*event(1, 0, 0)[:-1], None)])
    with pytest.raises(StreamingQueryException, match="an event without arrived"):
        table.drain(stream(spark, folder))


def test_state_holds_open_windows_only(spark, tmp_path, table):
    folder = str(tmp_path / "in")
    for turn in range(4):
        put(spark, folder, [event(100 * turn + k, 100 * turn, 100 * turn, account=f"a{k}") for k in range(20)])
        query = table.start(stream(spark, folder))
        query.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert kept[-1] <= 20


def test_lateness_at_its_edge(spark):
    ms = int(START.replace(tzinfo=dt.UTC).timestamp() * 1000)
    rows = [(ms, START + dt.timedelta(minutes=10)), (ms, START + dt.timedelta(minutes=10, microseconds=1)), (None, START), (2**63 - 1, START), (-(2**63), START)]
    df = spark.createDataFrame(rows, "eventtime long, arrived timestamp").select(b.is_late("eventtime", "arrived", "10 minutes").alias("late"))
    assert [r["late"] for r in df.collect()] == [False, True, False, False, False]


def test_part_sums_come_before_the_shuffle(spark, tmp_path, capsys):
    folder = str(tmp_path / "in")
    put(spark, folder, [event(1, 0, 0)])
    batch = spark.read.schema(SCHEMA).parquet(folder)
    b.detect_stream(batch, RULE).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Exchange (") == 1 and "partial_count" in plan and "EqualTo(message,Logon Failed)" in plan and "eventid" not in plan
    assert batch.agg(F.count("*")).first()[0] == 1
