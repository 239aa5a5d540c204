"""Pages that were published and those that were not, runs that break off, and counts taken along."""

import json

import pytest
from pyspark.sql import functions as F

from burstline.operators.detect import Rule
from burstline.plans.violation_plan import find_violations, publish_violations
from burstline.sinks import publish
from burstline.sinks.publish import PageLog, page_messages, pages_of
from burstline.sinks.versions import State, Taken
from tests.test_violations import events, groups, policies, scores  # noqa: F401

KEYS = ["rg_id", "account"]
SCHEMA = "rg_id long, account string, id string, page long, note string"


def paged(spark, pages=6, size=3, note="n"):
    """Two groups, one of null account, with pages of three rows."""
    return spark.createDataFrame(
        [(g, None if g else "ann", f"{g}.{p}.{k}", p, note) for g in (0, 1) for p in range(pages) for k in range(size)], SCHEMA)


def sent_ids(log):
    return sorted(json.loads(r["value"])["id"] for r in log.messages().collect())


def test_a_page_is_sent_once(spark, tmp_path):
    log = PageLog(spark, str(tmp_path))
    rows = paged(spark)
    first = log.publish(rows.where("rg_id = 0"), KEYS, key="id")
    assert (first.pages, first.events, first.known) == (6, 18, 0)
    second = log.publish(rows, KEYS, key="id")
    assert (second.pages, second.events, second.known) == (6, 18, 6)
    third = log.publish(rows.repartition(5).orderBy(F.rand(1)), KEYS, key="id")
    assert (third.pages, third.events, third.known) == (0, 0, 12)
    assert sent_ids(log) == sorted(r["id"] for r in rows.collect())
    assert log.published().count() == 12 and log.published().agg(F.sum("events")).first()[0] == 36


def test_messages_hold_the_row_without_its_page(spark):
    got = page_messages(paged(spark, 1, 1), KEYS, "id").orderBy("rg_id").collect()
    assert [json.loads(r["value"]) for r in got] == [{"rg_id": 0, "account": "ann", "id": "0.0.0", "note": "n"}, {"rg_id": 1, "id": "1.0.0", "note": "n"}]
    assert len({r["page_id"] for r in got}) == 2


def test_a_run_that_breaks_off_is_taken_up(spark, tmp_path):
    log, rows, calls = PageLog(spark, str(tmp_path)), paged(spark), []

    def failing(part):
        calls.append(part.count())
        if len(calls) == 3:
            log.to_files(part)  # written, but in no state
            raise OSError("lost")
        return log.to_files(part)

    with pytest.raises(OSError):
        log.publish(rows, KEYS, key="id", send=failing, parts=8)
    before = log.published().count()
    assert 0 < before < 12 and len(sent_ids(log)) == 3 * before
    rest = PageLog(spark, str(tmp_path)).publish(rows, KEYS, key="id", parts=8)
    assert (rest.pages, rest.known) == (12 - before, before)
    assert sent_ids(log) == sorted(r["id"] for r in rows.collect())


def test_a_page_with_other_events_is_sent_again(spark, tmp_path):
    log, rows = PageLog(spark, str(tmp_path)), paged(spark, 2)
    log.publish(rows, KEYS, key="id")
    more = rows.unionByName(spark.createDataFrame([(0, "ann", "0.1.9", 1, "late")], SCHEMA))
    again = log.publish(more, KEYS, key="id")
    assert (again.pages, again.events, again.known) == (1, 4, 3)
    assert log.published().groupBy("page_id").count().where("count = 2").count() == 1


def test_of_two_runs_at_once_one_stops(spark, tmp_path):
    log, rows = PageLog(spark, str(tmp_path)), paged(spark)

    def slow(part):
        place = log.to_files(part)
        if log.versions.current() == State():
            PageLog(spark, str(tmp_path)).publish(rows.where("rg_id = 0"), KEYS, key="id", parts=1)
        return place

    with pytest.raises(Taken):
        log.publish(rows, KEYS, key="id", send=slow, parts=2)
    assert len(sent_ids(log)) == 18
    log.publish(rows, KEYS, key="id")
    assert sent_ids(log) == sorted(r["id"] for r in rows.collect())


def test_no_rows_and_a_first_look(spark, tmp_path):
    log = PageLog(spark, str(tmp_path))
    assert log.published().count() == 0 and log.messages().count() == 0
    done = log.publish(paged(spark).limit(0), KEYS, key="id")
    assert (done.pages, done.events, done.known) == (0, 0, 0) and log.versions.current() == State()


def test_a_long_log_becomes_one_file_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "LOG_FOLDERS", 3)
    log = PageLog(spark, str(tmp_path))
    for page in range(5):
        log.publish(paged(spark).where(F.col("page") == page), KEYS, key="id", parts=1)
    assert len(log.versions.current().content["log"]) <= 3 and log.published().count() == 10


def test_digests_do_not_depend_on_order(spark):
    rows = paged(spark)
    digests = lambda df: {(r["page_id"], r["events"], r["digest"]) for r in pages_of(page_messages(df, KEYS, "id"), KEYS).collect()}
    assert digests(rows) == digests(rows.repartition(7).orderBy(F.desc("id")))
    assert len(digests(rows)) == 12 and not digests(rows) & digests(paged(spark, note="m"))


def test_counts_come_from_the_publishing_passes(spark, events, policies, groups, scores, tmp_path):  # noqa: F811
    rule = Rule(keys=("accountname", "year", "dayofyear", "hour", "minute"))
    log = PageLog(spark, str(tmp_path))
    want = find_violations(events, policies, groups, scores, rule)
    done = publish_violations(events, policies, groups, scores, rule, log, page_size=4)
    formed = want.violations.count()
    assert (done.rejected, done.formed, done.sent.events) == (want.rejected.count(), formed, formed) and done.rejected == 1
    assert done.read == 13
    ids = {json.loads(r["value"])["violation_id"] for r in log.messages().collect()}
    assert ids == {r["violation_id"] for r in want.violations.select("violation_id").collect()}
    assert publish_violations(events, policies, groups, scores, rule, log, page_size=4).sent.events == 0
