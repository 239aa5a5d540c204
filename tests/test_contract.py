"""Every registered query beside its SQL, on the small tables."""

import os

import pytest

from burstline.operators import joins, paging
from __spark_entry__ import SMALL_TABLES, entry, oracle_sql, queries
from check import compare
from workload import oracle
from workload import queries as registered

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_TABLES), reason="no test tables here")


OWN = registered.queries()


def test_each_query_has_sql():
    assert set(OWN) == set(oracle.oracle_sql()) and set(OWN) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, name):
    assert compare(spark, SMALL_TABLES, name, oracle_sql()[name]).startswith("ok")


@pytest.mark.parametrize("name", [
    "drilldown", "custom_analyzer", "page_number", "page_number_all", "policy_by_name", "merge_policies",
    "violations", "violation_tree", "scan_activity_multi", "page_deep", "merged_categories", "rejected_events",
])
def test_query_as_if_everything_were_large(spark, monkeypatch, name):
    """No broadcast of lookups, salts from 20 rows on, and groups of more than 3 rows numbered across tasks."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    monkeypatch.setattr(joins, "SALT_ROWS", 20)
    monkeypatch.setattr(paging, "HOT_ROWS", 3)
    try:
        assert compare(spark, SMALL_TABLES, name, oracle_sql()[name]).startswith("ok")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flagship(spark):
    rows = entry(spark).collect()
    assert rows and {"violation_id", "policy_name", "risk_score", "sentence"} <= set(rows[0].asDict())
