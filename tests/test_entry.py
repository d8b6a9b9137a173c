from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from tillroll.plans.oracle import ORACLE_SQL
from tillroll.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == [
        "visit_number", "weekday", "mon_to_fri", "n_returns", "has_returns", "feature", "value",
    ]
    assert not entry.entry(spark).isEmpty()


def test_only_clusters_lack_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == {"visit_clusters"}
    assert set(ORACLE_SQL) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, os.environ.get("CHECK_SF_DIR", FOLDER), name) is None


@pytest.mark.parametrize(
    "name, tables, exchanges", [("visit_summary", 3, 4), ("department_pivot", 2, 3), ("split_train", 4, None)]
)
def test_scans_and_exchanges(spark, name, tables, exchanges):
    """Each table is read once, and a part is cut out before its features are made."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("FileScan") <= tables + (name == "split_train") * 2
    assert exchanges is None or plan.count("Exchange hashpartitioning") <= exchanges


def test_every_visit_has_one_cluster(spark):
    found = entry.queries()["visit_clusters"](spark, FOLDER).collect()
    visits = entry.queries()["visit_labels"](spark, FOLDER).count()
    assert len({r.visit_number for r in found}) == len(found) == visits
    assert {r.cluster for r in found} == set(range(8))
