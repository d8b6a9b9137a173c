"""One visit, product or department holding a third of all rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from fixture import SCHEMA, rows
from pyspark.sql import functions as F

from tillroll.operators import crosstab, features, itemsets, split, vocabulary

N = 6000
DAYS = ["Monday", "Saturday"]


@pytest.fixture(scope="module")
def log():
    rng = random.Random(11)
    found = []
    for i in range(N):
        visit = 7 if i % 3 == 0 else rng.randrange(500)
        upc = 42 if i % 3 == 1 else rng.randrange(300)
        department = "HOT" if i % 3 == 2 else rng.choice(["A", "B", "C", None])
        found.append((visit, visit % 4, DAYS[visit % 2], upc, rng.randint(-3, 5), department, rng.randrange(20)))
    return found


@pytest.fixture(scope="module", params=[1, 16])
def scans(spark, log, request):
    return spark.createDataFrame(log, SCHEMA).repartition(request.param).cache()


@pytest.fixture(params=["broadcast", "split"])
def joins(spark, request):
    """With broadcasts, and without any, where the smallest excess is split."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    if request.param == "split":
        for key, value in changed.items():
            spark.conf.set(key, value)
    yield request.param
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_features_are_whole(spark, scans, log, joins):
    categories = spark.createDataFrame(
        [("HOT", "x"), ("A", "x"), ("A", "y")], "department string, category string"
    )
    top = [u for u, _ in sorted(Counter(r[3] for r in log).items(), key=lambda c: (-c[1], c[0]))[:50]]
    upcs = vocabulary.top_terms(scans, "upc", 50)
    assert {r[0] for r in rows(upcs)} == set(top)

    expected = Counter()
    members = {"HOT": "x", "A": "xy"}
    for visit, _, day, upc, count, department, fineline in log:
        sign = "-" if count < 0 else ""
        names = [f"FLN_{fineline}"]
        names += [f"UPC_{upc}"] if upc in set(top) else []
        names += [sign + department] if department else []
        names += [sign + c for c in members.get(department, "")]
        for name in names:
            expected[visit, name] += count
        expected[visit, "Returns"] += count < 0
        expected[visit, "Weekday"] = 0 if day == "Monday" else 5
        expected[visit, "Mon_To_Fri"] = int(day == "Monday")
    found = features.visit_features(scans, categories, upcs)
    assert {(v, f): n for v, f, n in rows(found, "visit_number", "feature", "value")} == dict(expected)
    assert found.count() == len(expected)


def test_membership_and_baskets_are_whole(scans, log, joins):
    some = scans.where("visit_number < 100")
    assert split.of_visits(scans, some).count() == sum(r[0] < 100 for r in log)
    baskets = {r.visit_number: r.departments for r in itemsets.transactions(scans, []).collect()}
    expected = {}
    for r in log:
        expected.setdefault(r[0], set()).update([r[5]] if r[5] else [])
    assert baskets == {v: sorted(names) for v, names in expected.items()}


def test_winners_are_whole(scans, log, joins):
    counts = Counter((r[1], r[5]) for r in log if r[5])
    expected = {}
    for (trip, name), n in sorted(counts.items(), key=lambda c: (-c[1], c[0][1])):
        expected.setdefault(trip, (trip, name, n))
    found = crosstab.top_per_column(scans, "department", "trip_type")
    assert rows(found, "trip_type", "department", "n") == sorted(expected.values())


def test_a_hot_join_key_is_split(spark, joins):
    """The adaptive settings reach the joins: a hot product is read by several tasks, or its
    side is broadcast."""
    lines = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    names = spark.range(60000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    joined = lines.join(names, "k", "left").groupBy("k").agg(F.sum("v").alias("total"))
    assert joined.agg(F.sum("total")).first()[0] == sum(range(60000))
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("skew=true" if joins == "split" else "BroadcastHashJoin") in plan
