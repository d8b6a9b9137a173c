from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from fixture import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tillroll.operators import conditional, features, itemsets
from tillroll.sources import sinks

BASKETS = "visit_number bigint, trip_type int, departments array<string>"


def brute_force(baskets, least):
    """Counts of all department sets of two or more, by listing every subset."""
    counts = {}
    for _, trip, departments in baskets:
        for size in range(2, len(departments) + 1):
            for items in combinations(sorted(departments), size):
                counts[trip, items] = counts.get((trip, items), 0) + 1
    return sorted([(t, items, n) for (t, items), n in counts.items() if n >= least], key=repr)


def random_baskets(n, seed):
    rng = random.Random(seed)
    names = ["A", "B", "C", "D", "E", "F", "G"]
    weights = [9, 8, 6, 4, 2, 1, 1]
    return [
        (v, rng.choice([1, 2, 2]), sorted(set(rng.choices(names, weights, k=rng.randint(0, 6)))))
        for v in range(n)
    ]


def test_transactions_keep_visits_without_departments(train):
    baskets = itemsets.transactions(train, [8])
    assert rows(baskets) == [
        (1, 3, ("DAIRY", "PRODUCE")), (2, 3, ("DAIRY", "PRODUCE")), (4, 5, ("TOYS",)), (6, 3, ()),
    ]
    assert rows(itemsets.with_label_item(baskets))[0] == (1, ("-3", "DAIRY", "PRODUCE"))


def test_returned_departments_are_mined(train):
    assert (3, 8, ("PHARMACY RX",)) in rows(itemsets.transactions(train, []))


def test_mine_fixture(train):
    mined = itemsets.mine(itemsets.transactions(train, [8]), 0.5)
    assert rows(mined) == [(3, ("DAIRY", "PRODUCE"), 2)]


def test_mine_finds_nothing(train):
    mined = itemsets.mine(itemsets.transactions(train, [3, 8]), 0.5)
    assert rows(mined) == []
    assert mined.columns == ["trip_type", "items", "freq"]


@pytest.mark.parametrize("support", [0.004, 0.05, 0.2])
def test_mine_equals_brute_force(spark, support):
    baskets = random_baskets(250, 3)
    mined = itemsets.mine(spark.createDataFrame(baskets, BASKETS), support)
    assert rows(mined) == brute_force(baskets, max(1, -(-support * 250 // 1)))


def test_mine_equals_fp_growth_with_the_label_as_item(spark):
    baskets = spark.createDataFrame(random_baskets(300, 5), BASKETS)
    items = itemsets.with_label_item(baskets)
    model = FPGrowth(itemsCol="items", minSupport=0.02).fit(items)
    labelled = model.freqItemsets.where("size(items) > 2 and exists(items, i -> startswith(i, '-'))")
    expected = labelled.select(F.sort_array("items").alias("items"), "freq").select(
        (-F.col("items")[0].cast("int")).alias("trip_type"), F.expr("slice(items, 2, size(items))"), "freq"
    )
    mined = itemsets.mine(baskets, 0.02)
    assert rows(mined) == rows(expected)
    assert mined.count() > 20


@pytest.mark.parametrize("cells", [0, 3, 20, 60])
def test_mine_grows_large_databases_further(spark, cells):
    """Whatever a task may hold, the sets are the same."""
    baskets = random_baskets(150, 8)
    mined = itemsets.mine(spark.createDataFrame(baskets, BASKETS), 0.03, cells)
    assert rows(mined) == brute_force(baskets, 5)


@pytest.mark.parametrize("n_items", [3, 9, 70])
def test_conditional_database_in_bits(n_items):
    rng = np.random.default_rng(n_items)
    chosen = [np.flatnonzero(rng.random(n_items) < min(0.6, 8 / n_items)) + 3 for _ in range(60)]
    baskets = [b.astype(np.int32) for b in chosen if len(b)]
    weights = rng.integers(1, 5, len(baskets))
    found = {
        (*shared, int(last)): int(weight)
        for shared, lasts, sums in conditional.frequent((1,), baskets, weights, 25)
        for last, weight in zip(lasts, sums)
    }
    counts = Counter()
    for basket, weight in zip(baskets, weights):
        for size in range(1, len(basket) + 1):
            for items in combinations(basket.tolist(), size):
                counts[(1, *items)] += int(weight)
    assert found == {items: n for items, n in counts.items() if n >= 25}


def test_mine_with_a_hot_basket(spark):
    # Half of all visits hold the same full basket.
    full = ["A", "B", "C", "D", "E", "F", "G"]
    baskets = [(v, 1, full) for v in range(100)] + [(100 + v, t, b) for v, t, b in random_baskets(100, 9)]
    mined = itemsets.mine(spark.createDataFrame(baskets, BASKETS), 0.1)
    assert rows(mined) == brute_force(baskets, 20)


def test_mine_large_baskets(spark):
    """Forty departments in each basket, of which few are frequent together."""
    rng = random.Random(11)
    baskets = []
    for v in range(120):
        often = [f"D{k:02}" for k in range(6) if rng.random() < 0.8]
        rare = [f"R{k:03}" for k in rng.sample(range(600), 34)]
        baskets.append((v, 1, sorted(often + rare)))
    mined = itemsets.mine(spark.createDataFrame(baskets, BASKETS), 0.2)
    few = [(v, t, [d for d in b if d.startswith("D")]) for v, t, b in baskets]
    assert rows(mined) == brute_force(few, 24)


def test_mine_does_not_repeat_earlier_rounds(spark):
    """A round reads its materialised baskets: no plan holds the explodes of another."""
    patterns = spark.createDataFrame(random_baskets(100, 4), BASKETS)
    mined = itemsets.mine(patterns, 0.05)
    assert mined._jdf.queryExecution().analyzed().toString().count("explode") == 0


def test_mine_without_broadcasts(spark):
    baskets = random_baskets(200, 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mined = rows(itemsets.mine(spark.createDataFrame(baskets, BASKETS), 0.02))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert mined == brute_force(baskets, 4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sets(st.sampled_from("ABCDE")), min_size=1, max_size=12))
def test_subsets_are_at_least_as_frequent(spark, sets):
    baskets = [(v, 1, sorted(s)) for v, s in enumerate(sets)]
    found = {i: n for _, i, n in rows(itemsets.mine(spark.createDataFrame(baskets, BASKETS), 0.1))}
    for items, n in found.items():
        for smaller in combinations(items, len(items) - 1):
            assert len(smaller) < 2 or found[smaller] >= n


def test_match_fixture(train, both):
    mined = itemsets.mine(itemsets.transactions(train, [8]), 0.5)
    found = dict(rows(itemsets.match(features.purchases(both), mined)))
    # Visit 7 holds the set too, but not as a prefix of its sorted departments.
    assert found == {1: 3, 2: 3, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}


def test_match_takes_the_longest_prefix_and_breaks_ties(spark):
    known = spark.createDataFrame(
        [(9, ["A", "B"], 5), (7, ["A", "B"], 6), (4, ["A", "B", "C"], 1), (6, ["B", "C"], 3), (5, ["B", "C"], 3)],
        "trip_type int, items array<string>, freq bigint",
    )
    baskets = {1: "AB", 2: "ABC", 3: "ABCD", 4: "ABD", 5: "BC", 6: "A", 7: "ACB"}
    sums = [(v, d, 1) for v, names in baskets.items() for d in names] + [(8, None, 3), (9, "A", 0), (9, "B", 2)]
    purchases = spark.createDataFrame(sums, "visit_number bigint, department string, value bigint")
    found = dict(rows(itemsets.match(purchases, known)))
    assert found == {1: 7, 2: 4, 3: 4, 4: 7, 5: 5, 6: 0, 7: 4, 8: 0, 9: 0}


def test_match_against_nothing(spark, both):
    nothing = spark.createDataFrame([], "trip_type int, items array<string>, freq bigint")
    assert {n for _, n in rows(itemsets.match(features.purchases(both), nothing))} == {0}


def test_lines_round_trip(spark, tmp_path):
    known = spark.createDataFrame(
        [(3, ["CANDY, TOBACCO, COOKIES", "DAIRY"], 2), (12, ["A", "B", "C"], 4)],
        "trip_type int, items array<string>, freq bigint",
    )
    sinks.write_itemsets(known, str(tmp_path / "sets"))
    assert rows(itemsets.read_itemsets(spark, str(tmp_path / "sets"))) == rows(known, "trip_type", "items")


def test_read_drops_null_items_and_sorts(spark, tmp_path):
    (tmp_path / "sets.txt").write_text("3;PRODUCE;NULL;DAIRY\n8;NULL\n")
    found = rows(itemsets.read_itemsets(spark, str(tmp_path / "sets.txt")))
    assert found == [(3, ("DAIRY", "PRODUCE")), (8, ())]


def test_preview_and_trip_types(spark):
    known = spark.createDataFrame(
        [(3, ["A", "B"], 2), (3, ["A", "C"], 5), (4, ["A", "B"], 2)], "trip_type int, items array<string>, freq bigint"
    )
    assert [tuple(r) for r in itemsets.preview(known, 2).collect()] == [("-3, A, C", 5), ("-3, A, B", 2)]
    assert rows(itemsets.trip_types(known)) == [(3, 2), (4, 1)]
