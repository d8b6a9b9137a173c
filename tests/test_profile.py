from __future__ import annotations

import numpy as np
import pytest
from fixture import rows
from pyspark.sql import functions as F

from tillroll.constants import WEEKDAYS
from tillroll.operators import crosstab, profile, vocabulary
from tillroll.operators.ordering import running_total

PROFILED = ["trip_type", "upc", "weekday", "department", "fineline"]


def test_distinct_counts_count_null_once(train):
    found = dict(rows(profile.distinct_counts(train, PROFILED)))
    assert found == {"trip_type": 3, "upc": 4, "weekday": 4, "department": 5, "fineline": 4}


def test_null_counts_and_overlaps(train):
    assert dict(rows(profile.null_counts(train, ["upc", "department", "fineline"]))) == {
        "upc": 3, "department": 2, "fineline": 3,
    }
    assert rows(profile.null_overlap(train)) == [(2, 0, 0)]


def test_values_where_missing(train):
    assert rows(profile.values_where_missing(train, "department", "fineline")) == [("PHARMACY RX", 1)]
    assert rows(profile.values_where_missing(train, "scan_count", "upc")) == [(-1, 1)]


def test_listed_values_quote_and_show_null(spark):
    names = spark.createDataFrame([("A",), (None,), ("B'C",), ("A",)], "department string")
    listed = [r[0] for r in profile.listed_values(names, "department").collect()]
    assert listed == sorted([repr("A"), repr("B'C"), "nan"])
    assert [r[0] for r in profile.filled_values(names, "department").collect()] == ["", "A", "B'C"]


def test_describe(train):
    found = profile.describe(train, "scan_count").first()
    assert found.n == 9
    assert found.mean == pytest.approx(0.666667, abs=1e-6)
    assert found["std"] == pytest.approx(1.118034, abs=1e-6)
    assert (found.min_value, found.q25, found.q50, found.q75, found.max_value) == (-1, 0, 1, 1, 2)


def test_describe_of_nothing(train):
    found = profile.describe(train.where("false"), "scan_count").first()
    assert found.n == 0
    assert found.q50 is None


@pytest.mark.parametrize("size", [1, 2, 501])
def test_describe_matches_numpy_on_many_values(spark, size):
    values = np.random.default_rng(size).integers(-1000, 1000, size)
    found = profile.describe(spark.createDataFrame([(int(v),) for v in values], "v bigint"), "v").first()
    expected = np.percentile(values, [25, 50, 75])
    assert [found.q25, found.q50, found.q75] == pytest.approx(list(expected))


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_running_total_does_not_depend_on_ranges(spark, buckets):
    amounts = spark.range(300).select(F.col("id").alias("v"), (F.col("id") % 7).alias("w")).repartition(5)
    got = rows(running_total(amounts, F.col("v"), F.col("w"), buckets), "v", "before")
    before = 0
    for v, total in sorted(got):
        assert total == before
        before += v % 7


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).integers(-50, 51, 400)
    frame = spark.createDataFrame([(int(v),) for v in values], "v bigint")
    found = sorted(profile.histogram(frame, "v", 100).collect())
    counts, edges = np.histogram(values, bins=100)
    assert [r.n for r in found] == list(counts)
    assert [r.low for r in found] == pytest.approx(list(edges[:-1]))
    assert [r.high for r in found] == pytest.approx(list(edges[1:]))


def test_histogram_of_one_value_is_centred(spark):
    frame = spark.createDataFrame([(3,)] * 4, "v bigint")
    found = sorted(profile.histogram(frame, "v", 10).collect())
    counts, edges = np.histogram([3] * 4, bins=10)
    assert [r.n for r in found] == list(counts)
    assert found[0].low == edges[0]


def test_crosstab_winners(train):
    assert rows(crosstab.top_per_column(train, "department", "trip_type"), "trip_type", "department") == [
        (3, "DAIRY"), (5, "TOYS"), (8, "PHARMACY RX"),
    ]
    assert rows(crosstab.top_per_column(train, "fineline", "trip_type"), "trip_type", "fineline") == [
        (3, 10), (5, 7),
    ]
    # A tie of three rows each goes to the first label.
    assert rows(crosstab.top_per_column(train, "weekday", "trip_type"), "trip_type", "weekday") == [
        (3, "Monday"), (5, "Friday"), (8, "Sunday"),
    ]


def test_wide_crosstab_and_its_histogram(train):
    wide = crosstab.wide_crosstab(train, "trip_type", "weekday", WEEKDAYS)
    assert rows(wide, "trip_type", "Monday", "Saturday", "Sunday") == [(3, 3, 3, 1), (5, 0, 0, 0), (8, 0, 0, 1)]
    bins = crosstab.cell_histogram(train, "trip_type", "weekday", WEEKDAYS)
    monday = {r.bin: r.n for r in bins.where("weekday = 'Monday'").collect()}
    assert monday == {1: 2, 10: 1} | {b: 0 for b in range(2, 10)}
    assert rows(bins.select("weekday").distinct()) == [("Friday",), ("Monday",), ("Saturday",), ("Sunday",)]


def test_top_terms_break_ties_by_value(train):
    assert rows(vocabulary.top_terms(train, "upc", 2)) == [(4011, 2), (999, 3)]
    assert rows(vocabulary.top_terms(train, "fineline", 1)) == [(10, 3)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_results_do_not_depend_on_partitions(train, partitions):
    spread = train.orderBy(F.desc("scan_count")).repartition(partitions)
    for operator in (
        lambda r: crosstab.top_per_column(r, "weekday", "trip_type"),
        lambda r: profile.value_counts(r, "department"),
        lambda r: vocabulary.top_terms(r, "upc", 2),
    ):
        assert rows(operator(spread)) == rows(operator(train))
