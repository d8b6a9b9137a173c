from __future__ import annotations

import pytest
from fixture import rows
from pyspark.sql import functions as F

from tillroll.functions import scalars
from tillroll.operators import features, matrix, vocabulary
from tillroll.sources import sinks


@pytest.fixture(scope="module")
def upcs(train):
    return vocabulary.top_terms(train, "upc", 2)


@pytest.fixture(scope="module")
def long(both, categories, upcs):
    return features.visit_features(both, categories, upcs).cache()


@pytest.fixture(scope="module")
def dictionary(both, categories, upcs):
    terms = vocabulary.feature_terms(vocabulary.occurring_terms(both), categories, upcs)
    return vocabulary.feature_dictionary(terms).cache()


DEPARTMENT_SUMS = [
    (1, "-DAIRY", -1), (1, "DAIRY", 1), (1, "PRODUCE", 2), (2, "DAIRY", 2), (2, "PRODUCE", 1),
    (3, "-PHARMACY RX", -1), (4, "TOYS", 0), (5, "PRODUCE", 3),
    (7, "ACCESSORIES", 1), (7, "DAIRY", 1), (7, "PRODUCE", 1),
]

CATEGORY_SUMS = [
    (1, "-Food", -1), (1, "-Non_Discretionary", -1), (1, "Food", 3), (1, "Non_Discretionary", 3),
    (2, "Food", 3), (2, "Non_Discretionary", 3), (4, "Hobbies", 0),
    (5, "Food", 3), (5, "Non_Discretionary", 3), (7, "Food", 2), (7, "Non_Discretionary", 2),
]

UPC_SUMS = [(1, "UPC_4011", 2), (1, "UPC_999", 0), (2, "UPC_4011", 1), (2, "UPC_999", 2), (5, "UPC_4011", 3)]

CALENDAR = [(1, 0, 1), (2, 5, 0), (3, 6, 0), (4, 4, 1), (5, 0, 1), (6, 6, 0), (7, 1, 1)]


def test_department_sums(both):
    assert rows(features.department_sums(both)) == DEPARTMENT_SUMS


def test_returns(both):
    found = rows(features.visit_returns(both))
    assert found == [(v, int(v in (1, 3)), int(v in (1, 3))) for v in range(1, 8)]


def test_calendar(both):
    assert rows(features.visit_calendar(both)) == CALENDAR


def test_weekdays(spark):
    days = spark.createDataFrame([("Monday",), (None,), ("Sunday",)], "d string")
    assert [r[0] for r in days.select(scalars.weekday_ordinal(F.col("d"))).collect()] == [0, None, 6]


def test_unknown_weekdays_fail(both, categories, upcs):
    odd = both.withColumn("weekday", F.when(F.col("visit_number") == 4, "monday").otherwise(F.col("weekday")))
    with pytest.raises(Exception, match="unknown weekday: monday"):
        features.visit_features(odd, categories, upcs).collect()


def test_visit_summary_agrees_with_its_parts(both):
    parts = features.visit_facts(both).join(features.department_sums(both), "visit_number", "left")
    summary = features.visit_summary(both)
    assert rows(summary, *parts.columns) == rows(parts)


def test_equal_names_of_several_families(spark, both, upcs, tmp_path):
    """A category named like a department, and one like the return side of another."""
    clashing = spark.createDataFrame([("DAIRY", "PRODUCE"), ("TOYS", "-DAIRY")], "department string, category string")
    long = features.visit_features(both, clashing, upcs)
    terms = vocabulary.feature_terms(vocabulary.occurring_terms(both), clashing, upcs)
    dictionary = vocabulary.feature_dictionary(terms).cache()
    width = dictionary.count()
    sparse = features.sparse_rows(long, dictionary)
    keys = {r.idx: (r.family, r.feature) for r in dictionary.collect()}
    assert len(set(keys.values())) == width
    for r in sinks.dense_lines(sparse, width).collect():
        assert list(r.indices) == sorted(set(r.indices)) and len(r.line.split(",")) == width
    unpacked = {(r.visit_number, *keys[i], v) for r in sparse.collect() for i, v in zip(r.indices, r["values"])}
    assert unpacked == {t for t in rows(long, "visit_number", "family", "feature", "value") if t[3] != 0}
    names = [r.name for r in sinks.column_names(dictionary).collect()]
    assert len(set(names)) == width and {"PRODUCE (1)", "PRODUCE (5)", "-DAIRY (0)", "-DAIRY (5)"} <= set(names)
    with pytest.raises(ValueError):
        sinks.write_dense(sparse, dictionary, str(tmp_path / "dense"), max_width=width - 1)


def test_visit_facts_agree_with_their_parts(both):
    parts = features.visit_calendar(both).join(features.visit_returns(both), "visit_number")
    assert rows(features.visit_facts(both)) == rows(parts)


def test_category_sums_overlap_and_mirror(both, categories):
    assert rows(features.category_sums(both, categories)) == CATEGORY_SUMS


def test_upc_sums_keep_only_the_vocabulary(both, upcs):
    assert rows(features.upc_sums(both, upcs)) == UPC_SUMS


def test_means_use_raw_departments(both):
    means = features.visit_means(both, "department").where("visit_number = 1")
    assert rows(means) == [(1, "DAIRY", 0.0), (1, "PRODUCE", 2.0)]
    found = dict(rows(features.mean_features(both).where("visit_number = 1"), "feature", "value"))
    assert found == {"DAIRY": 0.0, "PRODUCE": 2.0, "FLN_10": 0.0, "FLN_5501": 2.0, "Weekday": 0.0}


def test_visit_features_are_the_union_of_the_single_ones(both, long, categories, upcs):
    parts = [
        *rows(features.department_sums(both)),
        *rows(features.fineline_sums(both)),
        *rows(features.upc_sums(both, upcs)),
        *rows(features.category_sums(both, categories)),
    ]
    for visit, n_returns, _ in rows(features.visit_returns(both)):
        parts.append((visit, "Returns", n_returns))
    for visit, weekday, mon_to_fri in CALENDAR:
        parts += [(visit, "Weekday", weekday), (visit, "Mon_To_Fri", mon_to_fri)]
    assert rows(long, "visit_number", "feature", "value") == sorted(parts, key=repr)


def test_sums_are_complete(both, long):
    departments = long.where(F.col("family").isin(features.RETURNED, features.PURCHASED))
    summed = dict(rows(departments.groupBy("visit_number").agg(F.sum("value"))))
    scanned = both.where("department is not null").groupBy("visit_number").agg(F.sum("scan_count"))
    assert summed == dict(rows(scanned))


def test_dictionary_order_is_dense_and_by_family(dictionary):
    found = [r.feature for r in dictionary.orderBy("idx").collect()]
    assert [r.idx for r in dictionary.orderBy("idx").collect()] == list(range(len(found)))
    assert found == [
        "-DAIRY", "-PHARMACY RX", "ACCESSORIES", "DAIRY", "PRODUCE", "TOYS",
        "FLN_7", "FLN_10", "FLN_5501", "UPC_999", "UPC_4011",
        "Returns", "Weekday", "Mon_To_Fri",
        "Food", "Hobbies", "Non_Discretionary", "-Food", "-Hobbies", "-Non_Discretionary",
    ]


def test_sparse_rows_round_trip(long, dictionary):
    sparse = features.sparse_rows(long, dictionary)
    names = {r.idx: r.feature for r in dictionary.collect()}
    unpacked = {
        (r.visit_number, names[i], v) for r in sparse.collect() for i, v in zip(r.indices, r["values"])
    }
    assert unpacked == {t for t in rows(long, "visit_number", "feature", "value") if t[2] != 0}
    assert all(r.indices == sorted(r.indices) for r in sparse.collect())


def test_sparse_rows_keep_visits_without_entries(long, dictionary):
    few = dictionary.where("feature = 'TOYS'")
    assert rows(features.sparse_rows(long, few), "visit_number", "indices") == [(v, ()) for v in range(1, 8)]


def test_dense_lines(long, dictionary):
    width = dictionary.count()
    for r in sinks.dense_lines(features.sparse_rows(long, dictionary), width).collect():
        expected = [0] * width
        for i, v in zip(r.indices, r["values"]):
            expected[i] = v
        assert r.line == ",".join(map(str, expected))


def test_wide_fills_with_zero_and_goes_back_to_long(both):
    sums = features.department_sums(both)
    signed = features.signed_departments(both)
    terms = vocabulary.column_terms(signed, "department")
    wide = features.wide(sums, terms)
    assert set(wide.columns) == {"visit_number", *terms}
    back = wide.unpivot(["visit_number"], terms, "feature", "value").where("value != 0")
    assert rows(back) == [t for t in DEPARTMENT_SUMS if t[2] != 0]


def test_labels(train, test_log):
    assert rows(features.extract_labels(train)) == [(1, 3), (2, 3), (3, 8), (4, 5), (6, 3)]
    with pytest.raises(ValueError):
        features.extract_labels(test_log)


def test_retail_categories_are_many_to_many(spark):
    pairs = vocabulary.retail_categories(spark)
    assert pairs.count() == 127
    assert pairs.select("category").distinct().count() == 10
    assert pairs.select("department").distinct().count() == 67


def test_matrix_rows_equal_the_long_form(spark, both, categories, dictionary, long):
    """Integer keys give what joining names gives, with fitted values beside them."""
    encoded = matrix.encoding(dictionary, categories)
    columns = ["visit_number", "indices", "values"]
    assert rows(matrix.matrix_rows(both, encoded), *columns) == rows(features.sparse_rows(long, dictionary), *columns)
    last = dictionary.count()
    more = dictionary.unionByName(spark.createDataFrame([(last, features.FITTED, "ItemSet")], dictionary.schema))
    sets = both.select("visit_number").distinct().withColumn("item_set", F.col("visit_number") % 3)
    fitted = features.fitted_feature(sets, "item_set", "ItemSet")
    wide = matrix.matrix_rows(both, matrix.encoding(more, categories), (sets, "item_set", "ItemSet"))
    expected = features.sparse_rows(long.unionByName(fitted), more)
    assert rows(wide, *columns) == rows(expected, *columns)
    # What the dictionary lacks is left out, here all but the visit features, or everything.
    few = dictionary.where(F.col("family") == features.VISIT)
    assert rows(matrix.matrix_rows(both, matrix.encoding(few, categories)), *columns) == rows(
        features.sparse_rows(long, few), *columns
    )
    none = matrix.matrix_rows(both, matrix.encoding(dictionary.limit(0), categories))
    assert rows(none, "visit_number", "indices") == [(v, ()) for v in range(1, 8)]


def test_wide_and_vectors_hold_no_column_per_term_while_summing(spark):
    """Sums are listed per visit and spread last; equal rows are added, null sums and unknown terms are 0."""
    from tillroll.operators import clusters

    sums = [(1, "a", 2), (1, "a", 3), (1, "x", 9), (2, "b", None), (3, None, 4), (None, "b", 5), (4, "b.c", 6)]
    frame = spark.createDataFrame(sums, "visit_number bigint, feature string, value bigint")
    wide = features.wide(frame, ["a", "b", "b.c"])
    expected = [(1, 5, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 0, 0, 6), (None, 0, 5, 0)]
    assert rows(wide) == sorted(expected, key=repr)
    vectors = clusters.department_vectors(frame.withColumnRenamed("feature", "department"), ["a", "b", "b.c"])
    found = [(r.visit_number, *map(int, r.vector.toArray())) for r in vectors.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    for plan in (wide, vectors):
        assert "pivotfirst" not in plan._jdf.queryExecution().toString().lower()
