"""One query per operator, over the scan log of the order tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import MIN_SUPPORT, N_CLUSTERS, SAMPLE_VISITS, TOP_UPCS, WEEKDAYS
from tillroll.operators import (
    clusters,
    crosstab,
    features,
    itemsets,
    matrix,
    minibatch,
    profile,
    split,
    vocabulary,
)
from tillroll.session import checkpoint, new_folder, written
from tillroll.sources import scanlog, sinks, star, visits

# Parameters of the order tables. The small UPC vocabulary leaves UPCs out at the scale
# where results are checked.
IGNORED = [5]
FEW_UPCS = 500
FEW_BATCHES = 4
# The department names of the part table, two words each, and both signs of them.
DEPARTMENTS = [
    f"{kind} {thing}"
    for kind in "blue cold hot large new old red small".split()
    for thing in "anvil bolt gear gizmo plate ring rod widget".split()
]
SIGNED_DEPARTMENTS = [f"-{name}" for name in DEPARTMENTS] + DEPARTMENTS
BINS = 100
VISIT = 8

ALL_COLUMNS = list(scanlog.SCAN_COLUMNS)
FEATURE_COLUMNS = [c for c in ALL_COLUMNS if c != "trip_type"]
PROFILED = ["trip_type", "upc", "weekday", "department", "fineline"]

Query = Callable[[SparkSession, str], DataFrame]


def _on(columns: str, operator: Callable[..., DataFrame], *args, part: str | None = None) -> Query:
    """A query that applies an operator to the named columns of the scan log."""
    return lambda spark, folder: operator(star.scans(spark, folder, columns.split(), part), *args)


def _upcs(spark: SparkSession, folder: str, k: int = TOP_UPCS) -> DataFrame:
    return checkpoint(vocabulary.top_terms(star.scans(spark, folder, ["upc"], "train"), "upc", k))


def _features(
    spark: SparkSession, folder: str, upcs: DataFrame | None = None, part: str | None = None
) -> DataFrame:
    rows = star.scans(spark, folder, FEATURE_COLUMNS, part, even=True)
    return features.visit_features(rows, star.categories(spark, folder), upcs or _upcs(spark, folder))


def _dictionary(
    spark: SparkSession, folder: str, upcs: DataFrame | None = None, fitted: Sequence[str] = ()
) -> DataFrame:
    rows = star.scans(spark, folder, ["scan_count", "department", "fineline"])
    return _dictionary_of(rows, star.categories(spark, folder), upcs or _upcs(spark, folder), fitted)


def _dictionary_of(rows: DataFrame, categories: DataFrame, upcs: DataFrame, fitted: Sequence[str] = ()) -> DataFrame:
    terms = vocabulary.feature_terms(vocabulary.occurring_terms(rows), categories, upcs, fitted)
    return vocabulary.feature_dictionary(terms)


def _matrix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    # Vocabularies first, each fitted once; then the rows over them.
    log = star.stored(spark, folder, FEATURE_COLUMNS)
    categories = star.categories(spark, folder)
    upcs = checkpoint(vocabulary.top_terms(log.where("part = 'train'"), "upc", TOP_UPCS))
    dictionary = checkpoint(_dictionary_of(log, categories, upcs))
    return matrix.matrix_rows(log, matrix.encoding(dictionary, categories)), dictionary


def _baskets(spark: SparkSession, folder: str) -> DataFrame:
    return itemsets.transactions(
        star.scans(spark, folder, ["visit_number", "trip_type", "department"], "train"), IGNORED
    )


def _itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return itemsets.mine(_baskets(spark, folder), MIN_SUPPORT)


def _purchases(spark: SparkSession, folder: str, part: str | None = None) -> DataFrame:
    return features.purchases(star.scans(spark, folder, ["visit_number", "scan_count", "department"], part))


def _match(spark: SparkSession, folder: str) -> DataFrame:
    return itemsets.match(_purchases(spark, folder), _itemsets(spark, folder))


def _joined(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ";") for c in columns})


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in columns})


def _long(rows: DataFrame) -> DataFrame:
    return rows.select("visit_number", "feature", "value")


def _sparse_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(_matrix(spark, folder)[0], "indices", "values")


def _dense_rows(spark: SparkSession, folder: str) -> DataFrame:
    sparse, dictionary = _matrix(spark, folder)
    return sinks.dense_lines(sparse, dictionary.count()).select("visit_number", "line")


def _department_pivot(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.scans(spark, folder, ["visit_number", "scan_count", "department"])
    return features.wide(features.department_sums(rows), SIGNED_DEPARTMENTS)


def _both_inputs(spark: SparkSession, folder: str) -> DataFrame:
    log = star.stored(spark, folder)
    train = log.where("part = 'train'").select(*ALL_COLUMNS)
    test = log.where("part = 'test'").select(*FEATURE_COLUMNS)
    return scanlog.union_inputs(train, test)


def _part_of(part: str) -> Query:
    # Lines are restricted before any feature is made of them; a visit is in one part.
    return lambda spark, folder: _long(_features(spark, folder, part=part))


def _matrix_of(part: str) -> Query:
    """The final matrix of a part: all features, matched itemset and cluster, over one dictionary."""

    def query(spark, folder):
        log, categories = star.stored(spark, folder), star.categories(spark, folder)
        train, rows = log.where("part = 'train'"), log.where(F.col("part") == part)
        upcs = checkpoint(vocabulary.top_terms(train, "upc", TOP_UPCS))
        dictionary = checkpoint(_dictionary_of(log, categories, upcs, features.FITTED_FEATURES))
        encoded = matrix.encoding(dictionary, categories)
        purchases = checkpoint(features.purchases(rows))
        matched = itemsets.match(purchases, itemsets.mine(itemsets.transactions(train, IGNORED), MIN_SUPPORT))
        points = minibatch.department_entries(purchases, DEPARTMENTS)
        fitted = points if part == "train" else minibatch.department_entries(features.purchases(train), DEPARTMENTS)
        assigned = minibatch.nearest(points, _centres_of(fitted))
        full = matrix.matrix_rows(
            rows, encoded, (matched, "item_set", features.ITEM_SET), (assigned, "cluster", features.DEPT_CATEGORY)
        )
        return _joined(full, "indices", "values")

    return query


def _labelled_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Labels beside the features of the settled orders, over a log stored by visit."""
    stored = visits.stored_by_visit(star.scans(spark, folder, ALL_COLUMNS))
    dictionary = checkpoint(_dictionary(spark, folder))
    encoded = matrix.encoding(dictionary, star.categories(spark, folder))
    train = visits.stored_by_visit(star.scans(spark, folder, ["visit_number", "trip_type"], "train"))
    return _joined(labelled_rows(stored, train, encoded), "indices", "values")


def labelled_rows(scans: DataFrame, train: DataFrame, encoded: matrix.Encoding) -> DataFrame:
    """(visit_number, trip_type, indices, values) of the visits in ``train``: split, features and labels by visit."""
    rows = matrix.matrix_rows(split.of_visits(scans, train), encoded)
    return rows.join(features.extract_labels(train), "visit_number")


def _shuffled_train(spark: SparkSession, folder: str) -> DataFrame:
    train = star.scans(spark, folder, ["visit_number", "trip_type"], "train")
    return split.shuffled(features.extract_labels(train))


def _visit_clusters(spark: SparkSession, folder: str) -> DataFrame:
    vectors = clusters.points(_purchases(spark, folder), DEPARTMENTS)
    train = star.scans(spark, folder, ["visit_number"], "train")
    model = clusters.train_clusters(split.of_visits(vectors, train), N_CLUSTERS)
    return clusters.assign_clusters(model, vectors)


def _points(spark: SparkSession, folder: str, part: str | None = None) -> DataFrame:
    return minibatch.department_entries(_purchases(spark, folder, part), DEPARTMENTS)


def _centres(spark: SparkSession, folder: str) -> DataFrame:
    return _centres_of(_points(spark, folder, "train"))


def _centres_of(points: DataFrame) -> DataFrame:
    """Centres of the settled orders, from the first visits of the shuffled order on."""
    train = written(points)
    width = len(DEPARTMENTS)
    start = minibatch.first_centres(train, N_CLUSTERS, 0, width)
    return minibatch.train(train, width, N_CLUSTERS, batches=FEW_BATCHES, start=start)


def _cluster_centres(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(_centres(spark, folder), "centre")


def _nearest_to(centres: Callable[[SparkSession, str], DataFrame]) -> Query:
    def query(spark, folder):
        found = minibatch.nearest(_points(spark, folder), centres(spark, folder))
        return found.select("visit_number", "cluster", "distance")

    return query


def _frozen(spark: SparkSession, folder: str) -> DataFrame:
    return minibatch.frozen(_points(spark, folder, "train"), N_CLUSTERS, 0, len(DEPARTMENTS))


def _department_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = clusters.department_vectors(_purchases(spark, folder), DEPARTMENTS)
    sums = F.transform(vector_to_array("vector"), lambda value: value.cast("bigint"))
    return _joined(vectors.select("visit_number", sums.alias("vector")), "vector")


def _scans_by_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The settled orders, written as the CSV of a scan log and read from it."""
    path = new_folder(spark)
    scanlog.write_scans(star.scans(spark, folder, ALL_COLUMNS, "train"), path)
    return scanlog.read_scans(spark, path)


def _rejected_by_csv(spark: SparkSession, folder: str) -> DataFrame:
    """What reading the scan log leaves out if every line with a return of 50 is cut, and with one of 49 misspelt."""
    path = new_folder(spark)
    rows = star.scans(spark, folder, ALL_COLUMNS)
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("NULL")) for name in ALL_COLUMNS]
    count = ALL_COLUMNS.index("scan_count")
    cut, misspelt = F.col("scan_count") == -50, F.col("scan_count") == -49
    wrong = [F.concat(f, F.lit("x")) if n == count else f for n, f in enumerate(fields)]
    line = F.when(cut, F.concat_ws(",", *fields[:count])).when(misspelt, F.concat_ws(",", *wrong))
    header = ",".join(scanlog.SCAN_COLUMNS[name][0] for name in ALL_COLUMNS)
    # The header is the name of the only column: nothing is to be quoted.
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    rows.select(line.alias("value")).na.fill(",".join(["1"] * 7)).toDF(header).write.options(**plain).csv(path)
    lines = scanlog.rejected_lines(spark, path)
    return lines.groupBy("reason").agg(F.count("*").alias("n"))


def _itemsets_by_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    sinks.write_itemsets(_itemsets(spark, folder), path)
    return _joined(itemsets.read_itemsets(spark, path), "items")


def _by_csv(rows: Query, schema: str) -> Query:
    """What a query gives, written as CSV with a header and read from it."""

    def query(spark, folder):
        path = new_folder(spark)
        sinks.write_columns(rows(spark, folder), path)
        return spark.read.schema(schema).csv(path, header=True)

    return query


def _describe(rows: DataFrame) -> DataFrame:
    return _rounded(profile.describe(rows, "scan_count"), "mean", "std", *profile.QUARTILES)


def visit_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Department sums beside the returns and the calendar of their visit."""
    rows = star.scans(spark, folder, ["visit_number", "weekday", "scan_count", "department"])
    return features.visit_summary(rows)


QUERIES: dict[str, Query] = {
    # one row per scan line
    "signed_departments": _on("visit_number scan_count department", features.signed_departments),
    "one_visit": _on(" ".join(ALL_COLUMNS), scanlog.one_visit, VISIT),
    "sample_visits": _on(" ".join(ALL_COLUMNS), scanlog.sample_visits, SAMPLE_VISITS),
    "both_inputs": _both_inputs,
    # profiling
    "distinct_counts": _on(" ".join(PROFILED), profile.distinct_counts, PROFILED),
    "null_counts": _on(" ".join(ALL_COLUMNS), profile.null_counts, ALL_COLUMNS),
    "null_overlap": _on("upc department fineline", profile.null_overlap),
    "department_values": _on("department", profile.listed_values, "department"),
    "department_values_filled": _on("department", profile.filled_values, "department"),
    "scan_describe": _on("scan_count", _describe),
    "scan_histogram": _on("scan_count", lambda r: _rounded(profile.histogram(r, "scan_count", BINS), "low", "high")),
    "dept_when_fineline_null": _on("department fineline", profile.values_where_missing, "department", "fineline"),
    "dept_when_upc_null": _on("department upc", profile.values_where_missing, "department", "upc"),
    "scans_when_upc_null": _on("scan_count department upc", profile.values_where_missing, "scan_count", "upc"),
    "scans_when_fineline_null": _on(
        "scan_count department fineline", profile.values_where_missing, "scan_count", "fineline"
    ),
    "top_upcs": _on("upc", vocabulary.top_terms, "upc", TOP_UPCS),
    # crosstabs
    "crosstab_trip_fineline": _on("trip_type fineline", crosstab.crosstab, "fineline", "trip_type"),
    "crosstab_trip_department": _on("trip_type department", crosstab.crosstab, "department", "trip_type"),
    "crosstab_trip_weekday": _on("trip_type weekday", crosstab.wide_crosstab, "trip_type", "weekday", WEEKDAYS),
    "top_fineline_by_trip": _on("trip_type fineline", crosstab.top_per_column, "fineline", "trip_type"),
    "top_department_by_trip": _on("trip_type department", crosstab.top_per_column, "department", "trip_type"),
    "top_weekday_by_trip": _on("trip_type weekday", crosstab.top_per_column, "weekday", "trip_type"),
    "top_trip_by_weekday": _on("trip_type weekday", crosstab.top_per_column, "trip_type", "weekday"),
    "crosstab_histogram": _on(
        "trip_type weekday",
        lambda r: _rounded(crosstab.cell_histogram(r, "trip_type", "weekday", WEEKDAYS), "low", "high"),
    ),
    # features per visit
    "visit_labels": _on("visit_number trip_type", features.visit_labels),
    "visit_label_pairs": _on("visit_number trip_type", lambda r: r.distinct()),
    "visits_per_trip_type": _on("visit_number trip_type", lambda r: profile.value_counts(r.distinct(), "trip_type")),
    "trip_labels": _on("visit_number trip_type", features.extract_labels, part="train"),
    "visit_returns": _on("visit_number scan_count", features.visit_returns),
    "visit_calendar": _on("visit_number weekday", features.visit_calendar),
    "visit_summary": visit_summary,
    "department_sums": _on("visit_number scan_count department", features.department_sums),
    "department_pivot": _department_pivot,
    "fineline_sums": _on("visit_number scan_count fineline", features.fineline_sums),
    "upc_sums": lambda spark, folder: features.upc_sums(
        star.scans(spark, folder, ["visit_number", "upc", "scan_count"]), _upcs(spark, folder)
    ),
    "upc_sums_few": lambda spark, folder: features.upc_sums(
        star.scans(spark, folder, ["visit_number", "upc", "scan_count"]), _upcs(spark, folder, FEW_UPCS)
    ),
    "category_sums": lambda spark, folder: features.category_sums(
        star.scans(spark, folder, ["visit_number", "scan_count", "department"]), star.categories(spark, folder)
    ),
    "visit_dept_mean": _on(
        "visit_number scan_count department",
        lambda r: _rounded(features.visit_means(r, "department"), "mean_scan_count"),
    ),
    "visit_fineline_mean": _on(
        "visit_number scan_count fineline",
        lambda r: _rounded(features.visit_means(r, "fineline"), "mean_scan_count"),
    ),
    "visit_mean_features": lambda spark, folder: _rounded(
        features.mean_features(star.scans(spark, folder, FEATURE_COLUMNS, even=True)), "value"
    ),
    "visit_features": lambda spark, folder: _long(_features(spark, folder)),
    "feature_dictionary": _dictionary,
    "sparse_rows": _sparse_rows,
    "dense_rows": _dense_rows,
    # itemsets
    "transactions": lambda spark, folder: _joined(itemsets.with_label_item(_baskets(spark, folder)), "items"),
    "itemsets": lambda spark, folder: _joined(_itemsets(spark, folder), "items"),
    "itemset_lines": lambda spark, folder: itemsets.itemset_lines(_itemsets(spark, folder)),
    "itemset_preview": lambda spark, folder: itemsets.preview(_itemsets(spark, folder)),
    "itemset_trip_types": lambda spark, folder: itemsets.trip_types(_itemsets(spark, folder)),
    "itemset_match": _match,
    "itemset_match_counts": lambda spark, folder: profile.value_counts(_match(spark, folder), "item_set"),
    # clusters, training and test sets
    "department_vectors": _department_vectors,
    "visit_clusters": _visit_clusters,
    "cluster_centres": _cluster_centres,
    "nearest_centre": _nearest_to(_centres),
    "nearest_frozen_centre": _nearest_to(_frozen),
    "split_train": _part_of("train"),
    "split_test": _part_of("test"),
    "shuffled_train": _shuffled_train,
    "train_matrix": _matrix_of("train"),
    "labelled_matrix": _labelled_matrix,
    # through files and back
    "scans_by_csv": _scans_by_csv,
    "rejected_by_csv": _rejected_by_csv,
    "itemsets_by_lines": _itemsets_by_lines,
    "labels_by_csv": _by_csv(
        _on("visit_number trip_type", features.extract_labels, part="train"), "visit_number bigint, trip_type int"
    ),
    "test_ids_by_csv": _by_csv(
        _on("visit_number", lambda r: r.select("visit_number").distinct(), part="test"), "visit_number bigint"
    ),
    "test_matrix": _matrix_of("test"),
}
