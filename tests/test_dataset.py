from __future__ import annotations

import csv
import glob
import gzip

import pytest
from fixture import rows

from tillroll.plans import dataset


@pytest.fixture(scope="module")
def built(train, test_log, categories, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("dataset"))
    dataset.build(
        train, test_log, out, categories, ignored=[8], min_support=0.5, top_upcs=2, n_clusters=2
    )
    return out


def read_csv(pattern, opener=open):
    """Header and rows of the part files in order."""
    header, found = None, []
    for path in sorted(glob.glob(pattern)):
        with opener(path, "rt", newline="") as file:
            header, *part = list(csv.reader(file))
            found += part
    return header, found


def test_dictionary_heads_the_dense_files(built):
    _, dictionary = read_csv(f"{built}/features/*.csv")
    names = [name for _, _, name in dictionary]
    assert names[-2:] == ["ItemSet", "Dept_Category"]
    for part in ("train", "test"):
        header, _ = read_csv(f"{built}/{part}/*.csv.gz", gzip.open)
        assert header == names


def test_dense_and_sparse_agree(spark, built):
    for part, n in (("train", 5), ("test", 2)):
        header, lines = read_csv(f"{built}/{part}/*.csv.gz", gzip.open)
        matrix = spark.read.parquet(f"{built}/{part}_matrix").collect()
        packed = []
        for r in matrix:
            full = [0] * len(header)
            for i, v in zip(r.indices, r["values"]):
                full[i] = v
            packed.append([str(v) for v in full])
        assert len(lines) == n
        assert sorted(lines) == sorted(packed)


def test_labels_and_ids_follow_the_rows(spark, built):
    for part, ids in (("train", "labels"), ("test", "test_ids")):
        header, lines = read_csv(f"{built}/{part}/*.csv.gz", gzip.open)
        _, listed = read_csv(f"{built}/{ids}/*.csv")
        visits = [int(row[0]) for row in listed]
        matrix = {r.visit_number: r for r in spark.read.parquet(f"{built}/{part}_matrix").collect()}
        for visit, line in zip(visits, lines, strict=True):
            packed = {i: str(v) for i, v in zip(matrix[visit].indices, matrix[visit]["values"])}
            assert {i: v for i, v in enumerate(line) if v != "0"} == packed
    _, labels = read_csv(f"{built}/labels/*.csv")
    assert sorted((int(v), int(t)) for v, t in labels) == [(1, 3), (2, 3), (3, 8), (4, 5), (6, 3)]


def test_item_sets_are_fitted_on_train_and_matched_on_both(spark, built):
    assert rows(spark.read.text(f"{built}/itemsets")) == [("3;DAIRY;PRODUCE",)]
    header, _ = read_csv(f"{built}/train/*.csv.gz", gzip.open)
    column = header.index("ItemSet")
    found = {}
    for part in ("train", "test"):
        for r in spark.read.parquet(f"{built}/{part}_matrix").collect():
            found[r.visit_number] = dict(zip(r.indices, r["values"])).get(column, 0)
    assert found == {1: 3, 2: 3, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}


def test_visit_features_hold_every_visit(spark, built):
    features = spark.read.parquet(f"{built}/visit_features")
    assert rows(features.select("visit_number").distinct()) == [(v,) for v in range(1, 8)]


def test_names_with_commas_are_quoted_in_the_header(spark, tmp_path):
    from tillroll.sources import sinks

    dictionary = spark.createDataFrame(
        [(0, 1, "CANDY, TOBACCO, COOKIES"), (1, 1, 'A "B"'), (2, 1, "MEAT - FRESH & FROZEN")],
        "idx bigint, family int, feature string",
    )
    sparse = spark.createDataFrame(
        [(1, [0, 2], [5, -3]), (2, [], [])], "visit_number bigint, indices array<bigint>, `values` array<bigint>"
    )
    sinks.write_dense(sparse.coalesce(1), dictionary, str(tmp_path / "dense"))
    header, lines = read_csv(str(tmp_path / "dense/*.csv.gz"), gzip.open)
    assert header == ["CANDY, TOBACCO, COOKIES", 'A "B"', "MEAT - FRESH & FROZEN"]
    assert sorted(lines) == [["0", "0", "0"], ["5", "0", "-3"]]


def test_later_logs_get_the_columns_of_the_first(spark, train, test_log, categories, tmp_path):
    fitted = dataset.build(train, test_log, str(tmp_path), categories, ignored=[8], min_support=0.5, top_upcs=2, n_clusters=2)
    width = fitted.dictionary.count()
    again = {r.visit_number: r for r in dataset.apply(test_log, fitted).collect()}
    first = {r.visit_number: r for r in spark.read.parquet(f"{tmp_path}/test_matrix").collect()}
    assert {v: (r.indices, r["values"]) for v, r in again.items()} == {v: (r.indices, r["values"]) for v, r in first.items()}
    new = test_log.replace("ACCESSORIES", "UNHEARD OF", "department")
    assert all(max(r.indices) < width for r in dataset.apply(new, fitted).collect())
    # Frozen vocabularies are taken as they are.
    frozen = dataset.build(
        train, test_log, str(tmp_path / "again"), categories, ignored=[8], min_support=0.5, n_clusters=2,
        departments=["DAIRY", "PRODUCE"], upcs=fitted.upcs.limit(1), dictionary=fitted.dictionary,
    )
    assert rows(frozen.dictionary) == rows(fitted.dictionary) and list(frozen.departments) == ["DAIRY", "PRODUCE"]


def test_a_saved_fit_serves_another_session(spark, built, test_log):
    other = spark.newSession()
    loaded = dataset.Fitted.load(other, f"{built}/fitted")
    log = other.createDataFrame([tuple(r) for r in test_log.collect()], test_log.schema)
    expected = spark.read.parquet(f"{built}/test_matrix")
    columns = ["visit_number", "indices", "values"]
    assert rows(dataset.apply(log, loaded), *columns) == rows(expected, *columns)
    assert loaded.departments == ["DAIRY", "PHARMACY RX", "PRODUCE", "TOYS"]


def test_a_damaged_fit_is_not_loaded(spark, built, tmp_path):
    fitted = dataset.Fitted.load(spark, f"{built}/fitted")
    fitted.save(str(tmp_path / "copy"))
    copy = dataset.Fitted.load(spark, str(tmp_path / "copy"))
    assert rows(copy.dictionary) == rows(fitted.dictionary)
    fitted.upcs.selectExpr("cast(upc as string) as upc").write.mode("overwrite").parquet(str(tmp_path / "copy/upcs"))
    with pytest.raises(ValueError, match="upcs has upc string"):
        dataset.Fitted.load(spark, str(tmp_path / "copy"))
    about = '{"version": 0}'
    spark.createDataFrame([(about,)], "value string").write.mode("overwrite").text(str(tmp_path / "copy/about"))
    with pytest.raises(ValueError, match="version 0"):
        dataset.Fitted.load(spark, str(tmp_path / "copy"))


def test_a_build_leaves_only_its_files(spark, train, test_log, categories, tmp_path, monkeypatch):
    from tillroll import session

    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    with session.scoped(spark) as folder:
        inner = session.written(session.checkpoint(spark.range(5)))
        assert inner.count() == 5 and glob.glob(f"{folder.removeprefix('file:')}/*")
    monkeypatch.setattr(dataset.sinks, "write_itemsets", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        dataset.build(train, test_log, str(tmp_path / "out"), categories, ignored=[8], min_support=0.5, top_upcs=2)
    spark.sparkContext.setCheckpointDir(before or str(tmp_path / "after"))
    assert not [f for f in glob.glob(f"{tmp_path}/shared/**/*", recursive=True) if "scope-" in f]


def test_from_csv_to_files(spark, tmp_path):
    """The order tables as CSV, through every file, against the registered queries."""
    from tillroll.operators import features
    from tillroll.plans import queries
    from tillroll.sources import scanlog, star

    folder = "/root/testdata/sf0.001"
    headers = {name: header for name, (header, _) in scanlog.SCAN_COLUMNS.items()}
    for part, columns in (("train", queries.ALL_COLUMNS), ("test", queries.FEATURE_COLUMNS)):
        log = star.scans(spark, folder, columns, part).withColumnsRenamed(headers)
        log.write.option("header", True).csv(f"{tmp_path}/in/{part}.csv")
    out = f"{tmp_path}/out"
    fitted = dataset.run(spark, f"{tmp_path}/in", out, star.categories(spark, folder), ignored=queries.IGNORED, n_clusters=3)
    names = {r.idx: r.feature for r in fitted.dictionary.collect()}
    for part in ("train", "test"):
        expected = queries.QUERIES[f"{part}_matrix"](spark, folder)
        terms = [r.feature for r in queries._dictionary(spark, folder, fitted=features.FITTED_FEATURES).orderBy("idx").collect()]
        want = {
            r.visit_number: {terms[int(i)]: int(v) for i, v in zip(r.indices.split(";"), r["values"].split(";")) if i}
            for r in expected.collect()
        }
        for visit in want.values():  # these are over three clusters, not eight
            visit.pop("Dept_Category", None)
        found = {
            r.visit_number: {names[i]: v for i, v in zip(r.indices, r["values"]) if names[i] != "Dept_Category"}
            for r in spark.read.parquet(f"{out}/{part}_matrix").collect()
        }
        assert found == want
    assert rows(spark.read.text(f"{out}/itemsets")) == rows(queries.QUERIES["itemset_lines"](spark, folder))
    _, labels = read_csv(f"{out}/labels/*.csv")
    assert sorted((int(v), int(t)) for v, t in labels) == sorted(rows(queries.QUERIES["trip_labels"](spark, folder)))


def test_mini_takes_whole_visits(spark, train, test_log, tmp_path, monkeypatch):
    from tillroll.sources import scanlog

    headers = {name: header for name, (header, _) in scanlog.SCAN_COLUMNS.items()}
    for part, log in (("train", train), ("test", test_log)):
        log.withColumnsRenamed(headers).write.option("header", True).csv(f"{tmp_path}/{part}.csv")
    monkeypatch.setattr(dataset, "SAMPLE_VISITS", 1)
    monkeypatch.setattr(dataset, "build", lambda first, second, *_: (first.count(), second.count()))
    assert dataset.run(spark, str(tmp_path), "out", None, mini=True) == (3, 1)
    assert dataset.run(spark, str(tmp_path), "out", None) == (9, 4)
