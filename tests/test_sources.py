from __future__ import annotations

import pytest
from fixture import SCHEMA, TEST, TRAIN, rows
from pyspark.sql import functions as F

from tillroll.operators import split
from tillroll.sources import scanlog, star

FOLDER = "/root/testdata/sf0.001"

LABELLED = """TripType,VisitNumber,Weekday,Upc,ScanCount,DepartmentDescription,FinelineNumber
3,1,Monday,4011,2,PRODUCE,5501
3,1,Monday,999.0,-1,"CANDY, TOBACCO, COOKIES",10.0
8,3,Sunday,NULL,-1,NULL,NULL
8,3,Sunday,,1,,
999,4,Friday,775014200016,1,TOYS,0
"""

REORDERED = """VisitNumber,ScanCount,Upc,Weekday,FinelineNumber,DepartmentDescription
5,3,4011,Monday,5501,PRODUCE
"""


def test_read_labelled_csv(spark, tmp_path):
    (tmp_path / "train.csv").write_text(LABELLED)
    log = scanlog.read_scans(spark, str(tmp_path / "train.csv"))
    assert dict(log.dtypes) == {name: kind for name, (_, kind) in scanlog.SCAN_COLUMNS.items()}
    assert scanlog.has_labels(log)
    assert rows(log) == sorted(
        [
            (1, 3, "Monday", 4011, 2, "PRODUCE", 5501),
            (1, 3, "Monday", 999, -1, "CANDY, TOBACCO, COOKIES", 10),
            (3, 8, "Sunday", None, -1, None, None),
            (3, 8, "Sunday", None, 1, None, None),
            (4, 999, "Friday", 775014200016, 1, "TOYS", 0),
        ],
        key=repr,
    )


def test_read_unlabelled_csv_by_name(spark, tmp_path):
    (tmp_path / "test.csv").write_text(REORDERED)
    log = scanlog.read_scans(spark, str(tmp_path / "test.csv"))
    assert not scanlog.has_labels(log)
    assert rows(log, "visit_number", "upc", "scan_count", "fineline") == [(5, 4011, 3, 5501)]
    assert rows(scanlog.with_label(log), "trip_type") == [(None,)]


MALFORMED = LABELLED + """3,5,Monday,4011,two,PRODUCE,5501
3,6,Monday,4011,2
3,7,Monday,4011,2,PRODUCE,5501,more,fields
3,8,Monday,12345678901234567890123,2,PRODUCE,5501
"""


def test_malformed_lines_are_rejected_or_fail(spark, tmp_path):
    (tmp_path / "train.csv").write_text(MALFORMED)
    (tmp_path / "good.csv").write_text(LABELLED)
    path = str(tmp_path / "train.csv")
    kept = scanlog.read_scans(spark, path, malformed="drop")
    assert rows(kept) == rows(scanlog.read_scans(spark, str(tmp_path / "good.csv")))
    assert kept.count() == kept.select("upc").count() == 5
    found = sorted(rows(scanlog.rejected_lines(spark, path)))
    assert [reason for _, reason in found] == ["ScanCount", "fields", "fields", "Upc"]
    assert found[1][0] == "3,6,Monday,4011,2" and found[2][0].endswith("more,fields")
    assert scanlog.rejected_lines(spark, str(tmp_path / "good.csv")).count() == 0
    for columns in (["visit_number"], scanlog.SCAN_COLUMNS):
        with pytest.raises(Exception, match="malformed"):
            scanlog.read_scans(spark, path).select(*columns).collect()
    with pytest.raises(ValueError, match="fail or drop"):
        scanlog.read_scans(spark, path, malformed="skip")


def test_union_leaves_unknown_labels_null(both):
    assert rows(both) == sorted(TRAIN + TEST, key=repr)


def test_sample_takes_whole_visits(train):
    assert {r[0] for r in rows(scanlog.sample_visits(train, 2))} == {1, 2}
    assert scanlog.sample_visits(train, 2).count() == 6
    assert scanlog.sample_visits(train, 100).count() == len(TRAIN)


def test_one_visit(train):
    assert rows(scanlog.one_visit(train, 2)) == sorted([r for r in TRAIN if r[0] == 2], key=repr)


def test_split_by_membership(both, train, test_log):
    assert rows(split.of_visits(both, train)) == sorted(TRAIN, key=repr)
    assert rows(split.of_visits(both, test_log)) == sorted(TEST, key=repr)


def test_shuffle_is_a_reproducible_permutation(spark):
    visits = spark.range(500).withColumnRenamed("id", "visit_number")
    order = [r.visit_number for r in split.shuffled(visits, 1).collect()]
    again = [r.visit_number for r in split.shuffled(visits.repartition(3), 1).collect()]
    other = [r.visit_number for r in split.shuffled(visits, 2).collect()]
    assert order == again
    assert sorted(order) == list(range(500))
    assert order != sorted(order) and order != other


def test_star_projections_agree_with_the_full_view(spark):
    from tillroll.sources import star

    folder = "/root/testdata/sf0.001"
    full = star.scans(spark, folder)
    for columns in (["scan_count", "upc"], ["department"], ["trip_type", "weekday"], ["fineline", "trip_type"]):
        assert rows(star.scans(spark, folder, columns)) == rows(full, *[c for c in full.columns if c in columns])
    train, test = (star.scans(spark, folder, ["visit_number"], part) for part in ("train", "test"))
    assert train.count() + test.count() == full.count()
    assert train.join(test, "visit_number", "left_semi").isEmpty()


@pytest.mark.parametrize("columns", [["scan_count"], ["upc"]])
def test_star_reads_only_the_columns_it_needs(spark, columns):
    from tillroll.sources import star

    plan = star.scans(spark, "/root/testdata/sf0.001", columns)._jdf.queryExecution().toString()
    assert "Join" not in plan
    assert "l_extendedprice" not in plan.split("Physical Plan")[1]


def test_schema_of_the_fixture_is_the_canonical_one(train):
    assert train.columns == list(scanlog.SCAN_COLUMNS)
    assert SCHEMA == ", ".join(f"{n} {k}" for n, (_, k) in scanlog.SCAN_COLUMNS.items())
    assert train.select(F.count("*")).first()[0] == len(TRAIN)


def test_spread_is_asked_for(spark):
    from tillroll.session import spread

    few = spark.range(100, numPartitions=1)
    assert spread(few, 5, "id").select(F.spark_partition_id()).distinct().count() == 5
    assert spread(few, None, "id") is few
    assert rows(spread(few, 5, "id")) == rows(few)


def test_shuffles_are_sized_by_the_input(spark):
    from tillroll.session import prepare

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.unset("spark.sql.shuffle.partitions")
        prepare(spark, input_bytes=100 << 30)
        chosen = spark.conf.get(name, None)
    finally:
        spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert chosen in (None, str((100 << 30) // (64 << 20)))


def test_bounds_of_a_scan_log_size_no_other_shuffle(spark):
    """How many partitions a shuffle of known input starts with does not depend on a log read before."""
    from tillroll import session

    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {key: spark.conf.get(key, None) for key in (initial, session._ADVISORY, session._ADVISED)}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for own, wanted in ((None, 1600), ("32m", 3200)):
            for key in before:
                spark.conf.unset(key)
            spark.conf.unset("spark.sql.shuffle.partitions")
            if own is not None:
                spark.conf.set(session._ADVISORY, own)
            session.bound_tasks(spark, 1)
            assert spark.conf.get(session._ADVISORY) == (own or "16m")
            session.prepare(spark, input_bytes=100 << 30)
            assert spark.conf.get(initial) == str(wanted)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_constants(spark):
    from tillroll.session import constants

    assert rows(constants(spark, [(1, "a"), (2, "b")], "n", "name")) == [(1, "a"), (2, "b")]


def test_stored_by_visit_moves_no_rows(spark, both, train, categories):
    """Split, labels and matrix over stored logs: one exchange was when they were written."""
    from tillroll.operators import features, matrix, vocabulary
    from tillroll.plans.queries import labelled_rows
    from tillroll.session import checkpoint
    from tillroll.sources.visits import stored_by_visit

    upcs = vocabulary.top_terms(train, "upc", 2)
    terms = vocabulary.feature_terms(vocabulary.occurring_terms(both), categories, upcs)
    encoded = matrix.encoding(checkpoint(vocabulary.feature_dictionary(terms)), categories)
    stored, labelled = stored_by_visit(both, 4), stored_by_visit(train, 4)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = labelled_rows(stored, labelled, encoded)
        plans = [split.of_visits(stored, labelled), features.extract_labels(labelled), found]
        texts = [plan._jdf.queryExecution().executedPlan().toString() for plan in plans]
        assert not any("Exchange hashpartitioning" in text for text in texts)
        assert "SortMergeJoin" in texts[2] and "HashAggregate" in texts[2]
        got = rows(found, "visit_number", "trip_type", "indices", "values")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    plain = labelled_rows(both, train, encoded)
    assert got == rows(plain, "visit_number", "trip_type", "indices", "values")
    assert rows(stored) == rows(both)


def test_tasks_are_bounded_by_the_scan(spark, monkeypatch):
    """Shuffles start with partitions by the size of the log, also beyond the session's number; a session's own
    initial number stays."""
    from tillroll import session

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {key: spark.conf.get(key, None) for key in (name, session._SIZED)}
    size = session.stored_bytes(star.table(spark, FOLDER, "lineitem"))
    assert size > 8000
    monkeypatch.setattr(session, "_PER_SHUFFLE", 1000)
    try:
        for key in before:
            spark.conf.unset(key)
        star.scans(spark, FOLDER, ["visit_number"])
        assert spark.conf.get(name) == str(-(-size // 1000))
        spark.conf.set(name, "3")
        star.scans(spark, FOLDER, ["visit_number"])
        assert spark.conf.get(name) == "3"
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is not None
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["both_inputs", "dense_rows", "train_matrix", "test_matrix"])
def test_line_items_are_joined_once(spark, monkeypatch, name):
    from tillroll.plans.queries import QUERIES

    read, table = [], star.table
    monkeypatch.setattr(star, "table", lambda spark, folder, name: read.append(name) or table(spark, folder, name))
    QUERIES[name](spark, FOLDER)
    assert read.count("lineitem") == 1


def test_stored_log_equals_the_scans(spark):
    log = star.stored(spark, FOLDER)
    for part in ("train", "test"):
        assert rows(log.where(F.col("part") == part).drop("part")) == rows(star.scans(spark, FOLDER, part=part))
