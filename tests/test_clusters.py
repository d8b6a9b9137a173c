from __future__ import annotations

import numpy as np
import pytest
from fixture import rows

from tillroll.operators import clusters, features, split


def test_vectors_hold_purchases_in_order(both):
    vectors = clusters.department_vectors(features.purchases(both), ["DAIRY", "PRODUCE", "SEASONAL"])
    found = {r.visit_number: list(r.vector.toArray()) for r in vectors.collect()}
    assert found == {
        1: [1, 2, 0], 2: [2, 1, 0], 3: [0, 0, 0], 4: [0, 0, 0], 5: [0, 3, 0], 6: [0, 0, 0], 7: [1, 1, 0],
    }


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(0)
    centres = [(0, 0, 0), (40, 0, 0), (0, 40, 0), (0, 0, 40)]
    sums = []
    for visit in range(200):
        for name, mean in zip("ABC", centres[visit % 4]):
            sums.append((visit, name, int(mean + rng.integers(0, 4))))
    purchases = spark.createDataFrame(sums, "visit_number bigint, department string, value bigint")
    vectors = clusters.points(purchases, ["A", "B", "C"])
    return vectors, clusters.train_clusters(vectors, k=4)


def test_separate_groups_are_found(clustered):
    vectors, model = clustered
    assigned = dict(rows(clusters.assign_clusters(model, vectors)))
    assert len(assigned) == 200
    by_group = [{assigned[v] for v in range(g, 200, 4)} for g in range(4)]
    assert all(len(found) == 1 for found in by_group)
    assert len(set.union(*by_group)) == 4


def test_each_visit_gets_its_nearest_centre(clustered):
    vectors, model = clustered
    centres = np.array(model.clusterCenters())
    assigned = dict(rows(clusters.assign_clusters(model, vectors)))
    for r in vectors.collect():
        distances = ((centres - r.vector.toArray()) ** 2).sum(axis=1)
        assert distances[assigned[r.visit_number]] == pytest.approx(distances.min())


def test_fit_is_reproducible(clustered):
    vectors, model = clustered
    again = clusters.train_clusters(vectors, k=4)
    assert np.array_equal(model.clusterCenters(), again.clusterCenters())


def test_vectors_of_a_join_are_fitted(spark, clustered):
    """The training vectors come of sort-merge joins where tables are large; a fit reads them twice in a task."""
    vectors, _ = clustered
    lines = spark.range(800).selectExpr("id % 200 as visit_number")
    orders = spark.range(200).selectExpr("id as order")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        train = split.of_visits(vectors, lines.join(orders, lines.visit_number == orders.order))
        assert "SortMergeJoin" in train._jdf.queryExecution().executedPlan().toString()
        model = clusters.train_clusters(train, k=4)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assigned = dict(rows(clusters.assign_clusters(model, vectors)))
    by_group = [{assigned[v] for v in range(g, 200, 4)} for g in range(4)]
    assert all(len(found) == 1 for found in by_group) and len(set.union(*by_group)) == 4


def test_cells_are_made_by_methods_that_are_compiled(spark, monkeypatch):
    """Vectors are stored under the JVM's limit for compiling a method; a session's own limit stays."""
    key, seen, stored = "spark.sql.codegen.hugeMethodLimit", [], clusters.checkpoint
    monkeypatch.setattr(clusters, "checkpoint", lambda made: seen.append(spark.conf.get(key, None)) or stored(made))
    names = [f"d{n}" for n in range(64)]
    sums = [(visit, names[visit % 64], visit) for visit in range(200)] + [(None, "d1", 5), (1, "x", 2), (2, "d2", None)]
    purchases = spark.createDataFrame(sums, "visit_number bigint, department string, value bigint")
    plain = clusters.department_vectors(purchases, names)
    assert rows(clusters.points(purchases, names)) == rows(plain)
    spark.conf.set(key, "9000")
    try:
        clusters.points(purchases, names)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.unset(key)
    assert seen == ["8000", "9000"] and spark.conf.get(key, None) is None
