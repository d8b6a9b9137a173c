from __future__ import annotations

import numpy as np
import pytest
from fixture import rows

from tillroll.operators import clusters, features, minibatch

SUMS = "visit_number bigint, department string, value bigint"
NAMES = ["A", "B", "C", "D"]


def sums(n: int, spread: int, seed: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = [(0, 0, 0, 0), (30, 0, 0, 4), (0, 30, 0, 0), (0, 0, 30, 9)]
    return [
        (visit, name, int(mean + rng.integers(0, spread)))
        for visit in range(n)
        for name, mean in zip(NAMES, centres[visit % 4])
    ]


def vectors_of(points) -> dict[int, list[int]]:
    return {r.visit_number: minibatch._dense(r.entries, len(NAMES)) for r in points.collect()}


def objective(vectors: dict[int, list[int]], centres: np.ndarray) -> float:
    each = np.array(list(vectors.values()), float)
    return float((((each[:, None, :] - centres[None]) ** 2).sum(axis=2)).min(axis=1).sum())


def test_entries_keep_every_visit(both):
    points = minibatch.department_entries(features.purchases(both), ["DAIRY", "PRODUCE", "SEASONAL"])
    assert rows(points, "visit_number", "entries") == [
        (1, ((0, 1), (1, 2))), (2, ((0, 2), (1, 1))), (3, ()), (4, ()), (5, ((1, 3),)), (6, ()), (7, ((0, 1), (1, 1))),
    ]


def test_nearest_centre_takes_the_smallest_of_ties(spark):
    centres = spark.createDataFrame([(2, [2000, 0], 1), (0, [0, 0], 1), (1, [2000, 0], 1)], minibatch._CENTRES)
    points = spark.createDataFrame(
        [(1, []), (2, [(0, 1)]), (3, [(0, 2)]), (4, [(0, 2), (1, -3)])],
        "visit_number bigint, entries array<struct<place:int,value:bigint>>",
    )
    found = rows(minibatch.nearest(points, centres), "visit_number", "cluster", "distance")
    assert found == [(1, 0, 0), (2, 0, 1_000_000), (3, 1, 0), (4, 1, 9_000_000)]
    none = minibatch.nearest(points, centres.where("cluster > 9"))
    assert {r.cluster for r in none.collect()} == {None}


def test_fit_against_plain_python(spark):
    """Batch by batch: nearest centre in whole numbers, centres as running means."""
    from pyspark.sql import functions as F

    from tillroll.functions.scalars import shuffle_key

    points = minibatch.department_entries(spark.createDataFrame(sums(90, 20), SUMS), NAMES)
    start = minibatch.first_centres(points, 3, 5, 4)
    fitted = minibatch.train(points, 4, 3, 5, 4, start)
    held, counts = [list(c) for c in start], [1] * 3
    keys = {r[0]: r[1] for r in points.select("visit_number", shuffle_key(F.col("visit_number"), 5)).collect()}
    vectors = vectors_of(points)
    for batch in range(4):
        centres = [[1000 * s // n for s in at] for at, n in zip(held, counts)]
        moved = []
        for visit in (v for v in vectors if keys[v] % 4 == batch):
            distance = [sum((1000 * x - c) ** 2 for x, c in zip(vectors[visit], at)) for at in centres]
            moved.append((distance.index(min(distance)), vectors[visit]))
        for cluster, vector in moved:
            held[cluster] = [s + x for s, x in zip(held[cluster], vector)]
            counts[cluster] += 1
    expected = [(j, tuple(1000 * s // n for s in at), n) for j, (at, n) in enumerate(zip(held, counts))]
    assert rows(fitted, "cluster", "centre", "n") == expected


def test_fit_does_not_depend_on_order_or_partitions(spark):
    points = minibatch.department_entries(spark.createDataFrame(sums(200, 9), SUMS), NAMES)
    fits = [
        rows(minibatch.train(frame, 4, 4, 3), "cluster", "centre", "n")
        for frame in (points.coalesce(1).orderBy("visit_number"), points.repartition(7, "entries"))
    ]
    assert fits[0] == fits[1] and len(fits[0]) == 4
    assert sum(n for _, _, n in fits[0]) == 200 + 4


@pytest.mark.parametrize("spread", [4, 25])
def test_objective_is_near_the_full_fit(spark, spread):
    purchases = spark.createDataFrame(sums(600, spread, seed=spread), SUMS)
    points = minibatch.department_entries(purchases, NAMES)
    vectors = vectors_of(points)
    full = clusters.train_clusters(clusters.points(purchases, NAMES), k=4)
    mine = minibatch.train(points, 4, 4, 1).orderBy("cluster").collect()
    small = objective(vectors, np.array([r.centre for r in mine]) / minibatch.SCALE)
    assert small <= 1.02 * objective(vectors, np.array(full.clusterCenters()))


def test_few_or_no_visits(spark):
    points = minibatch.department_entries(spark.createDataFrame(sums(2, 1), SUMS), NAMES)
    assert minibatch.train(points, 4, 8).count() == 2
    nothing = points.limit(0)
    assert minibatch.train(nothing, 4, 8).count() == 0
    assert minibatch.frozen(nothing, 3, 0, 4).count() == 0
