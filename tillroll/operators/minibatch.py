"""Mini-batch k-means over department sums, in whole numbers.

Centres are kept in thousandths and distances are whole, so assignments and fits are the same
whatever the order or partitioning of the rows, and can be checked against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import N_CLUSTERS
from tillroll.functions.scalars import shuffle_key
from tillroll.session import written

#: Units of a centre per unit of a sum.
SCALE = 1000
#: Batches that the training visits are dealt into by hash; a fit passes over each once.
BATCHES = 8
#: Distinct vectors from which well separated first centres are drawn.
SAMPLE = 4096

_CENTRES = "cluster int, centre array<bigint>, n bigint"


def department_entries(purchases: DataFrame, departments: Sequence[str]) -> DataFrame:
    """(visit_number, entries): the non-zero sums of a visit by place in ``departments``, from 0.

    Every visit is kept; departments outside the list are left out.
    """
    place = F.array_position(F.array(*map(F.lit, departments)), F.col("department")).cast("int") - 1
    used = (place >= 0) & (F.col("value") != 0)
    entry = F.when(used, F.struct(place.alias("place"), F.col("value").cast("bigint").alias("value")))
    return purchases.groupBy("visit_number").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def first_centres(points: DataFrame, k: int, seed: int, width: int) -> list[list[int]]:
    """The vectors of the visits that come first in the order of the seed; equal vectors count once."""
    return [vector for _, vector in _first(points, k, seed, width)]


def _first(points: DataFrame, k: int, seed: int, width: int) -> list[tuple[int, list[int]]]:
    keyed = points.groupBy("entries").agg(F.min(shuffle_key(F.col("visit_number"), seed)).alias("key"))
    chosen = keyed.orderBy("key").limit(k).collect()
    return [(r.key, _dense(r.entries, width)) for r in chosen]


def _dense(entries: list, width: int) -> list[int]:
    vector = [0] * width
    for place, value in entries:
        vector[place] = value
    return vector


def separated_centres(points: DataFrame, k: int, seed: int, width: int, sample: int = SAMPLE) -> list[list[int]]:
    """First centres far from each other, drawn from the ``sample`` distinct vectors that come
    first in the order of the seed: each next one with a chance by its squared distance from
    those before (k-means++), the best of a few tries.
    """
    drawn = np.array([vector for _, vector in _first(points, sample, seed, width)], float).reshape(-1, width)
    if len(drawn) <= k:
        return drawn.astype(int).tolist()
    random = np.random.default_rng(seed)
    chosen = [int(random.integers(len(drawn)))]
    nearest = ((drawn - drawn[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        tries = random.choice(len(drawn), size=2 + int(np.log(k)), p=nearest / nearest.sum())
        left = [np.minimum(nearest, ((drawn - drawn[t]) ** 2).sum(axis=1)) for t in tries]
        best = int(np.argmin([each.sum() for each in left]))
        chosen, nearest = [*chosen, int(tries[best])], left[best]
    return drawn[chosen].astype(int).tolist()


def as_table(spark: SparkSession, sums: Sequence[Sequence[int]], counts: Sequence[int]) -> DataFrame:
    """(cluster, centre, n): a row per cluster; ``centre`` is its mean in units of 1 / SCALE, rounded down."""
    rows = [(j, [SCALE * s // n for s in at], n) for j, (at, n) in enumerate(zip(sums, counts))]
    return spark.createDataFrame(rows, _CENTRES)


def frozen(points: DataFrame, k: int, seed: int, width: int) -> DataFrame:
    """The first centres of a seed as a table, each of one visit."""
    chosen = first_centres(points, k, seed, width)
    return as_table(points.sparkSession, chosen, [1] * len(chosen))


def nearest(points: DataFrame, centres: DataFrame) -> DataFrame:
    """(visit_number, entries, cluster, distance): the nearest centre of each visit, of equally
    near ones the smallest, and the squared distance in units of 1 / SCALE ** 2.

    ``centres`` holds a few rows, which reach the tasks as one value; a visit costs its entries
    times the clusters. Without centres the cluster is null.
    """
    squares = F.aggregate("centre", F.lit(0).cast("bigint"), lambda acc, c: acc + c * c)
    listed = F.sort_array(F.collect_list(F.struct("cluster", "centre", squares.alias("norm"))))
    given = centres.agg(listed.alias("centres")).scalar()

    def candidate(c):
        dot = F.aggregate(
            "entries", F.lit(0).cast("bigint"), lambda acc, e: acc + e["value"] * F.get(c["centre"], e["place"])
        )
        return F.struct((c["norm"] - 2 * SCALE * dot).alias("rest"), c["cluster"].alias("cluster"))

    own = F.aggregate("entries", F.lit(0).cast("bigint"), lambda acc, e: acc + e["value"] * e["value"])
    best = points.withColumn("_centres", given).withColumn("best", F.array_min(F.transform("_centres", candidate)))
    return best.select(
        "visit_number",
        "entries",
        F.col("best.cluster").alias("cluster"),
        (F.col("best.rest") + SCALE * SCALE * own).alias("distance"),
    )


def train(
    points: DataFrame,
    width: int,
    k: int = N_CLUSTERS,
    seed: int = 0,
    batches: int = BATCHES,
    start: Sequence[Sequence[int]] | None = None,
) -> DataFrame:
    """(cluster, centre, n): centres of ``points`` of ``width`` departments, by mini-batches.

    Visits are dealt into ``batches`` by hash, written by batch once, and each batch is read once:
    its visits go to their nearest centres, and a centre moves to the mean of all visits it has had,
    so its rate falls as its count grows. A batch sends one sum per cluster and department to the
    driver, which keeps those sums and counts only. The same visits and seed give the same centres.
    ``start`` gives the first centres, else :func:`separated_centres` draws them. Of fewer distinct
    vectors than ``k`` there are as many clusters as vectors.
    """
    spark = points.sparkSession
    key = shuffle_key(F.col("visit_number"), seed)
    dealt = written(points.withColumn("batch", F.pmod(key, F.lit(batches)).cast("int")), "batch")
    start = separated_centres(dealt, k, seed, width) if start is None else start
    sums, counts = [[int(s) for s in at] for at in start], [1] * len(start)
    for batch in range(batches if start else 0):
        rows = nearest(dealt.where(F.col("batch") == batch), as_table(spark, sums, counts))
        counted = F.array(F.struct(F.lit(-1).alias("place"), F.lit(1).cast("bigint").alias("value")))
        moved = rows.select("cluster", F.inline(F.concat(counted, F.col("entries"))))
        for cluster, place, value in moved.groupBy("cluster", "place").agg(F.sum("value")).collect():
            if place < 0:
                counts[cluster] += value
            else:
                sums[cluster][place] += value
    return as_table(spark, sums, counts)
