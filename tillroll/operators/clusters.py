"""Clusters of visits by what they bought per department."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.constants import N_CLUSTERS
from tillroll.operators.features import spread_sums
from tillroll.session import checkpoint, setting


def department_vectors(purchases: DataFrame, departments: Sequence[str]) -> DataFrame:
    """(visit_number, vector): unscaled purchase sums in the order of ``departments``.

    Departments a visit did not buy are 0, also those that never occur; ones outside the
    list are left out. A vector is sparse where that is smaller.
    """
    # Columns named by place, as a name may be no good as a column.
    names = [str(place) for place in range(1, len(departments) + 1)]
    cells = spread_sums(purchases, "department", departments, names)
    return VectorAssembler(inputCols=names, outputCol="vector").transform(cells).select("visit_number", "vector")


def points(purchases: DataFrame, departments: Sequence[str]) -> DataFrame:
    """The vectors, materialised once in a fixed order.

    A fit passes over them many times, and a lost executor must not change its start. A column per
    department makes one method of generated code so long that the JVM only interprets it; beyond its
    limit for compiling, the cells are made by smaller methods.
    """
    rows = department_vectors(purchases, departments).sortWithinPartitions("visit_number")
    with setting(rows.sparkSession, "spark.sql.codegen.hugeMethodLimit", "8000"):
        return checkpoint(rows)


def train_clusters(vectors: DataFrame, k: int = N_CLUSTERS, seed: int = 0) -> KMeansModel:
    """Fit k-means.

    The vectors are materialised as they are given: the fit reads each partition twice side by side in one
    task, vectors and their norms, and two readings of one sort-merge join end each other's sorts.
    """
    return KMeans(featuresCol="vector", predictionCol="cluster", k=k, seed=seed).fit(checkpoint(vectors.select("vector")))


def assign_clusters(model: KMeansModel, vectors: DataFrame) -> DataFrame:
    """(visit_number, cluster)."""
    return model.transform(vectors).select("visit_number", "cluster")
