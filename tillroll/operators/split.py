"""Splitting rows by visit membership and putting visits in a random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import shuffle_key


def of_visits(rows: DataFrame, scans: DataFrame) -> DataFrame:
    """The rows whose visit occurs in ``scans``.

    The ids grow with the data, so nothing is broadcast by hint; they are made distinct
    first, which takes a hot visit out of the join.
    """
    return rows.join(scans.select("visit_number").distinct(), "visit_number", "left_semi")


def shuffled(visits: DataFrame, seed: int = 0) -> DataFrame:
    """The rows in a reproducible random order, whatever their order was.

    The order is a property of visit and seed, kept as ``shuffle_key``: a range-partitioned
    sort over evenly spread keys.
    """
    keyed = visits.withColumn("shuffle_key", shuffle_key(F.col("visit_number"), seed))
    return keyed.orderBy("shuffle_key", "visit_number")
