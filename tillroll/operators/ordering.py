"""Exact running totals over a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    rows: DataFrame, order: Column, amount: Column, buckets: int | None = None
) -> DataFrame:
    """Add ``before``: the sum of ``amount`` over all rows with a smaller ``order``.

    ``order`` must be unique. The order is cut into ranges at ``buckets - 1`` of its own
    values, the ones with the smallest hashes, so the ranges are even whatever the
    values are. Only one row per range is put in sequence; within a range the window
    runs in that range's task. By default there are as many ranges as cores, at least 64.
    The rows are read three times, so pass a checkpointed table.
    """
    buckets = buckets or max(64, rows.sparkSession.sparkContext.defaultParallelism)
    keyed = rows.withColumn("_order", order)
    cuts = (
        keyed.select("_order")
        .orderBy(F.xxhash64("_order"))
        .limit(buckets - 1)
        .agg(F.sort_array(F.collect_list("_order")).alias("cuts"))
    )
    # Two steps: among every sixteenth cut, then among the sixteen behind it.
    step = 16
    coarse = F.filter("_coarse", lambda cut: cut <= F.col("_order"))
    near = F.slice("_cuts", F.greatest(F.size(coarse) - 1, F.lit(0)) * step + 1, F.lit(step))
    reached = F.filter(near, lambda cut: cut <= F.col("_order"))
    passed = F.greatest(F.size(coarse) - 1, F.lit(0)) * step + F.size(reached)
    placed = (
        keyed.withColumn("_cuts", cuts.scalar())
        .withColumn("_coarse", F.filter("_cuts", lambda cut, n: n % step == 0))
        .withColumn("_range", passed)
        .withColumn("_amount", amount)
        .drop("_cuts", "_coarse")
    )

    sequence = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.sum("_amount").alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(sequence), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_range")  # at most `buckets` rows
        .withColumn("before", F.col("_offset") + F.col("_inside"))
        .drop("_range", "_order", "_amount", "_inside", "_offset")
    )
