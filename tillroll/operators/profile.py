"""Profiling: counts, nulls, distinct values, exact summary statistics, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import bin_edge, equal_width_bin, quoted
from tillroll.operators.ordering import running_total
from tillroll.session import checkpoint

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def distinct_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_values): distinct values per column, null counting as one value."""
    counted = rows.agg(
        *[(F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns]
    )
    return counted.unpivot([], columns, "column_name", "n_values")


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_nulls), from one pass."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "n_nulls")


def null_overlap(rows: DataFrame) -> DataFrame:
    """How often fields are missing together, or one without the other."""
    department, fineline, upc = F.col("department"), F.col("fineline"), F.col("upc")
    return rows.agg(
        F.count_if(department.isNull() & upc.isNull()).alias("department_and_upc_null"),
        F.count_if(department.isNull() & fineline.isNotNull()).alias("department_null_fineline_set"),
        F.count_if(fineline.isNull() & upc.isNotNull()).alias("fineline_null_upc_set"),
    )


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """(column, n), most frequent first; nulls are not counted."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def values_where_missing(rows: DataFrame, column: str, missing: str) -> DataFrame:
    """Value counts of ``column`` over rows that lack ``missing`` but have a department."""
    return value_counts(rows.where(F.col(missing).isNull() & F.col("department").isNotNull()), column)


def listed_values(rows: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values in quotes; null is listed as ``nan``."""
    return rows.select(column).distinct().select(quoted(F.col(column)).alias(column)).orderBy(column)


def filled_values(rows: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values; null is listed as the empty string."""
    return rows.select(F.coalesce(column, F.lit("")).alias(column)).distinct().orderBy(column)


def _frequencies(rows: DataFrame, column: str) -> DataFrame:
    # Read several times by its users: one pass over the rows makes it.
    present = rows.where(F.col(column).isNotNull())
    return checkpoint(present.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")))


def describe(rows: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample deviation, minimum, exact quartiles, maximum.

    Works on value frequencies, which hot values shrink. Quartiles interpolate
    between the two neighbouring ranks, found through exact running totals.
    """
    frequencies = _frequencies(rows, column)
    n, value = F.col("n"), F.col("value")
    total = frequencies.agg(F.sum("n")).scalar()
    mean = frequencies.agg(F.sum(value * n) / F.sum("n")).scalar()
    ranked = running_total(frequencies, value, n).select(
        "value", "n", "before", total.alias("total"), mean.alias("mean")
    )

    def at_rank(rank):
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + n), value))

    def quantile(p):
        position = (F.col("total") - 1) * F.lit(p)
        below = at_rank(F.floor(position))
        above = at_rank(F.ceil(position))
        return below + (above - below) * F.max(position - F.floor(position))

    deviation = value - F.col("mean")
    return ranked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.max("mean").alias("mean"),
        F.sqrt(F.sum(n * deviation * deviation) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"),
        F.min("value").alias("min_value"),
        *[quantile(p).alias(name) for name, p in QUARTILES.items()],
        F.max("value").alias("max_value"),
    )


def histogram(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) for ``bins`` equal-width bins over the value range, empty ones too."""
    frequencies = _frequencies(rows, column)
    bounds = frequencies.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    counts = (
        frequencies.select("n", equal_width_bin(F.col("value"), lo, hi, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    return _all_bins(bounds.where("lo is not null"), [], bins).join(counts, "bin", "left").select(
        "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def _all_bins(bounds: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    lo, hi = F.col("lo"), F.col("hi")
    every = bounds.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return every.select(
        *keys,
        "bin",
        bin_edge(F.col("bin") - 1, lo, hi, bins).alias("low"),
        bin_edge(F.col("bin"), lo, hi, bins).alias("high"),
    )


def grouped_histogram(cells: DataFrame, key: str, value: str, bins: int) -> DataFrame:
    """The same bins per ``key``, each over its own value range."""
    bounds = cells.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    counts = (
        cells.join(bounds, key)
        .select(key, equal_width_bin(F.col(value), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .groupBy(key, "bin")
        .agg(F.count("*").alias("n"))
    )
    return _all_bins(bounds, [key], bins).join(counts, [key, "bin"], "left").select(
        key, "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )
