"""Contingency tables: long and wide, the winner per column, histograms of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.profile import grouped_histogram
from tillroll.session import checkpoint


def crosstab(rows: DataFrame, index: str, column: str) -> DataFrame:
    """(index, column, n) for pairs that occur; rows missing either side are left out."""
    paired = rows.where(F.col(index).isNotNull() & F.col(column).isNotNull())
    return paired.groupBy(index, column).agg(F.count("*").alias("n"))


def wide_crosstab(rows: DataFrame, index: str, column: str, values: Sequence[str]) -> DataFrame:
    """One row per index value, one count column per given value, 0 where a pair is absent."""
    return _spread_out(crosstab(rows, index, column), index, column, values)


def _spread_out(pairs: DataFrame, index: str, column: str, values: Sequence[str]) -> DataFrame:
    cells = pairs.groupBy(index).pivot(column, list(values)).sum("n")
    return cells.fillna(0, subset=list(values))


def top_per_column(rows: DataFrame, index: str, column: str) -> DataFrame:
    """For each value of ``column`` the most frequent ``index`` value; ties go to the smallest.

    The winner is a plain minimum, so it combines before the shuffle and no task sorts
    all candidates of a hot column.
    """
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col(index).alias("label")))
    return (
        crosstab(rows, index, column)
        .groupBy(column)
        .agg(best.alias("best"))
        .select(column, F.col("best.label").alias(index), (-F.col("best.rank")).alias("n"))
    )


def cell_histogram(
    rows: DataFrame, index: str, column: str, values: Sequence[str], bins: int = 10
) -> DataFrame:
    """Per crosstab column, the distribution of its cells, zero cells included.

    Columns that never occur have no cells.
    """
    pairs = checkpoint(crosstab(rows, index, column))  # a cell each: all that follows reads these
    cells = _spread_out(pairs, index, column, values).unpivot([index], list(values), column, "cell")
    occurring = pairs.select(column).distinct()
    return grouped_histogram(checkpoint(cells.join(occurring, column, "left_semi")), column, "cell", bins)
