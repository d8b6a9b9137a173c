"""Fitted vocabularies: most frequent terms, department lists, the feature dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import RETAIL_CATEGORIES
from tillroll.functions.scalars import fineline_feature, signed_department, upc_feature
from tillroll.operators.features import (
    CATEGORY,
    FINELINE,
    FITTED,
    FITTED_FEATURES,
    PURCHASED,
    RETURNED,
    UPC,
    VISIT,
    VISIT_FEATURES,
)
from tillroll.operators.ordering import running_total
from tillroll.session import checkpoint, constants

def top_terms(rows: DataFrame, column: str, k: int) -> DataFrame:
    """(column, n): the ``k`` most frequent values; ties go to the smallest value."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


#: Values that a column may have where each becomes a column or a place in a vector.
MAX_TERMS = 100_000


def column_terms(rows: DataFrame, column: str, most: int = MAX_TERMS) -> list[str]:
    """The sorted distinct values of a column whose values become columns.

    For fitting such a vocabulary once; pivots and vectors take it as an argument. More
    than ``most`` values are an error, before they reach the driver.
    """
    terms = rows.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(terms) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(row[0] for row in terms)


def retail_categories(spark: SparkSession) -> DataFrame:
    """(department, category) for the retail departments."""
    pairs = [(d, c) for c, departments in RETAIL_CATEGORIES.items() for d in departments]
    return constants(spark, pairs, "department", "category")


def occurring_terms(scans: DataFrame) -> DataFrame:
    """(family, feature): the signed departments and the finelines of a scan log."""
    per_line = F.array(
        F.struct(
            F.when(F.col("scan_count") < 0, RETURNED).otherwise(PURCHASED).alias("family"),
            signed_department(F.col("department"), F.col("scan_count")).alias("feature"),
        ),
        F.struct(
            F.lit(FINELINE).alias("family"), fineline_feature(F.col("fineline")).alias("feature")
        ),
    )
    return scans.select(F.inline(per_line)).where(F.col("feature").isNotNull()).distinct()


def feature_terms(
    occurring: DataFrame, categories: DataFrame, upcs: DataFrame, fitted: Sequence[str] = ()
) -> DataFrame:
    """(family, feature): ``occurring`` terms and those of the fitted vocabularies.

    UPCs, visit features and the categories with their return side are always there, and
    so are ``fitted`` names.
    """
    names = upcs.select(F.lit(UPC).alias("family"), upc_feature(F.col("upc")).alias("feature"))
    signs = F.explode(F.array(F.col("category"), F.concat(F.lit("-"), F.col("category"))))
    grouped = categories.select("category").distinct()
    given = [(VISIT, name) for name in VISIT_FEATURES] + [(FITTED, name) for name in fitted]
    return (
        occurring.unionAll(names)
        .unionAll(grouped.select(F.lit(CATEGORY).alias("family"), signs.alias("feature")))
        .unionAll(constants(occurring.sparkSession, given, "family", "feature"))
    )


def feature_dictionary(terms: DataFrame) -> DataFrame:
    """(idx, family, feature): a dense index over distinct (family, feature) terms.

    A name may be in several families, as of a department and a category; each has its index.

    Order: departments by name (returned ones first), finelines and UPCs by number,
    visit features, categories by name (return side last), fitted features.
    """
    family, feature = F.col("family"), F.col("feature")
    given = VISIT_FEATURES + FITTED_FEATURES
    rank = (
        F.when(family.isin(FINELINE, UPC), F.expr("cast(substring(feature, 5) as bigint)"))
        .when(family.isin(VISIT, FITTED), F.array_position(F.array(*map(F.lit, given)), feature))
        .when(family == CATEGORY, feature.startswith("-").cast("bigint"))
        .otherwise(F.lit(0))
    )
    ordered = running_total(checkpoint(terms), F.struct(family, rank, feature), F.lit(1).cast("bigint"))
    return ordered.select(F.col("before").alias("idx"), "family", "feature")
