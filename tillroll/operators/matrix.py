"""The feature matrix of a scan log over integer keys.

A line is encoded before anything is summed: small lookups made from the dictionary give the
indices it counts for, so the one large aggregation runs over (visit, index) and no feature
name is made, shuffled or joined.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import is_mon_to_fri, weekday_ordinal
from tillroll.operators.features import (
    CATEGORY,
    FINELINE,
    FITTED,
    FITTED_FEATURES,
    MON_TO_FRI,
    PURCHASED,
    RETURNED,
    RETURNS,
    UPC,
    VISIT,
    VISIT_FEATURES,
    WEEKDAY,
)
from tillroll.session import lookup, size_checked

# Stands for what is counted per visit and not per term; indices are 0 and up.
_OF_VISIT = -1


class Encoding(NamedTuple):
    """Lookups from the values of a line to indices of one dictionary.

    ``departments``: (department, bought, returned), the indices of the department and of its
    categories by sign. ``finelines`` and ``upcs``: value and index. ``named``: index by name of
    the visit and fitted features, a handful.
    """

    departments: DataFrame
    finelines: DataFrame
    upcs: DataFrame
    named: dict[str, int]


def encoding(dictionary: DataFrame, categories: DataFrame) -> Encoding:
    """Lookups of a materialised (idx, family, feature) table, each broadcast if its size allows."""
    family, feature = F.col("family"), F.col("feature")

    def numbers(kind: int, name: str, type_: str) -> DataFrame:
        value = F.substring(feature, 5, 20).cast(type_)
        return size_checked(dictionary.where(family == kind).select(value.alias(name), F.col("idx").alias(f"{name}_idx")))

    back = family == RETURNED
    own = dictionary.where(family.isin(RETURNED, PURCHASED)).select(
        F.when(back, F.expr("substring(feature, 2)")).otherwise(feature).alias("department"), back.alias("back"), "idx"
    )
    signs = F.array(
        F.struct(F.lit(False).alias("back"), F.col("category").alias("feature")),
        F.struct(F.lit(True).alias("back"), F.concat(F.lit("-"), F.col("category")).alias("feature")),
    )
    members = categories.select("department", "category").distinct().select("department", F.inline(signs))
    grouped = dictionary.where(family == CATEGORY).join(members, "feature").select("department", "back", "idx")
    departments = own.unionByName(grouped).groupBy("department").agg(
        F.collect_list(F.when(~F.col("back"), F.col("idx"))).alias("bought"),
        F.collect_list(F.when(F.col("back"), F.col("idx"))).alias("returned"),
    )
    fixed = dictionary.where(family.isin(VISIT, FITTED) & feature.isin(*VISIT_FEATURES, *FITTED_FEATURES))
    named = {name: idx for idx, name in fixed.select("idx", "feature").collect()}
    return Encoding(lookup(departments), numbers(FINELINE, "fineline", "int"), numbers(UPC, "upc", "bigint"), named)


def indexed_sums(scans: DataFrame, encoded: Encoding) -> DataFrame:
    """(visit_number, idx, value, weekday): sums of each visit by index, combined map-side.

    The row of index -1 holds the returned lines of a visit and its weekday; each visit has it.
    """
    lines = (
        scans.join(encoded.departments, "department", "left")
        .join(encoded.finelines, "fineline", "left")
        .join(encoded.upcs, "upc", "left")
    )
    back = F.col("scan_count") < 0
    of_department = F.when(back, F.col("returned")).otherwise(F.col("bought"))
    places = F.concat(
        F.coalesce(of_department, F.array().cast("array<bigint>")),
        F.array(F.col("fineline_idx"), F.col("upc_idx"), F.lit(_OF_VISIT).cast("bigint")),
    )
    each = lines.select("visit_number", "scan_count", "weekday", F.explode(places).alias("idx"))
    of_visit = F.col("idx") == _OF_VISIT
    return (
        each.where(F.col("idx").isNotNull())
        .groupBy("visit_number", "idx")
        .agg(
            F.sum(F.when(of_visit, back.cast("bigint")).otherwise(F.col("scan_count"))).alias("value"),
            F.min(F.when(of_visit, weekday_ordinal(F.col("weekday")))).alias("weekday"),
        )
    )


def fitted_values(values: DataFrame, column: str, idx: int) -> DataFrame:
    """A fitted value per visit as rows of :func:`indexed_sums`."""
    return values.select(
        "visit_number", F.lit(idx).cast("bigint").alias("idx"), F.col(column).cast("bigint").alias("value"),
        F.lit(None).cast("int").alias("weekday"),
    )


def matrix_rows(scans: DataFrame, encoded: Encoding, *fitted: tuple[DataFrame, str, str]) -> DataFrame:
    """(visit_number, indices, values): non-zero values per visit in index order.

    ``fitted`` gives (table, column, feature) of values per visit made elsewhere. What the
    dictionary lacks is left out; a visit with no entry keeps empty arrays. A visit's list has at
    most one entry per term of the dictionary.
    """
    sums = indexed_sums(scans, encoded)
    for values, column, feature in fitted:
        if feature in encoded.named:
            sums = sums.unionByName(fitted_values(values, column, encoded.named[feature]))
    of_visit, idx, value = F.col("idx") == _OF_VISIT, F.col("idx"), F.col("value")
    visits = sums.groupBy("visit_number").agg(
        F.collect_list(F.when(~of_visit & (value != 0), F.struct(idx, value))).alias("entries"),
        F.max(F.when(of_visit, value)).alias("returns"),
        F.max(F.col("weekday").cast("bigint")).alias("weekday"),
    )
    entries = F.sort_array(F.concat(F.col("entries"), *_visit_entries(encoded.named)))
    packed = visits.select("visit_number", entries.alias("entries"))
    return packed.select(
        "visit_number", F.col("entries.idx").alias("indices"), F.col("entries.value").alias("values")
    )


def _visit_entries(named: dict[str, int]) -> list[Column]:
    weekday = F.col("weekday")
    values = {RETURNS: F.col("returns"), WEEKDAY: weekday, MON_TO_FRI: is_mon_to_fri(weekday).cast("bigint")}
    nothing = F.array().cast("array<struct<idx:bigint,value:bigint>>")
    return [
        F.when(value != 0, F.array(F.struct(F.lit(named[name]).cast("bigint").alias("idx"), value.alias("value")))).otherwise(
            nothing
        )
        for name, value in values.items()
        if name in named
    ]
