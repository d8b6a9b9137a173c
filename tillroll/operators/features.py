"""Features per visit, kept long: (visit_number, feature, value), absent = 0.

A wide table has thousands of columns that are nearly all zero. Here it stays in long
form; :func:`sparse_rows` packs it per visit, and only small vocabularies go wide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import (
    fineline_feature,
    is_mon_to_fri,
    signed_department,
    upc_feature,
    weekday_ordinal,
)
from tillroll.session import lookup, size_checked

# Families in the order of the feature dictionary.
RETURNED, PURCHASED, FINELINE, UPC, VISIT, CATEGORY, FITTED = range(7)
RETURNS, WEEKDAY, MON_TO_FRI = VISIT_FEATURES = ("Returns", "Weekday", "Mon_To_Fri")
ITEM_SET, DEPT_CATEGORY = FITTED_FEATURES = ("ItemSet", "Dept_Category")


def signed_departments(scans: DataFrame) -> DataFrame:
    """The scan log with the sign of each line carried on its department."""
    return scans.withColumn("department", signed_department(F.col("department"), F.col("scan_count")))


def visit_sums(scans: DataFrame, feature: Column) -> DataFrame:
    """(visit_number, feature, value): scan counts summed per visit and feature name."""
    named = scans.select("visit_number", feature.alias("feature"), "scan_count")
    present = named.where(F.col("feature").isNotNull())
    return present.groupBy("visit_number", "feature").agg(F.sum("scan_count").alias("value"))


def department_sums(scans: DataFrame) -> DataFrame:
    return visit_sums(scans, signed_department(F.col("department"), F.col("scan_count")))


def purchases(scans: DataFrame) -> DataFrame:
    """(visit_number, department, value): department sums without returns.

    What is neither bought nor in a department falls into a null department, so that
    every visit is kept.
    """
    bought = F.when(F.col("scan_count") >= 0, F.col("department"))
    return scans.groupBy("visit_number", bought.alias("department")).agg(F.sum("scan_count").alias("value"))


def fineline_sums(scans: DataFrame) -> DataFrame:
    return visit_sums(scans, fineline_feature(F.col("fineline")))


def upc_sums(scans: DataFrame, upcs: DataFrame) -> DataFrame:
    """Sums over a given UPC vocabulary, broadcast if its size allows."""
    kept = scans.join(size_checked(upcs.select("upc")), "upc", "left_semi")
    return visit_sums(kept, upc_feature(F.col("upc")))


def category_sums(scans: DataFrame, categories: DataFrame) -> DataFrame:
    """Per visit and category the sum over member departments, returns under ``-category``.

    Departments are summed first, so the many-to-many join sees one row per visit,
    sign and department.
    """
    returned = F.col("scan_count") < 0
    sums = (
        scans.where(F.col("department").isNotNull())
        .groupBy("visit_number", returned.alias("returned"), "department")
        .agg(F.sum("scan_count").alias("scan_count"))
    )
    joined = sums.join(lookup(categories), "department")
    return visit_sums(joined, _signed_category(F.col("category"), F.col("returned")))


def _signed_category(category: Column, returned: Column) -> Column:
    return F.when(returned, F.concat(F.lit("-"), category)).otherwise(category)


def visit_means(scans: DataFrame, column: str) -> DataFrame:
    """(visit_number, column, mean_scan_count) over raw, unsigned values."""
    present = scans.where(F.col(column).isNotNull())
    return present.groupBy("visit_number", column).agg(F.avg("scan_count").alias("mean_scan_count"))


def visit_labels(scans: DataFrame) -> DataFrame:
    """(visit_number, trip_type): one row per visit; the label is constant within it."""
    return scans.groupBy("visit_number").agg(F.min("trip_type").alias("trip_type"))


def extract_labels(scans: DataFrame) -> DataFrame:
    """Labels of a labelled scan log."""
    if "trip_type" not in scans.columns:
        raise ValueError("the scan log has no trip_type")
    return visit_labels(scans)


def visit_returns(scans: DataFrame) -> DataFrame:
    """(visit_number, n_returns, has_returns)."""
    counted = scans.groupBy("visit_number").agg(F.count_if(F.col("scan_count") < 0).alias("n_returns"))
    return counted.withColumn("has_returns", (F.col("n_returns") > 0).cast("int"))


def visit_calendar(scans: DataFrame) -> DataFrame:
    """(visit_number, weekday, mon_to_fri) with the weekday as an ordinal."""
    ordinals = scans.groupBy("visit_number").agg(F.min(weekday_ordinal(F.col("weekday"))).alias("weekday"))
    return ordinals.withColumn("mon_to_fri", is_mon_to_fri(F.col("weekday")))


def visit_facts(scans: DataFrame) -> DataFrame:
    """Returns and calendar of a visit from one aggregation."""
    facts = scans.groupBy("visit_number").agg(
        F.min(weekday_ordinal(F.col("weekday"))).alias("weekday"),
        F.count_if(F.col("scan_count") < 0).alias("n_returns"),
    )
    return facts.select(
        "visit_number",
        "weekday",
        is_mon_to_fri(F.col("weekday")).alias("mon_to_fri"),
        "n_returns",
        (F.col("n_returns") > 0).cast("int").alias("has_returns"),
    )


def visit_summary(scans: DataFrame) -> DataFrame:
    """(visit_number, weekday, mon_to_fri, n_returns, has_returns, feature, value): the
    department sums of a visit beside its returns and calendar, from one pass.

    A visit's list holds one entry per signed department.
    """
    feature = signed_department(F.col("department"), F.col("scan_count"))
    sums = scans.groupBy("visit_number", feature.alias("feature")).agg(
        F.sum("scan_count").alias("value"),
        F.count_if(F.col("scan_count") < 0).alias("n_returns"),
        F.min(weekday_ordinal(F.col("weekday"))).alias("weekday"),
    )
    entry = F.when(F.col("feature").isNotNull(), F.struct("feature", "value"))
    visits = sums.groupBy("visit_number").agg(
        F.min("weekday").alias("weekday"), F.sum("n_returns").alias("n_returns"), F.collect_list(entry).alias("entries")
    )
    return visits.select(
        "visit_number",
        "weekday",
        is_mon_to_fri(F.col("weekday")).alias("mon_to_fri"),
        "n_returns",
        (F.col("n_returns") > 0).cast("int").alias("has_returns"),
        F.inline_outer("entries"),
    )


def _entry(family: int | Column, feature: Column, value: Column) -> Column:
    family = F.lit(family) if isinstance(family, int) else family
    return F.struct(
        family.alias("family"), feature.alias("feature"), value.cast("bigint").alias("value")
    )


# Levels at which a scan line is summed; categories take one level each from the last on.
_DEPARTMENT, _FINELINE, _UPC, _VISIT, _CATEGORY = range(5)


def _sums_by_level(scans: DataFrame, categories: DataFrame, upcs: DataFrame) -> DataFrame:
    # One row per visit, level and key of that level: a name or a number.
    members = categories.groupBy("department").agg(F.collect_set("category").alias("categories"))
    kept = size_checked(upcs.select("upc", F.lit(True).alias("kept")))
    n_categories = F.when(F.col("categories").isNull(), 0).otherwise(F.size("categories"))
    last = F.lit(_CATEGORY - 1) + n_categories
    lines = (
        scans.join(lookup(members), "department", "left")
        .join(kept, "upc", "left")
        .withColumn("level", F.explode(F.sequence(F.lit(0), last)))
    )
    level = F.col("level")
    category = F.when(level >= _CATEGORY, F.get("categories", level - _CATEGORY))
    keyed = lines.select(
        "visit_number",
        F.least(level, F.lit(_CATEGORY)).alias("level"),
        F.when(level.isin(_FINELINE, _UPC, _VISIT), False).otherwise(F.col("scan_count") < 0).alias("returned"),
        F.when(level == _DEPARTMENT, F.col("department")).otherwise(category).alias("name"),
        F.when(level == _FINELINE, F.col("fineline"))
        .when((level == _UPC) & F.col("kept"), F.col("upc"))
        .alias("number"),
        "scan_count",
        weekday_ordinal(F.col("weekday")).alias("weekday"),
    )
    used = (level == _VISIT) | F.col("name").isNotNull() | F.col("number").isNotNull()
    return (
        keyed.where(used)
        .groupBy("visit_number", "level", "returned", "name", "number")
        .agg(
            F.sum("scan_count").alias("value"),
            F.count_if(F.col("scan_count") < 0).alias("n_returns"),
            F.min("weekday").alias("weekday"),
        )
    )


def visit_features(scans: DataFrame, categories: DataFrame, upcs: DataFrame) -> DataFrame:
    """(visit_number, family, feature, value): all features of every visit.

    One scan and one aggregation: each line is repeated for the levels it is summed at,
    with plain typed keys, and the copies combine per visit before any shuffle. Feature
    names are made from the far fewer sums. Every visit has the visit features, so one
    without any department is kept too.
    """
    level, name, number = F.col("level"), F.col("name"), F.col("number")
    returned, value, weekday = F.col("returned"), F.col("value"), F.col("weekday")
    signed = F.when(returned, F.concat(F.lit("-"), name)).otherwise(name)
    family = (
        F.when(level == _FINELINE, FINELINE)
        .when(level == _UPC, UPC)
        .when(level == _CATEGORY, CATEGORY)
        .when(returned, RETURNED)
        .otherwise(PURCHASED)
    )
    feature = (
        F.when(level == _FINELINE, fineline_feature(number))
        .when(level == _UPC, upc_feature(number))
        .otherwise(signed)
    )
    of_visit = F.array(
        _entry(VISIT, F.lit(RETURNS), F.col("n_returns")),
        _entry(VISIT, F.lit(WEEKDAY), weekday),
        _entry(VISIT, F.lit(MON_TO_FRI), is_mon_to_fri(weekday)),
    )
    entries = F.when(level == _VISIT, of_visit).otherwise(F.array(_entry(family, feature, value)))
    named = _sums_by_level(scans, categories, upcs).select("visit_number", F.inline(entries))
    return named.where(F.col("value").isNotNull())


def fitted_feature(values: DataFrame, column: str, feature: str) -> DataFrame:
    """A fitted value per visit as rows of the long feature table."""
    return values.select(
        "visit_number",
        F.lit(FITTED).alias("family"),
        F.lit(feature).alias("feature"),
        F.col(column).cast("bigint").alias("value"),
    )


def mean_features(scans: DataFrame) -> DataFrame:
    """(visit_number, feature, value): mean counts by raw department and fineline, and the weekday."""
    rows = scans.withColumn("weekday", weekday_ordinal(F.col("weekday")))
    keys = ["visit_number", "department", "fineline"]
    means = rows.groupingSets([keys[:2], ["visit_number", "fineline"], keys[:1]], *keys).agg(
        F.avg("scan_count").alias("mean"),
        F.min("weekday").cast("double").alias("weekday"),
        *[F.grouping(key).alias(f"no_{key}") for key in keys[1:]],
    )
    by_department, by_fineline = F.col("no_department") == 0, F.col("no_fineline") == 0
    feature = (
        F.when(by_department, F.col("department"))
        .when(by_fineline, fineline_feature(F.col("fineline")))
        .otherwise(F.lit(WEEKDAY))
    )
    value = F.when(by_department | by_fineline, F.col("mean")).otherwise(F.col("weekday"))
    return means.select("visit_number", feature.alias("feature"), value.alias("value")).where(
        F.col("feature").isNotNull() & F.col("value").isNotNull()
    )


def wide(features: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """One row per visit and one column per term of a small vocabulary, 0 where absent.

    A visit's few sums are listed by place and spread over the columns last, row by row; a pivot
    holds all columns of every visit while it sums.
    """
    return spread_sums(features, "feature", vocabulary, vocabulary)


def spread_sums(rows: DataFrame, column: str, terms: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per visit and, called ``names``, one column per term: the sum of ``value`` where ``column`` is
    the term, or 0. Other terms are left out, and every visit is kept.
    """
    sums = rows.groupBy("visit_number", column).agg(F.sum("value").alias("value"))
    place = F.array_position(F.array(*map(F.lit, terms)), F.col(column)).cast("int")
    entry = F.when(place > 0, F.struct(place.alias("place"), F.col("value").alias("value")))
    listed = sums.groupBy("visit_number").agg(F.map_from_entries(F.collect_list(entry)).alias("places"))
    cells = [F.coalesce(F.try_element_at("places", F.lit(n)), F.lit(0)) for n in range(1, len(terms) + 1)]
    return listed.select("visit_number", *[cell.alias(name) for cell, name in zip(cells, names)])


def sparse_rows(features: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(visit_number, indices, values): non-zero values per visit in index order.

    ``dictionary`` is a materialised (idx, family, feature) table. A visit has at most one
    entry per term of it. Features outside the dictionary are left out; a visit with no entry
    keeps empty arrays.
    """
    indexed = features.join(size_checked(dictionary), ["family", "feature"], "left")
    used = F.col("idx").isNotNull() & (F.col("value") != 0)
    entries = F.sort_array(F.collect_list(F.when(used, F.struct("idx", "value"))))
    return (
        indexed.groupBy("visit_number")
        .agg(entries.alias("entries"))
        .select(
            "visit_number",
            F.col("entries.idx").alias("indices"),
            F.col("entries.value").alias("values"),
        )
    )
