"""Frequent department sets per trip type, and matching visits against them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import IGNORED_TRIP_TYPES, MIN_SUPPORT
from tillroll.functions.scalars import label_item
from tillroll.operators.conditional import FOUND, mined
from tillroll.session import checkpoint, lookup

SEPARATOR = ";"


def transactions(scans: DataFrame, ignored: Sequence[int] = IGNORED_TRIP_TYPES) -> DataFrame:
    """(visit_number, trip_type, departments): the sorted department set of each labelled visit.

    Signs are ignored: a returned department is in the set. Visits with an ignored trip
    type are dropped before grouping, which the constant label allows. A visit without
    any department stays, with an empty set.
    """
    labelled = scans.where(F.col("trip_type").isNotNull() & ~F.col("trip_type").isin(list(ignored)))
    return labelled.groupBy("visit_number").agg(
        F.min("trip_type").alias("trip_type"),
        F.sort_array(F.collect_set("department")).alias("departments"),
    )


def with_label_item(baskets: DataFrame) -> DataFrame:
    """(visit_number, items): the label as an item beside the departments, sorted."""
    items = F.concat(F.array(label_item(F.col("trip_type"))), F.col("departments"))
    return baskets.select("visit_number", F.sort_array(items).alias("items"))


#: Baskets times items of a conditional database that one task mines.
CELLS = 1 << 24


def mine(baskets: DataFrame, min_support: float = MIN_SUPPORT, cells: int = CELLS) -> DataFrame:
    """(trip_type, items, freq): sets of two or more departments frequent under a trip type.

    ``freq`` counts the visits of that trip type holding the set; it must reach
    ``min_support`` of all baskets. Equal to mining with the label as one more item.

    Departments that are frequent under a trip type are numbered there, rarest first. A basket
    goes to the conditional database of each of its departments with the more frequent ones it
    holds, which keeps the databases of common departments short; equal baskets are one row. A
    database of at most ``cells`` baskets times departments is mined by one task, over bits. A
    larger one grows by one department more first, in a round over all tasks that shuffles its
    counts, until its parts are small: after d departments at most 2 ** (D - d) rows are left.
    """
    patterns = checkpoint(baskets.groupBy("trip_type", "departments").agg(F.count("*").alias("n")))
    n_baskets = patterns.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(1, math.ceil(min_support * n_baskets))
    names = lookup(_ranked(patterns, least))
    grown, found = checkpoint(_conditional(patterns, names)), []
    while True:
        small, large = _dealt(grown, cells)
        found.append(small.groupBy("trip_type", "items").applyInArrow(mined(least), FOUND))
        if large is None:
            break
        added = _frequent_extensions(large, least)
        found.append(added.select("trip_type", F.concat("items", F.array("item")).alias("items"), "freq"))
        grown = checkpoint(_combined(_extend(_pruned(large, added)).where(F.size("rest") > 0)))
    named = F.sort_array(F.transform("items", lambda rank: F.get("names", rank)))
    sets = reduce(DataFrame.unionAll, found).join(names, "trip_type")
    return sets.select("trip_type", named.alias("items"), "freq")


def _ranked(patterns: DataFrame, least: int) -> DataFrame:
    # (trip_type, names): the frequent departments of a trip type, rarest first.
    each = patterns.select("trip_type", "n", F.explode("departments").alias("department"))
    counts = each.groupBy("trip_type", "department").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least)
    ranked = counts.groupBy("trip_type").agg(F.sort_array(F.collect_list(F.struct("freq", "department"))).alias("ranked"))
    return ranked.select("trip_type", F.col("ranked.department").alias("names"))


def _conditional(patterns: DataFrame, names: DataFrame) -> DataFrame:
    # (trip_type, items, rest, n): each basket under each of its departments, with those ranked above.
    place = F.transform("departments", lambda d: F.array_position("names", d).cast("int") - 1)
    ranks = patterns.join(names, "trip_type").select(
        "trip_type", "n", F.sort_array(F.filter(place, lambda rank: rank >= 0)).alias("rest")
    )
    first = ranks.withColumn("items", F.slice("rest", 1, 0)).where(F.size("rest") > 1)
    return _combined(_extend(first).where(F.size("rest") > 0))


def _combined(grown: DataFrame) -> DataFrame:
    return grown.groupBy("trip_type", "items", "rest").agg(F.sum("n").alias("n"))


def _dealt(grown: DataFrame, cells: int) -> tuple[DataFrame, DataFrame | None]:
    # What single tasks mine, and what has to grow further, if anything.
    width = F.max(F.element_at("rest", -1)) - F.first(F.element_at("items", -1))
    sizes = grown.groupBy("trip_type", "items").agg((F.count("*") * width).alias("cells"))
    over, keys = sizes.where(F.col("cells") > cells).drop("cells"), ["trip_type", "items"]
    if over.isEmpty():
        return grown, None
    over = lookup(over)
    return grown.join(over, keys, "left_anti"), grown.join(over, keys, "left_semi")


def _frequent_extensions(grown: DataFrame, least: int) -> DataFrame:
    # (trip_type, items, item, freq) of the departments that may follow a set.
    each = grown.select("trip_type", "items", "n", F.explode("rest").alias("item"))
    counts = each.groupBy("trip_type", "items", "item").agg(F.sum("n").alias("freq"))
    return checkpoint(counts.where(F.col("freq") >= least))


def _pruned(grown: DataFrame, added: DataFrame) -> DataFrame:
    # What is not frequent with a set is not with a larger one.
    usable = added.groupBy("trip_type", "items").agg(F.collect_list("item").alias("usable"))
    kept = grown.join(lookup(usable), ["trip_type", "items"])
    return kept.withColumn("rest", F.array_intersect("rest", "usable")).drop("usable")


def _extend(grown: DataFrame) -> DataFrame:
    # items + one department of the rest; what follows that department is the new rest.
    taken = grown.select("trip_type", "n", "items", "rest", F.posexplode("rest").alias("pos", "item"))
    return taken.select(
        "trip_type",
        F.concat("items", F.array("item")).alias("items"),
        F.slice("rest", F.col("pos") + 2, F.size("rest")).alias("rest"),
        "n",
    )


def trip_types(itemsets: DataFrame) -> DataFrame:
    """(trip_type, n_itemsets) over the mined sets."""
    return itemsets.groupBy("trip_type").agg(F.count("*").alias("n_itemsets"))


def preview(itemsets: DataFrame, n: int = 50) -> DataFrame:
    """(itemset, freq): the ``n`` most frequent sets, each as text with its label item."""
    items = F.sort_array(F.concat(F.array(label_item(F.col("trip_type"))), F.col("items")))
    shown = itemsets.select(F.array_join(items, ", ").alias("itemset"), "freq")
    return shown.orderBy(F.desc("freq"), "itemset").limit(n)


def itemset_lines(itemsets: DataFrame) -> DataFrame:
    """(value): ``trip_type;department;department...`` per set."""
    line = F.concat_ws(SEPARATOR, F.col("trip_type").cast("string"), F.col("items"))
    return itemsets.select(line.alias("value"))


def read_itemsets(spark: SparkSession, path: str) -> DataFrame:
    """(trip_type, items) from itemset lines; ``NULL`` items are dropped, the rest sorted."""
    fields = F.split("value", SEPARATOR)
    items = F.array_remove(F.slice(fields, 2, F.size(fields)), "NULL")
    return spark.read.text(path).select(
        F.element_at(fields, 1).cast("int").alias("trip_type"), F.sort_array(items).alias("items")
    )


def dictionary_of(itemsets: DataFrame) -> DataFrame:
    """(items, trip_type): one trip type per department set.

    A set found under several trip types takes the one with the highest frequency, then
    the smallest. Sets read from lines have no frequency and count as equal.
    """
    freq = F.col("freq") if "freq" in itemsets.columns else F.lit(0)
    best = F.min(F.struct((-freq).alias("rank"), "trip_type"))
    chosen = itemsets.groupBy("items").agg(best.alias("best"))
    return chosen.select("items", F.col("best.trip_type").alias("trip_type"))


def match(purchases: DataFrame, itemsets: DataFrame) -> DataFrame:
    """(visit_number, item_set): trip type of the longest known prefix of each basket, else 0.

    ``purchases`` holds department sums without returns, with a row for every visit; the
    basket is the sorted departments with a positive sum. Only its prefixes of two or
    more are looked up. Known sets are keyed by their first two departments, so a basket is
    one row of the join, whatever its length, and finds the sets that may be its prefixes there,
    longest first.
    """
    first, second = F.get("items", F.lit(0)).alias("first"), F.get("items", F.lit(1)).alias("second")
    entry = F.struct(F.size("items").alias("size"), "items", "trip_type")
    known = dictionary_of(itemsets).where(F.size("items") >= 2)
    known = known.groupBy(first, second).agg(F.sort_array(F.collect_list(entry), asc=False).alias("known"))
    basket = F.sort_array(F.collect_list(F.when(F.col("value") > 0, F.col("department"))))
    baskets = purchases.groupBy("visit_number").agg(basket.alias("basket"))
    keyed = baskets.select(
        "visit_number", "basket", F.get("basket", F.lit(0)).alias("first"), F.get("basket", F.lit(1)).alias("second")
    )
    tried = keyed.join(lookup(known), ["first", "second"], "left")
    prefixes = F.filter("known", lambda k: k["items"] == F.slice("basket", F.lit(1), k["size"]))
    return tried.select("visit_number", F.coalesce(F.get(prefixes, F.lit(0))["trip_type"], F.lit(0)).alias("item_set"))
