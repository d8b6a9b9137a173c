"""A scan log over the order tables: order = visit, order line = scanned line.

Line items lead and the other two tables are left-joined on their primary keys, so a
caller that names its columns gets exactly the projection of the full view, without
the joins it does not need.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import WEEKDAYS
from tillroll.session import bound_tasks, prepare, spread, stored_bytes, written
from tillroll.sources.scanlog import SCAN_COLUMNS

_FROM_PART = {"department", "fineline"}
_FROM_ORDERS = {"trip_type", "weekday"}
# A line without order counts as open.
_OPEN = "coalesce(o_orderstatus, 'O') = 'O'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scans(
    spark: SparkSession,
    folder: str,
    columns: Iterable[str] = tuple(SCAN_COLUMNS),
    part: str | None = None,
    even: bool = False,
) -> DataFrame:
    """The scan log; ``part`` is ``train`` (settled orders), ``test`` (open ones) or all.

    ``even`` spreads lines over as many partitions as the session sets in
    ``tillroll.scan.partitions``, for queries that multiply them; unset, a scan stays as it is.

    Orders are joined last: what follows groups by visit, and the rows are then already
    partitioned by it.
    """
    rows = _joined(spark, folder, columns, part is not None, even)
    if part == "train":
        rows = rows.where(F.col("o_orderstatus") != "O")
    elif part == "test":
        rows = rows.where(_OPEN)
    return rows.select(*_expressions(columns))


def stored(spark: SparkSession, folder: str, columns: Iterable[str] = tuple(SCAN_COLUMNS)) -> DataFrame:
    """The scan log with ``part``, ``train`` or ``test``, from a table in a folder per part.

    For what reads the log more than once: the three tables are joined once, when it is written.
    """
    rows = _joined(spark, folder, columns, True, True)
    return written(rows.select(*_expressions(columns), F.when(F.expr(_OPEN), "test").otherwise("train").alias("part")), "part")


def _expressions(columns: Iterable[str]) -> list:
    wanted = set(columns)
    return [_expression(name).alias(name) for name in SCAN_COLUMNS if name in wanted]


def _joined(spark: SparkSession, folder: str, columns: Iterable[str], status: bool, even: bool) -> DataFrame:
    prepare(spark)
    wanted = set(columns)
    rows = table(spark, folder, "lineitem")
    bound_tasks(spark, stored_bytes(rows))
    if even:
        partitions = spark.conf.get("tillroll.scan.partitions", None)
        rows = spread(rows, partitions and int(partitions), "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    if wanted & _FROM_PART:
        parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
        rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & _FROM_ORDERS or status:
        orders = table(spark, folder, "orders").select(
            "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
        )
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows


def _expression(name: str):
    line, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    quantity = F.col("l_quantity").cast("bigint")
    if name == "visit_number":
        return F.col("l_orderkey")
    if name == "trip_type":
        return F.substring("o_orderpriority", 1, 1).cast("int")
    if name == "weekday":
        # The day's name by its number; formatting a date per line is far slower.
        return F.get(F.array(*map(F.lit, WEEKDAYS)), F.weekday("o_orderdate"))
    if name == "upc":
        return F.when(line == 7, None).otherwise(F.col("l_partkey"))
    if name == "scan_count":
        return F.when(flag == "R", -quantity).otherwise(quantity)
    if name == "department":
        return F.when((line == 7) & (status == "O"), None).otherwise(F.col("p_name"))
    missing = ((line == 7) & (flag != "N")) | ((line == 6) & (flag == "A"))
    return F.when(missing, None).otherwise(F.col("p_size"))


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """(department, category): each department is in one category per word of its name."""
    prepare(spark)
    names = table(spark, folder, "part").select(F.col("p_name").alias("department")).distinct()
    words = F.explode(F.array_distinct(F.split("department", " ")))
    return names.select("department", words.alias("category"))
