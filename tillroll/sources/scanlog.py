"""Reading scan logs from CSV, joining labelled and unlabelled ones, sampling visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical column -> (name in the CSV header, type).
SCAN_COLUMNS = {
    "visit_number": ("VisitNumber", "bigint"),
    "trip_type": ("TripType", "int"),
    "weekday": ("Weekday", "string"),
    "upc": ("Upc", "bigint"),
    "scan_count": ("ScanCount", "bigint"),
    "department": ("DepartmentDescription", "string"),
    "fineline": ("FinelineNumber", "int"),
}


def read_scans(spark: SparkSession, path: str, malformed: str = "fail") -> DataFrame:
    """Read a scan log with a header row, columns in any order, ``NULL`` or nothing for missing.

    Columns are taken by name and given fixed types, so no pass infers a schema. Ids
    written like floats (``4011.0``) are read as integers. ``trip_type`` is left out if
    the file has none. A line with too few or too many fields, or with a number that is
    none, ends the read; with ``malformed="drop"`` it is left out, and is in
    :func:`rejected_lines`.
    """
    if malformed not in ("fail", "drop"):
        raise ValueError(f"malformed={malformed!r}: fail or drop")
    lines = _parsed(spark, path)
    columns = [name for name in SCAN_COLUMNS if name in lines.columns]
    if malformed == "drop":
        return lines.where(F.col("_reason").isNull()).select(*columns)
    told = F.raise_error(F.concat(F.lit("malformed "), F.col("_reason"), F.lit(": "), F.col("_line")))
    # On the column that every use reads, so that no projection skips it.
    checked = F.when(F.col("_reason").isNotNull(), told.cast("bigint")).otherwise(F.col("visit_number"))
    return lines.withColumn("visit_number", checked).select(*columns)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, reason) of the lines that ``read_scans(malformed="drop")`` leaves out.

    ``reason`` is ``fields`` for a wrong number of them, else the header of the first column that
    holds no number; ``line`` is the text, or the fields of it.
    """
    lines = _parsed(spark, path).where(F.col("_reason").isNotNull())
    return lines.select(F.col("_line").alias("line"), F.col("_reason").alias("reason"))


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    # The typed columns, and for a line that cannot be read why not.
    plain = spark.read.option("header", True).option("nullValue", "NULL").option("columnPruning", False)
    headers = plain.csv(path).columns
    fields = ", ".join(f"`{header}` string" for header in [*headers, "_corrupt"])
    raw = plain.option("columnNameOfCorruptRecord", "_corrupt").schema(fields).csv(path)
    known = {name: pair for name, pair in SCAN_COLUMNS.items() if pair[0] in headers or name != "trip_type"}
    typed = {name: _typed(F.col(header), kind) for name, (header, kind) in known.items()}
    bad = [
        F.when(F.nullif(F.trim(F.col(header)), F.lit("")).isNotNull() & typed[name].isNull(), F.lit(header))
        for name, (header, kind) in known.items()
        if kind != "string"
    ]
    reason = F.coalesce(F.when(F.col("_corrupt").isNotNull(), F.lit("fields")), *bad)
    line = F.coalesce("_corrupt", F.to_csv(F.struct(*[F.col(f"`{header}`") for header in headers])))
    return raw.select(*[column.alias(name) for name, column in typed.items()], reason.alias("_reason"), line.alias("_line"))


def _typed(text, kind):
    if kind == "string":
        return F.nullif(text, F.lit(""))
    return F.nullif(F.trim(text), F.lit("")).try_cast("decimal(20,0)").try_cast(kind)


def has_labels(scans: DataFrame) -> bool:
    """True if the scan log carries trip types."""
    return "trip_type" in scans.columns


def with_label(scans: DataFrame) -> DataFrame:
    """Add a null trip type where the log has none."""
    if has_labels(scans):
        return scans
    return scans.withColumn("trip_type", F.lit(None).cast("int"))


def write_scans(scans: DataFrame, path: str) -> None:
    """A scan log as CSV, in the form that :func:`read_scans` takes."""
    headers = {name: header for name, (header, _) in SCAN_COLUMNS.items()}
    scans.withColumnsRenamed(headers).write.mode("overwrite").option("nullValue", "NULL").csv(path, header=True)


def union_inputs(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows of both logs; the trip type of unlabelled rows is null."""
    return with_label(train).unionByName(with_label(test))


def one_visit(scans: DataFrame, visit: int) -> DataFrame:
    """All rows of one visit; the filter reaches the scan."""
    return scans.where(F.col("visit_number") == visit)


def sample_visits(scans: DataFrame, n: int) -> DataFrame:
    """All rows of the ``n`` visits with the smallest numbers.

    A cut by rows would tear a basket apart, so whole visits are taken. The id list has
    at most ``n`` rows, which bounds its broadcast.
    """
    ids = scans.select("visit_number").distinct().orderBy("visit_number").limit(n)
    return scans.join(F.broadcast(ids), "visit_number", "left_semi")
