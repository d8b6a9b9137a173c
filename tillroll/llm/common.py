"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import session

#: White space of the contracts, as a Java pattern: what separates words.
SPACE = "[\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults, and this package on the path of the Python workers."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))
    return session.prepare(spark)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{folder}/documents.parquet")
    return docs.select(*columns) if columns else docs


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, whatever task runs in it."""
    return sys.modules[__name__].__dict__.setdefault("_WORKER", {})


def slices(texts: list, limit: int = 1 << 20) -> Iterator[slice]:
    """Consecutive slices of about ``limit`` characters or bytes; at least one text each."""
    start = size = 0
    for position, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield slice(start, position + 1)
            start, size = position + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """The texts of an Arrow column, null as empty."""
    return [text or "" for text in column.to_pylist()]


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of all ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def lists(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow list column from the length of each list and all values."""
    return pa.ListArray.from_arrays(pa.array(offsets(lengths), pa.int32()), pa.array(values))


def numbered(rows: DataFrame, by: list[str], key: Column, name: str) -> DataFrame:
    """Add ``name``: 0, 1, ... within each value of the columns ``by``, without gaps.

    No task holds all rows of a value: each value is cut into hash buckets of ``key``
    (about the square root of the row count in number), buckets are counted, and a row's
    number is the count of the buckets before its own plus its place in its bucket. Rows
    with equal keys take adjacent numbers. ``rows`` is read three times: materialise it.
    """
    buckets = max(1, int(rows.count() ** 0.5))
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    starts = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(key)
    joined = placed.withColumn("_place", F.row_number().over(inside)).join(starts, [*by, "_bucket"])
    return joined.withColumn(name, F.col("_start") + F.col("_place") - 1).drop("_bucket", "_place", "_start")


def over_batches(transform: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A function for mapInArrow that treats each batch on its own and skips empty results."""

    def run(batches):
        for batch in batches:
            if batch.num_rows and (made := transform(batch)) is not None:
                yield made

    return run
