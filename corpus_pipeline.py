"""The corpus pipeline: clean, deduplicate, decontaminate, hide private data, tokenize."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import byte_bpe, decontaminate, pii, quality_rules, simhash
from tillroll.llm.common import prepare
from tillroll.llm.token_output import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops failing lines, and the documents that fail or lose too much (op 10)."""
    prepare(spark)
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near-duplicates (op 9)."""
    prepare(spark)
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark (op 3)."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def private_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces private data by surrogates (op 8)."""
    prepare(spark)
    return pii.hidden(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The ids of each text, with digests of them and of the bytes they decode to (op 2)."""
    prepare(spark)
    return byte_bpe.digests(byte_bpe.round_trip(docs), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("tokens", tokens),
]

#: Stages hash, factorise and merge in ways SQL has no words for; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``, each on what the one before kept.

    Each stage's rows are written as Parquet and read again by the next.
    """
    prepare(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    place = shared_folder(spark)
    for name, stage in STAGES:
        stage(spark, docs, folder).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return docs
