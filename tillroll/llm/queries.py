"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    byte_bpe,
    decontaminate,
    merkle,
    nb_svm,
    pii,
    preference,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    token_output,
    web_archives,
    whitening,
)
from tillroll.llm.common import documents, prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_context_mixing_tokens": lambda spark, folder: token_output.written(documents(spark, folder)),
    "op2_byte_bpe": lambda spark, folder: byte_bpe.digests(byte_bpe.round_trip(documents(spark, folder))),
    "op3_latent_decontamination": lambda spark, folder: decontaminate.contaminated(
        documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")
    ),
    "op4_token_counts": lambda spark, folder: token_counts.token_counts(documents(spark, folder)),
    "op5_preference_pairs": lambda spark, folder: preference.preference_rows(
        prepare(spark).read.parquet(f"{folder}/conversations.parquet")
    ),
    "op6_lpt_shards": lambda spark, folder: sharding.sharded(documents(spark, folder)),
    "op7_nb_svm_quality": lambda spark, folder: nb_svm.scored(
        documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    ),
    "op8_pii_surrogates": lambda spark, folder: pii.surrogates(documents(spark, folder)),
    "op9_simhash_pivots": lambda spark, folder: simhash.near_duplicates(documents(spark, folder)),
    "op10_line_first_rules": lambda spark, folder: quality_rules.quality(documents(spark, folder)),
    "op11_spectral_whitening": lambda spark, folder: whitening.whitened(
        prepare(spark).read.parquet(f"{folder}/embeddings.parquet")
    ),
    "op12_octopus_manifest": lambda spark, folder: merkle.proofs(documents(spark, folder)),
    "op13_arc_converter": lambda spark, folder: web_archives.archived(
        prepare(spark).read.parquet(f"{folder}/pages.parquet")
    ),
}
