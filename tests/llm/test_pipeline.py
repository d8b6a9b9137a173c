"""The pipeline on a small table: every stage's decisions take effect."""

from __future__ import annotations

import base64
import os

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from check_oracle import compare, connect
from test_operators import brute_fingerprint, reach

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "private_data", "tokens"]


def test_pipeline_against_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert 0 < docs.count() <= left
        left = docs.count()
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.count() == left and not found.where("n_tokens = 0 or size(ids) <> n_tokens").count()


def test_stages_against_plain_python(spark):
    """Near-duplicates by comparing all fingerprints, tokens by the library."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    ids = [i for i, _ in rows]
    kept = {r.doc_id for r in stages["near_duplicates"](spark, docs, FOLDER).collect()}
    assert kept == set(reach(ids, [brute_fingerprint(t) for _, t in rows]))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: list(r.ids) for r in stages["tokens"](spark, docs, FOLDER).collect()}
    assert found == {i: library.encode_ordinary(t) for i, t in rows}


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op5_preference_pairs", "op10_line_first_rules"])
def test_query_equals_sql(spark, name):
    folder = os.environ.get("CHECK_SF_DIR", FOLDER)
    assert compare(spark, connect(folder), folder, name) is None


def test_tokens_take_one_python_worker_a_task(spark):
    """Encoding and decoding share a worker and its tables, and give what the two steps give."""
    from tillroll.llm import byte_bpe

    docs = spark.createDataFrame([(1, "Ein  Satz, two words\n"), (1, ""), (None, None)], "doc_id bigint, text string")
    found = byte_bpe.round_trip(docs)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, byte_bpe.decoded(byte_bpe.encoded(docs)).collect()))
    for made in (entry.queries()["op2_byte_bpe"](spark, FOLDER), corpus_pipeline.tokens(spark, docs, FOLDER)):
        assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
