"""Token counts by a two-tier lookup: frequent words broadcast, the others per worker."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import over_batches
from tillroll.llm.word_tokens import LONGEST, VOCABULARY, encode, folded, split, text_slices, word_ids
from tillroll.session import checkpoint

#: Entries of the broadcast table, and of each summary on the way to it.
FREQUENT = 16_384
#: Summaries that are merged at once.
FAN_IN = 32
#: Tokens that a document may have.
LIMIT = 2048

_SUMMARY = "part bigint, words array<string>, counts array<bigint>"


def _top(counts: Counter, n: int) -> tuple[list[str], list[int]]:
    best = counts.most_common(n)
    return [w for w, _ in best], [c for _, c in best]


def _counted(texts: pa.Array, path: str) -> dict[str, int]:
    """How often each word of at most LONGEST bytes occurs."""
    _, words = split(folded(texts, path))
    counts = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
    short = pc.less_equal(pc.binary_length(words.dictionary), LONGEST).to_numpy(zero_copy_only=False).astype(bool)
    return dict(zip(words.dictionary.filter(pa.array(short)).to_pylist(), counts[short].tolist()))


def frequent_words(docs: DataFrame, n: int = FREQUENT, path: str = VOCABULARY) -> list[str]:
    """About the ``n`` most frequent words of all texts, the most frequent first.

    Every task counts its own words and keeps the largest counts, pruned on the way so
    that its memory is bounded; summaries of ``n`` entries of at most LONGEST bytes are
    merged FAN_IN at a time. No word is shuffled on its own. What a summary leaves out
    costs a lookup in the second tier and changes no count of tokens.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                counts.update(_counted(texts, path))
                if len(counts) > 8 * n:
                    counts = Counter(dict(counts.most_common(4 * n)))
        best, numbers = _top(counts, n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([best], pa.list_(pa.string())), pa.array([numbers], pa.list_(pa.int64()))], ["words", "counts"]
        )

    def merged(rows: pd.DataFrame) -> tuple[list[str], list[int]]:
        counts: Counter = Counter()
        for some, numbers in zip(rows["words"], rows["counts"]):
            for word, number in zip(some, numbers):
                counts[word] += int(number)
        return _top(counts, n)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        some, numbers = merged(rows)
        return pd.DataFrame({"part": [key[0]], "words": [some], "counts": [numbers]})

    each = docs.select(F.col("text").cast("string")).mapInArrow(summary, "words array<string>, counts array<bigint>")
    found = checkpoint(each.withColumn("part", F.spark_partition_id().cast("bigint")).select("part", "words", "counts"))
    while found.count() > FAN_IN:
        found = checkpoint(found.groupBy(F.floor(F.col("part") / FAN_IN).alias("part")).applyInPandas(merge, _SUMMARY))
    return merged(found.toPandas())[0]


class LengthTable:
    """The number of ids of some words: sorted 64-bit hashes, the words behind them, to
    compare, and their numbers. Of words with equal hashes all but one are not found."""

    def __init__(self, words: list[str], lengths: np.ndarray):
        hashes = _hashes(words)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.lengths = hashes[order], np.asarray(lengths, np.uint32)[order]
        self.words = pa.array(words, pa.large_string()).take(pa.array(order))

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``words`` the table holds, and the number of ids of each of these; 0 for others."""
        if not len(self.hashes):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.searchsorted(self.hashes, _hashes(words.to_pylist())).clip(0, len(self.hashes) - 1)
        held = pc.equal(self.words.take(pa.array(at)), words.cast(pa.large_string())).to_numpy(zero_copy_only=False).astype(bool)
        return held, np.where(held, self.lengths[at], 0).astype(np.int64)


def _hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False) if words else np.zeros(0, np.uint64)


def token_counts(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT, n: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    Null texts count as empty: no bytes, no tokens. Repeated rows are counted each; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    table = frequent_words(docs, n, path)
    shared = spark.sparkContext.broadcast(LengthTable(table, encode(path, table)[0]))

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        totals = [np.zeros(0, np.int64)]
        for texts in text_slices(rows.column("text")):
            n_words, words = split(folded(texts, path))
            held, lengths = shared.value.find(words.dictionary)
            misses = words.dictionary.filter(pa.array(~held)).to_pylist()
            lengths[~held] = word_ids(path).lengths_of(misses)
            before = np.concatenate(([0], np.cumsum(lengths[words.indices.to_numpy()])))
            ends = np.cumsum(n_words)
            totals.append(before[ends] - before[ends - n_words])
        n_bytes = rows.column("n_bytes")
        counted = np.concatenate(totals)
        n_tokens = pa.array(counted, pa.int64())
        over = pa.array(counted > limit, pa.bool_())
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), n_bytes, n_tokens, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(over_batches(batch), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
