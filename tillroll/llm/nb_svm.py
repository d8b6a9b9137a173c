"""Document quality by a Naive Bayes support vector machine over hashed n-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import as_texts, lists, over_batches, slices, worker_cache
from tillroll.llm.word_tokens import WordIds
from tillroll.session import checkpoint

#: Hashed n-grams; the last ten stand for the share of repeated three-token windows.
N_FEATURES = 1 << 18
N_SHARES = 10
#: Labelled documents that a model is fitted on, about: a hash of their ids picks them.
MAX_TRAINING = 20_000
#: Smoothing of the class counts, cost of a violated margin, passes over the sample.
ALPHA, COST, EPOCHS = 1.0, 1.0, 8
SLOPE = 4.0

_PART = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _tokens(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per word the hashes of its letters, digits and marks, in lower case; capitals add a token."""
    each = []
    for word in words:
        parts = [zlib.crc32(part.encode()) for part in _PART.findall(word.lower())]
        if len(word) > 1 and word.isupper():
            parts.append(1)
        each.append(parts)
    lengths = np.fromiter(map(len, each), np.int64, len(each))
    flat = np.fromiter((h for parts in each for h in parts), np.uint32, int(lengths.sum()))
    return lengths, flat.view(np.int32)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of distinct features of each text, and all of them in ascending order.

    Features are tokens, pairs of neighbouring tokens, and how much of the text repeats.
    """
    cache = worker_cache()
    table: WordIds = cache.setdefault("quality words", WordIds(_tokens))
    lengths, tokens = table.of([text.split() for text in texts])
    tokens = tokens.view(np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    pair = owner[1:] == owner[:-1]
    pairs = ((tokens[:-1] * _MIX ^ tokens[1:]) * _MIX)[pair]
    triple = pair[1:] & pair[:-1]
    windows = (((tokens[:-2] * _MIX ^ tokens[1:-1]) * _MIX ^ tokens[2:]) * _MIX)[triple] if len(tokens) > 2 else tokens[:0]
    n = np.uint64(N_FEATURES - N_SHARES)
    keys = [
        owner * N_FEATURES + (tokens * _MIX >> np.uint64(20)) % n,
        owner[1:][pair] * N_FEATURES + (pairs >> np.uint64(20)) % n,
    ]
    if len(windows):
        at = owner[2:][triple]
        total = np.bincount(at, minlength=len(texts))
        spread = np.unique((at.astype(np.uint64) << np.uint64(40)) | (windows >> np.uint64(24)))
        distinct = np.bincount((spread >> np.uint64(40)).astype(np.int64), minlength=len(texts))
        some = np.flatnonzero(total)
        share = np.minimum(N_SHARES - 1, N_SHARES * (total - distinct)[some] // total[some])
        keys.append(some * N_FEATURES + int(n) + share)
    keys = np.unique(np.concatenate([k.astype(np.int64) for k in keys]))
    return np.bincount(keys // N_FEATURES, minlength=len(texts)), (keys % N_FEATURES).astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Documents that no label is learned from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, label, features) of the documents that are learned from.

    They are a bounded sample of those that may be: of more than MAX_TRAINING the share
    whose hashes are smallest. So their labels can be broadcast and no other text moves.
    Rows without id or label are left out; a document labelled twice takes the lower
    label, and one that comes twice is learned once, by its smallest text.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint"))
    known = known.agg(F.min(F.col("quality").cast("int")).alias("label")).where(~held_out(F.col("doc_id")))
    share = min(1.0, MAX_TRAINING / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where(~held_out(F.col("doc_id")))

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        lengths, found = _of(as_texts(rows.column("text")))
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("label"), lists(lengths, found)], ["doc_id", "label", "features"]
        )

    rows = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return rows.mapInArrow(over_batches(batch), "doc_id bigint, label int, features array<int>")


def _of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    made = [features(texts[part]) for part in slices(texts)]
    return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])


def log_count_ratios(training: DataFrame) -> np.ndarray:
    """Per feature the log of its smoothed share among label 1 against label 0."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, N_FEATURES), np.int64)
        for batch in batches:
            column = batch.column("features")
            flat = column.values.to_numpy()
            label = np.repeat(batch.column("label").to_numpy(), np.diff(column.offsets.to_numpy()))
            for y in (0, 1):
                counts[y] += np.bincount(flat[label == y], minlength=N_FEATURES)
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, counts[0, seen], counts[1, seen])], ["f", "n0", "n1"])

    rows = training.select("label", "features").mapInArrow(partial, "f bigint, n0 bigint, n1 bigint")
    found = rows.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # N_FEATURES rows at most
    counts = np.full((2, N_FEATURES), ALPHA)
    counts[0, found["f"]] += found["n0"]
    counts[1, found["f"]] += found["n1"]
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Weights of the hinge-loss model over indicators scaled by ``ratios``, the bias last.

    Dual coordinate descent: each step solves for one document's multiplier exactly, in
    the order of a fixed shuffle.
    """
    weights = np.zeros(len(ratios) + 1)
    values = []
    for row in rows:
        x = ratios[row]
        values.append(np.append(x / max(np.sqrt((x * x).sum()), 1e-9), 1.0))
    rows = [np.append(row, len(ratios)) for row in rows]
    signs = np.where(labels == 1, 1.0, -1.0)
    # Both classes weigh alike, however rare one is.
    most = COST * len(signs) / (2 * np.where(signs > 0, (signs > 0).sum(), (signs < 0).sum()))
    alpha, order = np.zeros(len(rows)), np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            row, x = rows[i], values[i]
            gradient = signs[i] * (weights[row] @ x) - 1
            changed = min(max(alpha[i] - gradient / (x @ x), 0.0), most[i])
            if changed != alpha[i]:
                weights[row] += (changed - alpha[i]) * signs[i] * x
                alpha[i] = changed
    return weights


def fit(training: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """(ratios, weights) from materialised :func:`labelled` rows; None unless both labels occur.

    The rows are a bounded sample, so the linear model is fitted in one task.
    """
    if training.select("label").distinct().count() < 2:
        return None
    ratios = log_count_ratios(training)
    shared = training.sparkSession.sparkContext.broadcast(ratios)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            column = batch.column("features")
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy()
            rows += [flat[s:e].copy() for s, e in zip(ends[:-1], ends[1:])]
            labels += batch.column("label").to_pylist()
        weights = descend(rows, np.array(labels), shared.value)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()], pa.list_(pa.float64()))], ["weights"])

    sample = training.repartition(1).sortWithinPartitions("doc_id")
    return ratios, np.array(sample.mapInArrow(solve, "weights array<double>").first()[0])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    A score is the model's margin on the text alone, pressed into 0 to 1. Null and empty
    texts have the bias as their margin. Rows without doc_id are scored and not held out.
    Without labels of both kinds every score is 0.5. Repeated rows score alike.
    """
    model = fit(checkpoint(labelled(docs, labels)))
    out = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    if model is None:
        scores = out.select("doc_id", F.lit(0.5).alias("score"))
    else:
        ratios, weights = model
        shared = docs.sparkSession.sparkContext.broadcast(
            (ratios.astype(np.float32), (ratios * weights[:-1]).astype(np.float32), float(weights[-1]))
        )

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            scale, product, bias = shared.value
            lengths, found = _of(as_texts(rows.column("text")))
            owner = np.repeat(np.arange(len(lengths)), lengths)
            dot = np.bincount(owner, product[found], len(lengths))
            norm = np.sqrt(np.bincount(owner, scale[found] ** 2, len(lengths)))
            margins = bias + dot / np.maximum(norm, 1e-9)
            score = 1 / (1 + np.exp(-SLOPE * margins))
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(score)], ["doc_id", "score"])

        scores = out.mapInArrow(over_batches(batch), "doc_id bigint, score double")
    return scores.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
