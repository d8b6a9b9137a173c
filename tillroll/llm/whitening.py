"""Whitening of embeddings over the leading components of their covariance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import over_batches
from tillroll.llm.spectrum import EPSILON, leading
from tillroll.session import checkpoint

#: An entry c counts as floor(STEP * c) + SHIFT.
STEP, SHIFT = 64, 1_000_000
#: Entries beyond this count as it: further on, doubles have no halves.
_FURTHEST = float(1 << 52)
COMPONENTS = 16

WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)
_SUMS = "i int, j int, value double"
_COUNTS = "i int, j int, value bigint"


def steps(embedding: Column) -> Column:
    """The entries as whole numbers of steps."""

    def step(entry):
        scaled = F.least(F.greatest(entry.cast("double") * STEP, F.lit(-_FURTHEST)), F.lit(_FURTHEST))
        return F.floor(scaled) + SHIFT

    return F.transform(embedding, step)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector is there and has finite entries only, in steps."""

    def finite(entry):
        value = entry.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    kept = rows.where(F.col("embedding").isNotNull() & F.coalesce(F.forall("embedding", finite), F.lit(False)))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), steps(F.col("embedding")).alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Per length of vectors: how many (j = -1), and the sum of each entry.
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        lengths = np.diff(batch.column("x").offsets.to_numpy())
        for size in np.unique(lengths):
            x = _matrix(batch.column("x").filter(pa.array(lengths == size)))
            held = sums.setdefault(int(size), np.zeros(size + 1, np.int64))
            held[0] += len(x)
            held[1:] += x.sum(axis=0)
    for size, held in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size + 1, size), pa.int32()), pa.array(np.arange(-1, size), pa.int32()), pa.array(held)],
            ["i", "j", "value"],
        )


def _products(centre: np.ndarray, turned: np.ndarray | None) -> Callable:
    """Per partition the products of the centred vectors, after ``turned`` if given, summed, and their sums (j = -1).

    Sums of whole numbers are exact up to 2 ** 53, so these do not depend on order or partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sums = None
        for batch in batches:
            if batch.num_rows:
                x = (_matrix(batch.column("x")) - centre).astype(float)
                x = x if turned is None else x @ turned
                product, sum_ = x.T @ x, x.sum(axis=0)
                total, sums = (product, sum_) if total is None else (total + product, sums + sum_)
        if total is not None:
            d = len(total)
            i, j = np.triu_indices(d)
            columns = [np.concatenate([i, np.arange(d)]), np.concatenate([j, np.full(d, -1)])]
            values = np.concatenate([total[i, j], sums])
            arrays = [*(pa.array(c, pa.int32()) for c in columns), pa.array(values)]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "value"])

    return run


def _gathered(vectors: DataFrame, centre: np.ndarray, d: int, turned: np.ndarray | None = None) -> tuple:
    # Only d * (d + 1) / 2 sums come to the driver, whatever the number of vectors.
    each = vectors.mapInArrow(_products(centre, turned), _SUMS)
    product, sums = np.zeros((d, d)), np.zeros(d)
    for i, j, value in each.groupBy("i", "j").agg(F.sum("value")).collect():
        if j < 0:
            sums[i] = value
        else:
            product[i, j] = product[j, i] = value
    return product, sums


class Whitening:
    """Fitted components: what :meth:`rows` needs, a few vectors of the embeddings' length."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.d = n, len(sums)
        self.centre = np.array([round(s / n) if abs(s) < 1 << 53 else s // n for s in sums], np.int64)
        self.left = [s - n * int(c) for s, c in zip(sums, self.centre)]  # of the sums, after the centre
        self.values, self.explained = values, values / trace if trace else values
        self.turned = vectors / np.sqrt(values)
        self.identity_error = 0.0

    def _deviation(self, x: np.ndarray) -> list[int | None]:
        # Exact: in 64 bits if they surely hold it, else with Python's integers.
        largest = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.left), default=0)
        if largest * largest * max(1, self.d) < 1 << 63:
            return ((x * self.n - np.array(self.left, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((int(v) * self.n - s) ** 2 for v, s in zip(row, self.left)) for row in x]
        return [v if v < 1 << 63 else None for v in exact]

    def rows(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column("x")) - self.centre
        k = len(self.values)
        mean = np.array([s / self.n for s in self.left])
        white = (x - mean) @ self.turned
        repeated = np.repeat(np.arange(len(x)), k)
        columns = [
            batch.column("vec_id").take(pa.array(repeated)),
            pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
            pa.array(np.full(len(repeated), self.n, np.int64)),
            pa.array(self._deviation(x), pa.int64()).take(pa.array(repeated)),
            pa.array(white.ravel()),
            pa.array(np.tile(self.explained, len(x))),
            pa.array(np.full(len(repeated), self.identity_error)),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in WHITENED.split(", ")])


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The ``k`` leading components of distinct vectors ``x`` (a materialised table), None without any.

    Vectors of the most frequent length take part (the longest of equally frequent ones). Three
    passes: counts and sums; the covariance, centred before it is multiplied; and the covariance
    of the whitened vectors, whose distance from the identity is measured. Components without
    variance, to the precision of doubles, are left out. Of a vector of length d, d * d / 2 sums
    reach the driver, which slices the spectrum.
    """
    totals = vectors.mapInArrow(_totals, _COUNTS).groupBy("i", "j").agg(F.sum("value")).collect()
    counts = {size: n for size, j, n in totals if j < 0 and size > 0}
    if not counts:
        return None
    d = max(counts, key=lambda size: (counts[size], size))
    places = {j: value for size, j, value in totals if size == d}
    n, sums = places[-1], [places[j] for j in range(d)]
    model = Whitening(n, sums, np.ones(d), np.eye(d), 0.0)
    same = vectors.where(F.size("x") == d)
    product, _ = _gathered(same, model.centre, d)
    mean = np.array([s / n for s in model.left])
    covariance = product / n - np.outer(mean, mean)  # the centre is within half a step of the mean
    trace = float(np.trace(covariance))
    values, columns = leading(covariance, k)
    used = values > 4 * d * EPSILON * max(values[0], 0.0)
    if not used.any():
        return None
    model = Whitening(n, sums, values[used], columns[:, used], trace)
    product, total = _gathered(same, model.centre, int(used.sum()), model.turned)
    shift = total / n
    model.identity_error = float(np.abs(product / n - np.outer(shift, shift) - np.eye(len(shift))).max())
    return model


def whitened(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    Rows whose vector is null, empty, of another length than most, or holds a null or non-finite
    entry are dropped. Repeated rows, and rows without vec_id, are kept each, while the fit takes
    each distinct vector once. ``deviation`` is exact, null beyond 64 bits. Without variance, as
    of an empty table or one vector, there are no components and no rows. Columns other than
    ``vec_id`` and ``embedding`` are not read.
    """
    kept = usable(rows)
    model = fit(checkpoint(kept.select("x").distinct()), k)
    if model is None:
        return kept.limit(0).mapInArrow(over_batches(lambda batch: None), WHITENED)
    return kept.where(F.size("x") == model.d).mapInArrow(over_batches(model.rows), WHITENED)
