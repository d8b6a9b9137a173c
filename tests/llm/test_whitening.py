"""Spectrum slicing and whitening, against numpy over all vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tillroll.llm import whitening
from tillroll.llm.spectrum import Slices, leading, positives

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, component int, n bigint"


def spectrum(kind: str, d: int) -> np.ndarray:
    rng = np.random.default_rng(d)
    return {
        "spread": rng.uniform(0, 10, d),
        "equal": np.full(d, 3.0),
        "two": np.r_[np.full(d // 2, 5.0), np.zeros(d - d // 2)],
        "decaying": np.exp(-np.arange(d, dtype=float)),
        "close": 1 + 1e-9 * np.arange(d),
        "signed": rng.uniform(-5, 5, d),
    }[kind]


def symmetric(values: np.ndarray) -> np.ndarray:
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))[0]
    made = (turn * values) @ turn.T
    return (made + made.T) / 2


@pytest.mark.parametrize("kind", ["spread", "equal", "two", "decaying", "close", "signed"])
@pytest.mark.parametrize("d", [1, 2, 5, 33, 64])
def test_leading_pairs(kind, d):
    matrix = symmetric(spectrum(kind, d))
    values, vectors = leading(matrix, 16)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(matrix))[::-1][:16], atol=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12
    assert (np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0) > 0).all()


def test_inertia_of_indefinite_and_singular_matrices():
    for kind in ("spread", "two", "signed"):
        matrix = symmetric(spectrum(kind, 20))
        exact = np.linalg.eigvalsh(matrix)
        for shift in (-7.0, -1.0, 0.5, 2.0, 4.9, 11.0):
            assert positives(matrix - shift * np.eye(20)) == (exact > shift).sum()
    assert positives(np.zeros((4, 4))) == 0
    assert positives(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


def test_slices_isolate_each_number():
    slices = Slices(symmetric(np.array([1.0, 2.0, 2.0, 8.0])))
    assert [slices.isolated(n)[2] for n in (1, 2, 3, 4)] == [1, 2, 2, 1]


def vectors() -> list[tuple]:
    rng = np.random.default_rng(7)
    made = (rng.standard_normal((300, 6)) @ rng.standard_normal((6, 20)) + rng.standard_normal((300, 20)) / 5).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # one vector holds a third
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, rows[2][1]), (7, None), (8, []), (9, [1.0] * 3), (10, [None] * 20)]
    rows += [(11, [math.nan] * 20), (12, [math.inf] + [0.0] * 19), (13, [0.0] * 19 + [-math.inf])]
    return [(i, v, 0, "x", 3, 4) for i, v in rows]


def test_whitening_against_numpy(spark):
    rows = vectors()
    found = sorted(
        (tuple(r) for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()),
        key=lambda r: (r[1], r[0] is None, r[0] or 0),
    )
    good = [(i, v) for i, v, *_ in rows if v and len(v) == 20 and all(c is not None and math.isfinite(c) for c in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0))
    x = np.floor(64 * np.array([v for _, v in good], float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, turn = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    order = values.argsort()[::-1][:16]
    expected = (x - sums / n) @ turn[:, order] / np.sqrt(values[order])
    mine = np.array([r[4] for r in found]).reshape(16, len(good)).T
    expected *= np.sign((mine * expected).sum(axis=0))
    assert np.abs(mine - expected).max() < 1e-8
    first = found[: len(good)]
    assert [r[0] for r in first] == [i for i, _ in good]
    assert [r[1] for r in found] == np.repeat(range(1, 17), len(good)).tolist()
    assert {r[2] for r in found} == {n}
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    assert [r[3] for r in first] == deviations.tolist()
    assert np.allclose([r[5] for r in found[:: len(good)]], values[order] / values.sum(), rtol=1e-9)
    assert len({r[6] for r in found}) == 1 and 0 <= found[0][6] < 1e-10


def test_no_variance_no_components(spark):
    def count(rows):
        return whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).count()

    assert count([]) == 0
    assert count([(1, None), (2, [])]) == 0
    assert count([(1, [0.5, 0.25]), (2, [0.5, 0.25])]) == 0
    # A dimension without variance is no component: one is left.
    assert count([(1, [0.5, 0.25]), (2, [0.75, 0.25]), (3, [0.5, 0.25])]) == 3


def test_far_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert {r.vec_id: r.deviation for r in found} == {1: None, 2: None, 3: (3 * 128 - 192) ** 2}
    assert all(math.isfinite(r.whitened) for r in found)
