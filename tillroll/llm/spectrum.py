"""Leading eigenpairs of a symmetric matrix by spectrum slicing."""

from __future__ import annotations

import math

import numpy as np

EPSILON = float(np.finfo(float).eps)
#: Below this share of the largest entry off the diagonal, a pivot of two rows grows less than one of one.
_ALPHA = (1 + math.sqrt(17)) / 8
#: Steps after which an iteration that does not settle is given up; three or four are usual.
_STEPS = 60


def positives(matrix: np.ndarray) -> int:
    """How many eigenvalues are above zero: the positive pivots of the LDL' factorisation.

    The inertia of D is that of the matrix. Pivots are chosen over the whole remainder, one
    or two rows at a time; one of two rows has an eigenvalue of either sign.
    """
    a, found = np.array(matrix, float), 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        one = int(diagonal.argmax())
        size = size - np.diag(diagonal)
        p, q = divmod(int(size.argmax()), len(a))
        if diagonal[one] == 0 and size[p, q] == 0:
            break
        if diagonal[one] >= _ALPHA * size[p, q]:
            pivot, rest = a[one, one], np.arange(len(a)) != one
            column = a[rest, one]
            found += pivot > 0
            a = a[np.ix_(rest, rest)] - np.outer(column / pivot, column)
        else:
            pair, rest = [p, q], np.ones(len(a), bool)
            rest[pair] = False
            columns = a[np.ix_(rest, pair)]
            found += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
    return int(found)


class Slices:
    """The line cut at shifts, each with the number of eigenvalues above it."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1).max(initial=0.0) or 1.0  # holds every eigenvalue
        self.scale = float(radius)
        self.slack = 16 * len(matrix) * EPSILON * self.scale  # what rounding moves an eigenvalue by, at most
        self.above = {-1.1 * self.scale: len(matrix), 1.1 * self.scale: 0}

    def count(self, shift: float) -> int:
        if shift not in self.above:
            self.above[shift] = positives(self.matrix - shift * np.eye(len(self.matrix)))
        return self.above[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue of this number."""
        low = max(s for s, n in self.above.items() if n >= number)
        return low, min(s for s, n in self.above.items() if n < number and s > low)

    def halve(self, number: int) -> None:
        low, high = self.around(number)
        self.count((low + high) / 2)

    def middle(self, number: int) -> float:
        low, high, _ = self.isolated(number)
        return (low + high) / 2

    def certifies(self, number: int, value: float) -> bool:
        """True if the counts just below and above the value say that it has this number."""
        return self.count(value + self.slack) < number <= self.count(value - self.slack)

    def isolated(self, number: int) -> tuple[float, float, int]:
        """An interval of this eigenvalue, and how many it holds: one, or more if doubles cannot part them."""
        while True:
            low, high = self.around(number)
            held = self.count(low) - self.count(high)
            if held == 1 or high - low <= 16 * EPSILON * self.scale:
                return low, high, held
            self.halve(number)


def _orthogonal(vectors: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vectors = vectors - found @ (found.T @ vectors)
    return np.linalg.qr(vectors)[0]


def _shifted_solve(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    while True:
        try:
            solved = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(solved).all():
                return solved
        except np.linalg.LinAlgError:
            pass
        shift += 2 * EPSILON * scale  # exactly singular: the shift is an eigenvalue


def _alone(slices: Slices, number: int, found: np.ndarray) -> np.ndarray:
    # Rayleigh quotient iteration. A quotient outside the interval, or one that settles on an
    # eigenvalue of another number at its edge, narrows the interval, and another vector begins there.
    matrix, random = slices.matrix, np.random.default_rng(number)
    start = lambda: _orthogonal(random.standard_normal((len(matrix), 1)), found)
    vector, shift, best, settled = start(), slices.middle(number), math.inf, None
    for _ in range(_STEPS):
        vector = _orthogonal(_shifted_solve(matrix, shift, vector, slices.scale), found)
        value = float((vector.T @ matrix @ vector)[0, 0])
        low, high, _ = slices.isolated(number)
        left = float(np.linalg.norm(matrix @ vector - value * vector))
        if not low - slices.slack <= value <= high + slices.slack:
            pass
        elif left < best:
            best, settled, shift = left, vector, value
            continue
        elif best > 64 * EPSILON * slices.scale:
            shift = value
            continue
        elif slices.certifies(number, value):  # and no step makes it better any more
            return settled
        slices.halve(number)
        vector, shift, best = start(), slices.middle(number), math.inf
    raise ArithmeticError(f"eigenvalue {number} does not settle")


def _together(slices: Slices, number: int, held: int, found: np.ndarray) -> np.ndarray:
    # Equal eigenvalues: any basis of their space.
    space = _orthogonal(np.random.default_rng(number).standard_normal((len(found), held)), found)
    for _ in range(4):
        space = _orthogonal(_shifted_solve(slices.matrix, slices.middle(number), space, slices.scale), found)
    return space


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Inertia counts bisect the line until an interval holds one eigenvalue; Rayleigh quotient
    iteration then finds it, and counts just below and above it certify its number. Equal
    eigenvalues get an orthonormal basis of their space. Each vector's largest entry is
    positive (the first of equal ones). Raises ArithmeticError if a number is not certified.
    """
    n = len(matrix)
    k = min(k, n)
    slices, found = Slices(matrix), np.zeros((n, 0))
    while found.shape[1] < k:
        number = found.shape[1] + 1
        held = slices.isolated(number)[2]
        if held == 1:
            more = _alone(slices, number, found)
        else:
            more = _together(slices, number, held, found)
        found = np.hstack([found, more])
    found = found[:, :k]
    values = np.einsum("ij,ij->j", found, matrix @ found)
    for number, value in enumerate(values, 1):
        if not slices.certifies(number, float(value)):
            raise ArithmeticError(f"eigenvalue {number} is not certified")
    largest = np.abs(found).argmax(axis=0)
    return values, found * np.where(found[largest, np.arange(k)] < 0, -1.0, 1.0)
