"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, Sturm counts
with bisection for the values, inverse iteration with reorthogonalisation inside clusters
for the vectors. The matrix has the size of a vector squared, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLUSTER = 1e-3  # values closer than this share of the norm are kept orthogonal by hand
ROUNDS = 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit reflectors that lead there, in their order."""
    a = np.array(matrix, dtype=float)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if not np.any(v[1:]):
            reflectors.append(np.zeros_like(v))
            continue
        end = -np.copysign(size, v[0])
        v[0] -= end
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = end
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def values_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: the negative pivots of T - point."""
    least = EPS * EPS * max(1.0, float(np.max(np.abs(off), initial=0)))
    pivot, below = np.inf, np.zeros(len(points), dtype=int)
    for d, e in zip(diagonal, [0.0, *off]):
        pivot = d - points - e * e / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, each cut down until its interval cannot shrink."""
    n = len(diagonal)
    radius = np.zeros(n)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    margin = EPS * n * max(np.max(np.abs(diagonal) + radius), np.finfo(float).tiny)
    low = np.full(count, np.min(diagonal - radius) - margin)
    high = np.full(count, np.max(diagonal + radius) + margin)
    rank = n - 1 - np.arange(count)  # so many values are smaller
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = values_below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


class Shifted:
    """T - shift, factored with row exchanges, for many shifts at once (one a column)."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray):
        n, k = len(diagonal), len(shifts)
        self.main = diagonal[:, None] - shifts
        self.up = np.repeat(np.append(off, 0.0)[:, None], k, 1)
        self.up2 = np.zeros((n, k))
        self.factor, self.swapped = np.zeros((n, k)), np.zeros((n, k), dtype=bool)
        for i in range(n - 1):
            swap = np.abs(off[i]) > np.abs(self.main[i])
            first = np.where(swap, off[i], self.main[i])
            second = np.where(swap, self.main[i], off[i])
            up = np.where(swap, self.main[i + 1], self.up[i])
            below = np.where(swap, self.up[i], self.main[i + 1])
            up2 = np.where(swap, self.up[i + 1], 0.0)
            next_up = np.where(swap, 0.0, self.up[i + 1])
            factor = np.divide(second, first, out=np.zeros(k), where=first != 0)
            self.main[i], self.up[i], self.up2[i] = first, up, up2
            self.main[i + 1], self.up[i + 1] = below - factor * up, next_up - factor * up2
            self.factor[i], self.swapped[i] = factor, swap
        # A pivot of nothing is replaced by what rounding could have left of it.
        least = EPS * max(np.max(np.abs(diagonal)), np.max(np.abs(off), initial=0))
        self.main = np.where(np.abs(self.main) < least, np.copysign(least, self.main), self.main)

    def solve(self, right: np.ndarray) -> np.ndarray:
        x, n = right.copy(), len(right)
        for i in range(n - 1):
            first = np.where(self.swapped[i], x[i + 1], x[i])
            second = np.where(self.swapped[i], x[i], x[i + 1])
            x[i], x[i + 1] = first, second - self.factor[i] * first
        x[-1] /= self.main[-1]
        for i in range(n - 2, -1, -1):
            after = self.up2[i] * x[i + 2] if i + 2 < n else 0.0
            x[i] = (x[i] - self.up[i] * x[i + 1] - after) / self.main[i]
        return x


def clusters(values: np.ndarray, norm: float) -> list[range]:
    starts = [0, *(i for i in range(1, len(values)) if values[i - 1] - values[i] > CLUSTER * norm)]
    return [range(a, b) for a, b in zip(starts, [*starts[1:], len(values)])]


def orthogonal(vectors: np.ndarray, groups: list[range]) -> np.ndarray:
    """Unit columns; those of a cluster orthogonal to the ones before them (twice is enough)."""
    for group in groups:
        for i in group:
            before = vectors[:, group.start : i]
            for _ in range(2):
                vectors[:, i] -= before @ (before.T @ vectors[:, i])
                vectors[:, i] /= np.linalg.norm(vectors[:, i])
    return vectors


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    n, k = len(diagonal), len(values)
    norm = max(np.max(np.abs(diagonal)), np.max(np.abs(off), initial=0))
    if norm == 0:
        return np.eye(n)[:, :k]
    groups = clusters(values, norm)
    # Equal values get shifts that differ by what rounding may move them.
    factored = Shifted(diagonal, off, values - np.arange(k) * 2 * EPS * norm)
    vectors = np.random.default_rng(0).standard_normal((n, k))
    for _ in range(ROUNDS):
        vectors = factored.solve(vectors)
        vectors /= np.max(np.abs(vectors), axis=0)
        vectors = orthogonal(vectors, groups)
    return vectors


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as rows. A vector's
    largest entry is positive."""
    scale = np.max(np.abs(matrix), initial=0.0)
    if scale == 0:
        return np.zeros(count), np.eye(len(matrix))[:count]
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, count)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for k in reversed(range(len(reflectors))):
        v = reflectors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    top = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(count)]
    return values * scale, (vectors * np.sign(top)).T
