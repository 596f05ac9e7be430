"""Leading eigenvalues and eigenvectors of a symmetric matrix: tridiagonal form, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
#: Neighbouring eigenvalues closer than this share of the norm are one cluster, whose vectors are kept orthogonal.
CLUSTER = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that lead there; the k-th acts on entries k + 1 and up."""
    a, reflectors = np.array(a, float), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        v[0] += np.copysign(length, v[0])
        size = np.linalg.norm(v)
        reflectors.append(v := v / size if size else v)
        if not size:
            continue
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = -2 * v[0] * (v @ a[k + 1 :, k]) + a[k + 1, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: eigenvalues below each value of ``at``, as negative pivots of the shifted matrix."""
    least = np.finfo(float).tiny / _EPS + _EPS**2 * np.max(off**2, initial=0)
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, e2 in zip(diagonal[1:], off**2):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - at - e2 / pivot
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected down to neighbouring floating-point numbers."""
    reach = np.abs(np.concatenate((off, [0]))) + np.abs(np.concatenate(([0], off)))
    n, slack = len(diagonal), _EPS * np.max(np.abs(diagonal) + reach)
    low = np.full(count, np.min(diagonal - reach) - slack)
    high = np.full(count, np.max(diagonal + reach) + slack)
    wanted = n - np.arange(count)
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        at_least = count_below(diagonal, off, middle) >= wanted
        high = np.where(open_ & at_least, middle, high)
        low = np.where(open_ & ~at_least, middle, low)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray, least: float) -> np.ndarray:
    """Solution of the shifted tridiagonal system, by elimination with row exchanges; pivots under ``least`` are raised."""
    n = len(diagonal)
    d, up, up2, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), rhs.copy()
    for k in range(n - 1):
        below = off[k]
        if abs(below) > abs(d[k]):
            factor = d[k] / below
            d[k], x[k], x[k + 1] = below, x[k + 1], x[k] - factor * x[k + 1]
            up[k], d[k + 1] = d[k + 1], up[k] - factor * d[k + 1]
            up2[k], up[k + 1] = up[k + 1], -factor * up[k + 1]
        else:
            d[k] = d[k] if abs(d[k]) > least else least
            factor = below / d[k]
            d[k + 1] -= factor * up[k]
            x[k + 1] -= factor * x[k]
    for k in range(n - 1, -1, -1):
        if abs(d[k]) < least:
            d[k] = np.copysign(least, d[k])
        x[k] -= (up[k] * x[k + 1] if k + 1 < n else 0) + (up2[k] * x[k + 2] if k + 2 < n else 0)
        x[k] /= d[k]
    return x


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) for falling ``values`` by inverse iteration, orthogonal within each cluster."""
    norm = np.max(np.abs(diagonal)) + 2 * np.max(np.abs(off), initial=0)
    least, random = max(_EPS * norm, np.finfo(float).tiny), np.random.Generator(np.random.PCG64(5))
    out, begin = np.empty((len(diagonal), len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            begin = k
        x = random.standard_normal(len(diagonal))
        for _ in range(rounds):
            x = _solve(diagonal, off, value, x / np.linalg.norm(x), least)
            for _ in range(2):
                x /= np.linalg.norm(x)
                x -= out[:, begin:k] @ (out[:, begin:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_eigenvectors(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    size = np.max(np.abs(a))
    if not size:
        return np.zeros(min(count, len(a))), np.eye(len(a))[:, :count]
    diagonal, off, reflectors = tridiagonal(a / size)
    values = leading_values(diagonal, off, min(count, len(diagonal)))
    vectors = vectors_of(diagonal, off, values)
    for k, v in reversed(list(enumerate(reflectors))):
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * size, vectors
