"""Leading eigenpairs of a symmetric matrix: Householder, Sturm counts, bisection and inverse iteration, in numpy."""

from __future__ import annotations

import numpy as np

EPSILON = np.finfo(float).eps
# Eigenvalues closer than this share of the matrix's size are one cluster, whose vectors are kept at right angles.
CLUSTER = 1e-3
STEPS = 5


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors): Householder reflections that leave a tridiagonal matrix.

    Reflector k mirrors the coordinates from k + 1 on; a column that is tridiagonal already has none (zeros).
    """
    a = np.array(matrix, float)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        length = np.linalg.norm(v)
        if np.linalg.norm(x[1:]) <= EPSILON * EPSILON * size or length == 0:
            reflectors.append(np.zeros_like(v))
            continue
        v /= length
        reflectors.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0.0
        a[k + 1, k] = -np.copysign(size, x[0])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def unreflected(y: np.ndarray, reflectors: list[np.ndarray]) -> np.ndarray:
    """Vectors (as columns) of the tridiagonal matrix, turned back to the coordinates of the first one."""
    out = y.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        out[k + 1 :] -= 2 * np.outer(v, v @ out[k + 1 :])
    return out


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: the negative pivots of T - x."""
    squares = np.r_[0.0, off * off]
    tiny = max(np.finfo(float).tiny / EPSILON, EPSILON * EPSILON * float(squares.max(initial=0.0)))
    count = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for d, s in zip(diagonal, squares):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each halved in until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.r_[np.abs(off), 0.0] + np.r_[0.0, np.abs(off)]
    size = float((np.abs(diagonal) + reach).max())
    low = np.full(k, float((diagonal - reach).min()) - EPSILON * size)
    high = np.full(k, float((diagonal + reach).max()) + EPSILON * size)
    below = n - 1 - np.arange(k)  # the i-th largest has so many below it
    while True:
        middle = low + (high - low) / 2
        moving = (middle > low) & (middle < high) & (high - low > 2 * EPSILON * np.maximum(np.abs(low), np.abs(high)) + EPSILON**2 * size)
        if not moving.any():
            return high
        less = sturm_counts(diagonal, off, middle) <= below
        low = np.where(moving & less, middle, low)
        high = np.where(moving & ~less, middle, high)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """y of (T - shift) y = right, by elimination with exchange of neighbouring rows; vanishing pivots become ``tiny``."""
    n = len(diagonal)
    main, upper, second = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
    lower, y = off.tolist(), right.tolist()
    for i in range(n - 1):
        if abs(lower[i]) > abs(main[i]):
            factor = main[i] / lower[i]
            main[i], old_upper = lower[i], upper[i]
            upper[i], main[i + 1] = main[i + 1], old_upper - factor * main[i + 1]
            second[i], upper[i + 1] = upper[i + 1], -factor * upper[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(main[i]) < tiny:
                main[i] = tiny
            factor = lower[i] / main[i]
            main[i + 1] -= factor * upper[i]
            y[i + 1] -= factor * y[i]
    if abs(main[-1]) < tiny:
        main[-1] = tiny
    for i in range(n - 1, -1, -1):
        rest = y[i]
        if i + 1 < n:
            rest -= upper[i] * y[i + 1]
        if i + 2 < n:
            rest -= second[i] * y[i + 2]
        y[i] = rest / main[i]
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix to its falling ``values``.

    Values of a cluster are set a little apart, and each vector is made orthogonal to the cluster's
    earlier ones in every step, so that equal values get vectors at right angles too.
    """
    n = len(diagonal)
    size = float(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0)) or 1.0
    draws = np.random.default_rng(13)
    out = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * size:
            first = j
        shift = value if j == first else min(value, shift - 10 * EPSILON * size)
        y = draws.standard_normal(n)
        for _ in range(STEPS):
            y /= np.abs(y).max() or 1.0
            y = solve_shifted(diagonal, off, shift, y, EPSILON * size)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= out[:, first:j] @ (out[:, first:j].T @ y)
            y /= np.linalg.norm(y)
        out[:, j] = y
    return out


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``k`` largest eigenvalues of a symmetric matrix, falling, and unit vectors as columns."""
    k = min(k, len(matrix))
    if k == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scale = float(np.abs(matrix).max())
    if scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    return values * scale, unreflected(inverse_iteration(diagonal, off, values), reflectors)
