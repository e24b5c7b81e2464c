"""Singular values and right singular vectors of a small matrix: Householder bidiagonalisation, dqds, twisted factorisations.

These run on the driver over a triangular factor, whose size is that of one vector squared, however many rows made it.
"""

from __future__ import annotations

import math

import numpy as np

EPSILON = float(np.finfo(float).eps)
# An off-diagonal entry this small beside its neighbour, in squares, no longer changes singular values.
NEGLIGIBLE = (10 * EPSILON) ** 2
# Squares of singular values nearer than this share are treated as a cluster: their vectors are found together.
CLUSTER = 1e-3
# A singular value below this share of the largest, times the size, is no direction but rounding.
RANK = 4 * EPSILON


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, upper diagonal and the reflections from the right that lead there, for a square matrix."""
    work = np.array(matrix, float)
    n = len(work)
    reflections: list[np.ndarray] = []
    for k in range(n):
        left = reflection(work[k:, k])
        work[k:, k:] -= np.outer(2 * left, left @ work[k:, k:])
        right = np.zeros(0)
        if k < n - 2:
            right = reflection(work[k, k + 1 :])
            work[k:, k + 1 :] -= np.outer(work[k:, k + 1 :] @ right, 2 * right)
        reflections.append(right)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), reflections


def reflection(column: np.ndarray) -> np.ndarray:
    """The unit vector whose reflection turns a column into a multiple of the first axis; zeros if it already is one."""
    scale = np.abs(column).max(initial=0.0)
    if scale == 0 or not np.any(column[1:]):
        return np.zeros(len(column))
    vector = column / scale
    vector[0] += math.copysign(np.linalg.norm(vector), vector[0])
    return vector / np.linalg.norm(vector)


def reflected_back(vectors: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """Vectors (as columns) of the bidiagonal matrix as vectors of the matrix it came from."""
    out = np.array(vectors, float)
    for k in range(len(reflections) - 1, -1, -1):
        right = reflections[k]
        if len(right):
            out[k + 1 :] -= np.outer(2 * right, right @ out[k + 1 :])
    return out


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> list[float]:
    """Squares of the singular values, falling, each accurate in its own digits: differential qd sweeps with shifts.

    A sweep without a shift shows the diagonal of the inverse, whose trace bounds the smallest value from below; that
    bound is the next shift, so that no sweep goes past a value.
    """
    blocks = [([float(a) ** 2 for a in diagonal], [float(b) ** 2 for b in upper], 0.0)]
    found: list[float] = []
    while blocks:
        q, e, shift = blocks.pop()
        cut = next((i for i, x in enumerate(e) if x <= NEGLIGIBLE * min(shift + q[i], shift + q[i + 1])), None)
        if len(q) == 1:
            found.append(q[0] + shift)
        elif cut is not None:
            blocks += [(q[: cut + 1], e[:cut], shift), (q[cut + 1 :], e[cut + 1 :], shift)]
        else:
            step = least_bound(q, e)
            swept = sweep(q, e, step)
            while swept is None:
                # Rounding went past the value after all.
                step = step / 2 if step > EPSILON * shift else 0.0
                swept = sweep(q, e, step)
            blocks.append((*swept, shift + step))
    return sorted(found, reverse=True)


def least_bound(q: list[float], e: list[float]) -> float:
    """A number that the smallest value is not below."""
    d, inverse = q[0], 0.0
    for i in range(len(e)):
        if d <= 0:
            return 0.0
        inverse += 1 / d
        d *= q[i + 1] / (d + e[i])
    return (1 - 8 * EPSILON) / (inverse + 1 / d) if d > 0 and math.isfinite(inverse + 1 / d) else 0.0


def sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds sweep; None if the shift was above the smallest value."""
    d, new_q, new_e = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        pivot = d + e[i]
        ratio = q[i + 1] / pivot
        new_q.append(pivot)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*new_q, d], new_e)


def factors(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """Both factorisations of the squared bidiagonal matrix less ``value``: pivots and multipliers from the top (L D L'),
    from the bottom (U D U'), and for every place the last pivot of the one that is twisted there."""
    n, tiny = len(a), max(EPSILON * abs(value), 1e-300)
    q, e, ab = a**2, b**2, a[:-1] * b
    top, lower, s = np.empty(n), np.empty(n - 1), np.empty(n)
    bottom, upper, p = np.empty(n), np.empty(n - 1), np.empty(n)
    s[0], p[-1] = -value, q[-1] - value
    for i in range(n - 1):
        top[i] = s[i] + q[i] or tiny
        lower[i] = ab[i] / top[i]
        s[i + 1] = e[i] * (s[i] / top[i]) - value
    top[-1] = s[-1] + q[-1] or tiny
    for i in range(n - 2, -1, -1):
        bottom[i + 1] = e[i] + p[i + 1] or tiny
        upper[i] = ab[i] / bottom[i + 1]
        p[i] = p[i + 1] * (q[i] / bottom[i + 1]) - value
    bottom[0] = p[0] or tiny
    return top, lower, bottom, upper, s + p + value


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of one value that no other comes near, from the factorisation twisted at its least pivot."""
    n = len(a)
    _, lower, _, upper, gamma = factors(a, b, value)
    at = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def together(a: np.ndarray, b: np.ndarray, values: list[float]) -> np.ndarray:
    """Orthonormal vectors (columns) of values that lie close together or are equal: inverse iteration of all at once."""
    n, count = len(a), len(values)
    top, lower, *_ = factors(a, b, values[-1] * (1 - 4 * EPSILON))
    block = np.random.default_rng(count).standard_normal((n, count))
    for _ in range(6):
        block = np.linalg.qr(block)[0]
        for i in range(n - 1):
            block[i + 1] -= lower[i] * block[i]
        block /= top[:, None]
        for i in range(n - 2, -1, -1):
            block[i] -= lower[i] * block[i + 1]
        block /= np.abs(block).max(axis=0)
    block = np.linalg.qr(block)[0]
    image = a[:, None] * block
    image[:-1] += b[:, None] * block[1:]
    # Within the block, directions by falling size.
    return block @ np.linalg.svd(image, full_matrices=False)[2].T


def leading_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares of the largest singular values, their right vectors as columns), at most ``count`` and the rank.

    Every vector's entry of largest size, the first of equals, is positive.
    """
    n = matrix.shape[1]
    square = np.zeros((max(matrix.shape), n))
    square[: len(matrix)] = matrix
    scale = np.abs(square).max(initial=0.0)
    if n == 0 or scale == 0:
        return np.zeros(0), np.zeros((n, 0))
    if len(square) > n:
        square = np.linalg.qr(square, mode="r")
    a, b, reflections = bidiagonal(square / scale)
    values = squared_singular_values(a, b)
    values = [v for v in values if v > (RANK * n) ** 2 * values[0]]
    columns: list[np.ndarray] = []
    at = 0
    while at < min(count, len(values)):
        to = at + 1
        while to < len(values) and values[to - 1] - values[to] <= CLUSTER * values[to - 1]:
            to += 1
        if to == at + 1:
            columns.append(twisted(a, b, values[at])[:, None])
        else:
            columns.append(together(a, b, values[at:to]))
        at = to
    vectors = reflected_back(np.hstack(columns), reflections)[:, :count]
    signs = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0))
    return np.array(values[: vectors.shape[1]]) * scale**2, vectors * signs
