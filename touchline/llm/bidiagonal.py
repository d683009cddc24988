"""Singular values and right singular vectors of one small triangular matrix.

Householder reflections from both sides leave an upper bidiagonal B.  The squares of its
entries are a qd array, from which dqds (differential quotient-difference with shifts) takes
the squared singular values one by one, each to high relative accuracy.  The vector of a value
comes from the twisted factorisation of B'B minus that value: one factorisation from above and
one from below meet where the twist is smallest.  Values that lie close together get their
vectors made orthogonal by one-sided rotations.  The matrix has as many rows and columns as the
vectors have dimensions, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_TINY = np.finfo(float).tiny
_CLOSE = 1e-3  # relative gap below which vectors are made orthogonal to each other


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V with R = U B V'."""
    a = np.array(r, float)
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        _reflect(a[k:, k:])
        if k < n - 2:
            u = _reflect(a[k:, k + 1 :].T)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _reflect(part: np.ndarray) -> np.ndarray:
    """Clear the first column of ``part`` below its first entry, in place; the unit vector."""
    u = part[:, 0].copy()
    size = np.linalg.norm(u)
    if not size:
        return np.zeros_like(u)
    u[0] += np.copysign(size, u[0])
    u /= np.linalg.norm(u)
    part -= 2 * np.outer(u, u @ part)
    part[1:, 0] = 0.0
    return u


def _dqds_step(
    q: np.ndarray, e: np.ndarray, shift: float
) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One transform with the smallest d before the last and the last d; none may be negative."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    low = np.inf
    for i in range(n - 1):
        low = min(low, d)
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] else 0.0
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    new_q[-1] = d
    return new_q, new_e, low, d


def _shifted(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One dqds transform and its shift, by the smaller eigenvalue of the last two rows.

    Where only the last d turns negative, the shift plus that d is a close lower bound of the
    smallest value, so the next try is nearly always good; no shift is always good.
    """
    a, b = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    shift = (a + b) / 2 - np.hypot((a - b) / 2, np.sqrt(q[-2] * e[-1]))
    for _ in range(4):
        if shift <= 0:
            break
        new_q, new_e, low, last = _dqds_step(q, e, shift)
        if low >= 0 and last >= 0:
            return new_q, new_e, shift
        shift = shift + last if low >= 0 else shift / 4
    new_q, new_e, _, _ = _dqds_step(q, e, 0.0)
    return new_q, new_e, 0.0


def squared_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B by dqds, in falling order."""
    found: list[float] = []
    blocks = [(diagonal**2, upper**2, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while len(q):
            if len(q) == 1 or e[-1] <= _EPS**2 * (moved + q[-1]) or e[-1] <= _TINY:
                found.append(q[-1] + moved)
                q, e = q[:-1], e[:-1]
                continue
            split = np.flatnonzero(e <= np.maximum(_EPS**2 * (moved + np.minimum(q[:-1], q[1:])), _TINY))
            if len(split):
                at = split[-1] + 1
                blocks.append((q[:at], e[: at - 1], moved))
                q, e = q[at:], e[at:]
                continue
            if 1.5 * q[0] < q[-1]:  # read backwards: small values are found at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            q, e, shift = _shifted(q, e)
            moved += shift
    return np.sort(np.array(found))[::-1]


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue, twisted where the remainder is smallest.

    With B'B = L D L', the stationary transform factors L D L' - value from above and the
    progressive one from below, both on the factors themselves, so that vectors of small
    values are as good as those of large ones.
    """
    n = len(diagonal)
    least = _EPS * max(np.abs(diagonal).max(), _TINY) * _EPS
    a = np.where(np.abs(diagonal) < least, least, diagonal)
    d, low = a**2, upper / a[:-1]
    above, below = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    above[0] = -value
    for i in range(n - 1):
        pivot = (above[i] + d[i]) or _TINY
        down[i] = d[i] * low[i] / pivot
        above[i + 1] = down[i] * low[i] * above[i] - value
    below[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = (d[i] * low[i] ** 2 + below[i + 1]) or _TINY
        up[i] = low[i] * (d[i] / pivot)
        below[i] = below[i + 1] * (d[i] / pivot) - value
    twist = int(np.argmin(np.abs(above + below + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _orthogonal(r: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Vectors of close values, orthogonal to each other and with orthogonal images under R."""
    rng = np.random.default_rng(3)
    vectors, _ = np.linalg.qr(vectors + 1e-14 * rng.standard_normal(vectors.shape))
    k = vectors.shape[1]
    for _ in range(30):
        image, worst = r @ vectors, 0.0
        for i in range(k - 1):
            for j in range(i + 1, k):
                x, y = image[:, i], image[:, j]
                cross, nx, ny = x @ y, x @ x, y @ y
                if abs(cross) <= 4 * _EPS * np.sqrt(nx * ny):
                    continue
                worst = max(worst, abs(cross))
                t = (ny - nx) / (2 * cross)
                t = np.copysign(1.0, t) / (abs(t) + np.hypot(1.0, t))
                c = 1 / np.hypot(1.0, t)
                turn = np.array([[c, c * t], [-c * t, c]])
                vectors[:, [i, j]] = vectors[:, [i, j]] @ turn
                image[:, [i, j]] = image[:, [i, j]] @ turn
        if not worst:
            break
    return vectors


def right_singular(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of R in falling order, and the right vectors of the first ones.

    Vectors are columns.  There are as many as ``wanted``, or as the numerical rank of R.
    """
    diagonal, upper, v = bidiagonalise(r)
    values = squared_values(diagonal, upper)
    top = values[0] if len(values) else 0.0
    rank = int((values > top * (len(r) * _EPS) ** 2).sum()) if top > 0 else 0
    k = min(wanted, rank)
    vectors = np.zeros((len(r), 0))
    start = 0
    while start < k:
        stop = start + 1  # the whole run of close values, also beyond those wanted
        while stop < rank and values[stop - 1] - values[stop] <= _CLOSE * values[stop - 1]:
            stop += 1
        own = v @ _run_vectors(diagonal, upper, values[start:stop])
        if stop - start > 1:
            own = _orthogonal(r, own)
            own = own[:, np.argsort(-((r @ own) ** 2).sum(axis=0), kind="stable")]
        vectors = np.hstack([vectors, own])
        start = stop
    return values, vectors[:, :k]


def _run_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Twisted vectors of one run of close values; equal values take the parts of a split B in turn."""
    cuts = np.flatnonzero(np.abs(upper) <= _EPS * np.abs(diagonal).max())
    edges = [0, *(cuts + 1), len(diagonal)]
    if len(values) == 1:
        return twisted_vector(diagonal, upper, values[0])[:, None]
    candidates = []
    for low, high in zip(edges, edges[1:], strict=False):
        for value in values:
            own = np.zeros(len(diagonal))
            part = twisted_vector(diagonal[low:high], upper[low : high - 1], value)
            own[low:high] = part
            left = diagonal[low:high] * part
            left[:-1] += upper[low : high - 1] * part[1:]
            miss = abs(left @ left - value)
            candidates.append((miss, own))
    candidates.sort(key=lambda c: c[0])
    basis = np.zeros((len(diagonal), 0))
    for _, own in candidates:
        rest = own - basis @ (basis.T @ own)
        size = np.linalg.norm(rest)
        if size > 1e-8 and basis.shape[1] < len(values):
            basis = np.hstack([basis, (rest / size)[:, None]])
    return basis
