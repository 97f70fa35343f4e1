"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, Sturm counts, inverse iteration.

Plain numpy on one small matrix (dimensions squared), the driver's share of ``whitening``.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors): Q' a Q is tridiagonal, Q the product of I - 2 u u' over the reflectors.

    Reflector k acts on rows k+1 and below; one that has nothing to clear is a zero vector.
    """
    a = np.array(a, dtype=np.float64)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        u = x.copy()
        scale = np.abs(x[1:]).max(initial=0.0)
        if scale == 0.0:
            reflectors.append(np.zeros_like(u))
            continue
        u /= max(scale, abs(x[0]))  # against overflow in the norm
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        u /= np.linalg.norm(u)
        below = a[k + 1:, k + 1:]
        p = below @ u
        p -= (u @ p) * u
        below -= 2.0 * (np.outer(u, p) + np.outer(p, u))
        column = x - 2.0 * u * (u @ x)
        a[k + 1:, k] = a[k, k + 1:] = column
        reflectors.append(u)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def sturm_count(d: np.ndarray, e2: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value in ``at`` (signs of the LDL' pivots)."""
    count = np.zeros(len(at), dtype=np.int64)
    pivot = np.ones(len(at))
    for i in range(len(d)):
        pivot = d[i] - at - (e2[i - 1] / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection on Sturm counts until an interval holds no further double."""
    n, off = len(d), np.abs(np.concatenate([[0.0], e, [0.0]]))
    radius = off[:-1] + off[1:]
    lo, hi = (d - radius).min(), (d + radius).max()
    span = max(abs(lo), abs(hi), np.finfo(np.float64).tiny)
    lo, hi = np.full(k, lo - span * EPS * n), np.full(k, hi + span * EPS * n)
    rank, e2, tiny = n - np.arange(k), np.square(e), span * EPS * EPS  # the rank-th smallest is wanted
    tiny = max(tiny, np.finfo(np.float64).tiny)
    while True:
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi)
        if not open_.any():
            return hi
        above = sturm_count(d, e2, mid, tiny) >= rank
        lo, hi = np.where(open_ & ~above, mid, lo), np.where(open_ & above, mid, hi)


def _solver(d: np.ndarray, e: np.ndarray, shift: float, tiny: float):
    """Gaussian elimination with partial pivoting of the shifted tridiagonal matrix, as a function solving for a right side."""
    n = len(d)
    main, up, up2 = d - shift, np.append(e, 0.0), np.zeros(n)
    swap, factor = np.zeros(n, dtype=bool), np.zeros(n)
    low = np.append(e, 0.0)
    for i in range(n - 1):
        if abs(low[i]) > abs(main[i]):
            swap[i] = True
            factor[i] = main[i] / low[i]
            main[i], nxt = low[i], main[i + 1]
            up[i], main[i + 1] = nxt, up[i] - factor[i] * nxt
            up2[i], up[i + 1] = up[i + 1], -factor[i] * up[i + 1]
        else:
            main[i] = main[i] if abs(main[i]) > tiny else tiny
            factor[i] = low[i] / main[i]
            main[i + 1] -= factor[i] * up[i]
    main[n - 1] = main[n - 1] if abs(main[n - 1]) > tiny else tiny

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for i in range(n - 1):
            if swap[i]:
                b[i], b[i + 1] = b[i + 1], b[i] - factor[i] * b[i + 1]
            else:
                b[i + 1] -= factor[i] * b[i]
        for i in range(n - 1, -1, -1):
            b[i] = (b[i] - (up[i] * b[i + 1] if i + 1 < n else 0.0) - (up2[i] * b[i + 2] if i + 2 < n else 0.0)) / main[i]
        return b

    return solve


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration.

    Values closer than a thousandth of the norm form a cluster, within which
    every iterate is made orthogonal to the vectors found before. Equal values
    are shifted apart by a few units in the last place, so that their
    iterations do not run into the same vector.
    """
    n, norm = len(d), max(np.abs(d).max(initial=0.0) + 2 * np.abs(e).max(initial=0.0), np.finfo(np.float64).tiny)
    tiny, out = EPS * norm, np.zeros((n, len(values)))
    rng, first, shift = np.random.default_rng(0), 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = value if shift is None or first == j else min(value, shift - 4 * EPS * norm)
        solve = _solver(d, e, shift, tiny)
        v = rng.uniform(0.5, 1.5, n) * np.where(np.arange(n) % 2, -1.0, 1.0)
        near = out[:, first:j]
        for _ in range(6):
            v = solve(v / np.abs(v).max())
            v /= np.abs(v).max()
            for _ in range(2):  # twice is enough
                v -= near @ (near.T @ v)
            v /= np.linalg.norm(v)
        out[:, j] = v
    return out


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    n = len(a)
    k = min(k, n)
    if k == 0:
        return np.zeros(0), np.zeros((n, 0))
    scale = np.abs(a).max()
    if scale == 0.0:
        return np.zeros(k), np.eye(n)[:, :k]
    d, e, reflectors = tridiagonalise(a / scale)
    values = leading_values(d, e, k)
    vectors = tridiagonal_vectors(d, e, values)
    for i in range(len(reflectors) - 1, -1, -1):
        u = reflectors[i]
        vectors[i + 1:] -= 2.0 * np.outer(u, u @ vectors[i + 1:])
    return values * scale, vectors
