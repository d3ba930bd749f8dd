"""Singular values and right singular vectors of a small square matrix.

Householder reflections make it upper bidiagonal, dqds finds its singular values, and a twisted
factorisation for each of them gives its vector. All loops are over the width of the matrix.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
CLOSE = 1e-3
"""Relative gap of squared singular values below which vectors are made orthogonal to each other."""
TRIES = 60
"""Transforms per singular value; three are usual. More than this means a matrix that is not finite."""


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and V with ``U.T @ matrix @ V`` upper bidiagonal.

    The reflections of the rows are gathered in V; those of the columns (U) are not needed.
    """
    work = np.array(matrix, float)
    d = work.shape[1]
    right = np.eye(d)
    for k in range(d):
        _reflect(work[k:, k:], work[k:, k].copy())
        if k + 2 < d:
            mirror = _reflect(work[k:, k + 1 :].T, work[k, k + 1 :].copy())
            if mirror is not None:
                right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ mirror, 2 * mirror)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _reflect(block: np.ndarray, column: np.ndarray) -> np.ndarray | None:
    """Turn ``column`` of ``block`` to the first axis, in place; the unit vector of the mirror, if any."""
    size = np.linalg.norm(column[1:])
    if not size:
        return None
    column[0] += np.copysign(np.hypot(column[0], size), column[0])
    column /= np.linalg.norm(column)
    block -= np.outer(2 * column, column @ block)
    return column


def singular_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling: differential quotient differences.

    The squares q and e of both diagonals are transformed with a shift that is below the smallest
    value; only sums, products and quotients of positive numbers occur, so small values come out
    with the relative accuracy of large ones. A shift that proves too large is taken back.
    """
    blocks = [(a.astype(float) ** 2, b.astype(float) ** 2, 0.0)]
    found: list[float] = []
    limit = (100 * EPS) ** 2
    while blocks:
        q, e, shift = blocks.pop()
        for _ in range(TRIES * max(len(q), 1)):
            if len(q) < 2:
                break
            gone = np.flatnonzero((e <= limit * (shift + q[1:])) | (e <= limit * q[:-1]))
            if len(gone):
                k = int(gone[-1])
                blocks.append((q[: k + 1].copy(), e[:k].copy(), shift))
                q, e = q[k + 1 :].copy(), e[k + 1 :].copy()
                continue
            if q[0] < q[-1]:
                q, e = q[::-1].copy(), e[::-1].copy()
            guess = _smallest(q, e)
            step = None
            while step is None:
                step = _quotients(q, e, guess)
                guess_used, guess = guess, guess / 4 if guess > EPS * q.min() else 0.0
            q, e = step
            shift += guess_used
        else:
            raise ArithmeticError("singular values do not settle; is the matrix finite?")
        if len(q):
            found.append(shift + q[0])
    return np.sort(np.maximum(found, 0.0))[::-1]


def _smallest(q: np.ndarray, e: np.ndarray) -> float:
    """A guess at the smallest value, from the last two rows; a bit below it as they converge."""
    trace, low = q[-2] + e[-1] + q[-1], q[-2] * q[-1]
    root = trace * trace / 4 - low
    return low / (trace / 2 + np.sqrt(max(root, 0.0))) * (1 - 1e-9) if trace else 0.0


def _quotients(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One transform, or None if the shift is above the smallest value."""
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = q[0] - shift
    for k in range(len(e)):
        if shift and not d > 0:
            return None
        new_q[k] = d + e[k]
        ratio = q[k + 1] / new_q[k] if new_q[k] else 0.0
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
    if d < 0 or np.isnan(d):
        return None
    new_q[-1] = d
    return new_q, new_e


def singular_vectors(a: np.ndarray, b: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Unit right singular vectors of a bidiagonal matrix, one column for each of ``squares`` (falling).

    B.T B is L D L.T with D = a^2 and l = b / a. For a value s the two factorisations of
    L D L.T - s, from the top and from the bottom, meet where the rest is smallest, and the vector
    follows from there by products. Vectors of close values are made orthogonal to each other.
    """
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    tiny = EPS * EPS * size or 1.0
    a = np.where(np.abs(a) < tiny, tiny, a)
    d, low = a * a, b / a[:-1]
    out = np.zeros((len(a), len(squares)))
    # values below this are zero to the precision of the matrix, and all close to each other
    noise = (EPS * size * len(a)) ** 2
    start = 0
    for k, s in enumerate(squares):
        if k and squares[k - 1] - s > max(CLOSE * squares[k - 1], noise):
            start = k
        z = _twisted(d, low, s)
        for turn in range(6):
            z = _apart(z, out[:, start:k])
            norm = np.linalg.norm(z)
            if norm > 0.1:
                break
            # too near to the others of its group: another start, through an inverse step beside s
            z = np.random.default_rng(turn).standard_normal(len(a))
            for _ in range(2):
                z = _inverse(d, low, (s + noise) * (1 + 8 * EPS * (turn + 1)), _apart(z, out[:, start:k]))
            z /= np.linalg.norm(z)
        # what rounding leaves of all earlier ones; those of larger values are the surer ones
        z = _apart(z / np.linalg.norm(z), out[:, :k])
        out[:, k] = z / np.linalg.norm(z)
    return out


def _apart(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    return z - others @ (others.T @ z) if others.shape[1] else z


def _factors(d: np.ndarray, low: np.ndarray, s: float) -> tuple[np.ndarray, ...]:
    """Both factorisations of L D L.T - s and the rest at every place."""
    n = len(d)
    tiny = np.finfo(float).tiny / EPS
    plus, down, up = np.empty(n), np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    top, bottom = np.empty(n), np.empty(n)
    top[0] = -s
    for i in range(n - 1):
        plus[i] = top[i] + d[i] or tiny
        down[i] = d[i] * low[i] / plus[i]
        top[i + 1] = down[i] * low[i] * top[i] - s
    plus[-1] = top[-1] + d[-1] or tiny
    bottom[-1] = d[-1] - s
    for i in range(n - 2, -1, -1):
        minus = d[i] * low[i] * low[i] + bottom[i + 1] or tiny
        ratio = d[i] / minus
        up[i] = low[i] * ratio
        bottom[i] = bottom[i + 1] * ratio - s
    return plus, down, up, top + bottom + s


def _twisted(d: np.ndarray, low: np.ndarray, s: float) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        _, down, up, rest = _factors(d, low, s)
        rest = np.where(np.isfinite(rest), np.abs(rest), np.inf)
    k = int(np.argmin(rest))
    z = np.zeros(len(d))
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, len(d) - 1):
        z[i + 1] = -up[i] * z[i]
    z = np.where(np.isfinite(z), z, 0.0)
    return z / np.linalg.norm(z)


def _inverse(d: np.ndarray, low: np.ndarray, s: float, z: np.ndarray) -> np.ndarray:
    """``z`` through the inverse of L D L.T - s, up to its size."""
    plus, down, _, _ = _factors(d, low, s)
    z = z.copy()
    for i in range(len(z) - 1):
        z[i + 1] -= down[i] * z[i]
    z /= plus
    for i in range(len(z) - 2, -1, -1):
        z[i] -= down[i] * z[i + 1]
    return z / np.abs(z).max()


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and their right singular vectors as columns.

    Where the superdiagonal vanishes the parts are taken one by one, as their values have nothing to
    do with each other. The entry of a vector that is largest (the first on ties) is positive.
    """
    a, b, right = bidiagonal(matrix)
    n = len(a)
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * size) + 1), n]
    squares, vectors = [], np.zeros((n, n))
    for start, end in zip(cuts, cuts[1:]):
        own = singular_squares(a[start:end], b[start : end - 1])
        vectors[start:end, start:end] = singular_vectors(a[start:end], b[start : end - 1], own)
        squares.extend(own)
    order = np.argsort(-np.array(squares), kind="stable")
    vectors = right @ vectors[:, order]
    peak = np.argmax(np.abs(vectors).round(12), axis=0)
    vectors *= np.where(vectors[peak, np.arange(n)] < 0, -1.0, 1.0)
    return np.array(squares)[order], vectors
