"""Singular values of a small triangular matrix by the quotient-difference algorithm.

The matrix is made bidiagonal by Householder reflections. The squares of its
entries are quotients and differences, whose transforms (dqds: differential,
with shifts) have the squared singular values as their limit, each to high
relative accuracy, since nothing is subtracted but the shift. A shift is the
reciprocal of the trace of the inverse, which a transform gives on the way and
which never exceeds the smallest value left. Singular vectors come from twisted
factorisations of the tridiagonal matrix less a value: elimination from above
and from below meets in the row where the remainder is least.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = 1e-30  # of a matrix scaled to 1, far below what shows beside it


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``matrix @ V`` an orthogonal times the bidiagonal."""
    a = np.array(matrix, np.float64)
    n = a.shape[1]
    right = np.eye(n)
    for k in range(n):
        for own, turned in ((a[k:, k], False), (a[k, k + 1 :], True)):
            if np.linalg.norm(own[1:]) <= TINY:
                own[1:] = 0.0
                continue
            v = own.copy()
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            v /= np.linalg.norm(v)
            if turned:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
            else:
                a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _transform(q: list, e: list, shift: float) -> tuple[list, list, list] | None:
    """One step of dqds: new quotients, differences and remainders; None if the shift is too large."""
    d, new_q, new_e, left = q[0] - shift, [], [], []
    for i, step in enumerate(e):
        if d < 0:
            return None
        left.append(d)
        total = d + step
        ratio = q[i + 1] / total if total > 0 else 1.0
        new_q.append(total)
        new_e.append(step * ratio)
        d = (d * ratio if total > 0 else q[i + 1]) - shift
    if d < 0:
        return None
    return [*new_q, d], new_e, [*left, d]


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of an upper bidiagonal matrix, falling."""
    blocks = [((np.asarray(diagonal) ** 2).tolist(), (np.asarray(above) ** 2).tolist(), 0.0)]
    found: list[float] = []
    while blocks:
        q, e, sigma = blocks.pop()
        most = 100 * len(q)
        while q:
            most -= 1
            if most < 0:
                raise ArithmeticError("the transforms do not converge")
            cut = next((i for i in range(len(e)) if e[i] <= EPS**2 * (sigma + q[i])), None)
            if len(q) == 1 or cut == len(e) - 1:
                found.append(sigma + q.pop())
                if e:
                    e.pop()
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # turned round, small values come off at the end
                q, e = q[::-1], e[::-1]
            q, e, left = _transform(q, e, 0.0)
            if min(left) > 0:
                shift = (1 - 1e-14) / sum(1 / d for d in left)
                stepped = _transform(q, e, shift)
                if stepped is not None:
                    q, e, _ = stepped
                    sigma += shift
            else:  # a value that is exactly the shift so far has come to the end
                e[-1] = 0.0 if left[-1] == 0 else e[-1]
    return np.array(sorted(found, reverse=True))


def _twisted(main: np.ndarray, side: np.ndarray, value: float) -> np.ndarray:
    """The unit vector for ``value`` of a symmetric tridiagonal matrix without a zero in ``side``."""
    n, tiny = len(main), EPS**2 * (abs(main).max() + abs(value) + 1e-300)
    down, up = main - value, main - value
    for i in range(1, n):
        down[i] -= side[i - 1] ** 2 / (down[i - 1] or tiny)
    for i in range(n - 2, -1, -1):
        up[i] -= side[i] ** 2 / (up[i + 1] or tiny)
    twist = int(np.argmin(abs(down + up - (main - value))))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -side[i] * z[i + 1] / (down[i] or tiny)
    for i in range(twist + 1, n):
        z[i] = -side[i - 1] * z[i - 1] / (up[i] or tiny)
    return z / np.linalg.norm(z)


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and unit right vectors as columns."""
    n = matrix.shape[1]
    scale = abs(matrix).max() if matrix.size else 0.0
    if not scale:
        return np.zeros(n), np.eye(n)
    diagonal, above, right = bidiagonal(matrix / scale)
    largest = max(abs(diagonal).max(), abs(above).max() if n > 1 else 0.0)
    above[abs(above) <= EPS * largest * 1e-2] = 0.0
    diagonal[abs(diagonal) <= EPS * largest * 1e-2] = 0.0
    main = diagonal**2
    main[1:] += above**2
    side = diagonal[:-1] * above
    pairs, start = [], 0
    for end in [*np.flatnonzero(side == 0) + 1, n]:
        own = slice(start, end)
        if above[start - 1 : start].any() and start:  # coupled with a row that is zero on the diagonal
            values = _tridiagonal_values(main[own], side[start : end - 1])
        else:
            values = squared_values(diagonal[own], above[start : end - 1])
        for value in values:
            z = np.zeros(n)
            z[own] = _twisted(main[own], side[start : end - 1], value)
            pairs.append((value, z))
        start = end
    pairs.sort(key=lambda p: -p[0])
    values, vectors = np.array([p[0] for p in pairs]), np.stack([p[1] for p in pairs], axis=1)
    vectors = _apart(main, side, values, vectors)
    return values * scale**2, right @ vectors


def _tridiagonal_values(main: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Values of a block whose first row has more than its own quotient, by its Cholesky factor."""
    q, e = [main[0]], []
    for i in range(len(side)):
        e.append(side[i] ** 2 / q[-1] if q[-1] > 0 else 0.0)
        q.append(max(main[i + 1] - e[-1], 0.0))
    return squared_values(np.sqrt(q), np.sqrt(e))


def _apart(main: np.ndarray, side: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The vectors, those of values too near to be told apart by twisting made orthogonal."""
    n, start = len(values), 0
    for end in range(1, n + 1):
        if end < n and values[end - 1] - values[end] <= 1e-3 * values[0]:
            continue
        own = vectors[:, start:end]
        if end - start > 1 and abs(own.T @ own - np.eye(end - start)).max() > 1e-13:
            basis, size = np.linalg.qr(own)
            weak = abs(np.diag(size)) < 1e-8
            if weak.any():  # two of them fell together: what all the others leave over
                rest = np.concatenate([vectors[:, :start], vectors[:, end:], basis[:, ~weak]], axis=1)
                basis[:, weak] = np.linalg.svd(rest.T)[2][-int(weak.sum()) :].T
                basis = np.linalg.qr(basis)[0]
            small = basis.T @ (main[:, None] * basis)
            cross = basis[:-1].T @ (side[:, None] * basis[1:])
            turn = np.linalg.eigh(small + cross + cross.T)[1][:, ::-1]
            vectors[:, start:end] = basis @ turn
        start = end
    return vectors
