"""Leading eigenvalues of a symmetric matrix by spectrum slicing, each with a certified number."""

from __future__ import annotations

import numpy as np

# Fixed value: growth of a symmetric factorisation is least if a pivot is this share of what it replaces.
PIVOT_SHARE = (1 + 17**0.5) / 8
EPS = float(np.finfo(float).eps)
ROUNDS = 20


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``: the positive pivots of an LDL' factorisation of ``matrix - shift``.

    Rows and columns are exchanged together, and pivots are of one row or of two, so that
    a small diagonal entry cannot spoil the rest.  By Sylvester's law the signs of the
    pivots are those of the eigenvalues.  A block of two rows is chosen only where its
    determinant is negative, and so has one pivot of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    n, k, above = len(a), 0, 0

    def exchange(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        two = False
        if k + 1 < n:
            beside = np.abs(a[k + 1 :, k])
            r = k + 1 + int(beside.argmax())
            most, own = beside[r - k - 1], abs(a[k, k])
            if own < PIVOT_SHARE * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                if own * row.max() < PIVOT_SHARE * most * most:
                    two = abs(a[r, r]) < PIVOT_SHARE * row.max()
                    exchange(k + two, r)
        if two:
            side = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(a[k : k + 2, k : k + 2], side.T)
            above += 1
            k += 2
        else:
            pivot, side = a[k, k], a[k + 1 :, k].copy()
            if pivot:
                a[k + 1 :, k + 1 :] -= np.outer(side, side / pivot)
            above += bool(pivot > 0)
            k += 1
    return above


class Slices:
    """Shifts that were counted, and intervals between them that hold an eigenvalue of a given number."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.n = matrix, len(matrix)
        radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        self.scale = float(np.abs(matrix).sum(axis=1).max()) if self.n else 0.0
        self.least = 8 * max(self.n, 4) * EPS * self.scale
        low, high = (np.diag(matrix) - radius).min(), (np.diag(matrix) + radius).max()
        self.counts = {float(low - self.least): self.n, float(high + self.least): 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.matrix, shift)
        return self.counts[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The narrowest interval so far with eigenvalue ``number`` in it."""
        low = max(s for s, n in self.counts.items() if n >= number)
        return low, min(s for s, n in self.counts.items() if n < number and s > low)

    def alone(self, number: int) -> tuple[float, float]:
        """An interval that holds no eigenvalue but that one, or is too narrow to be cut."""
        low, high = self.around(number)
        while high - low > self.least and self.count(low) - self.count(high) > 1:
            self.count((low + high) / 2)
            low, high = self.around(number)
        return low, high

    def narrower(self, number: int) -> tuple[float, float]:
        low, high = self.around(number)
        self.count((low + high) / 2)
        return self.around(number)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, nudge: float) -> np.ndarray:
    while True:
        try:
            found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(found).all():
                return found
        except np.linalg.LinAlgError:
            pass
        shift += nudge
        nudge *= 2


def _apart(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vectors = vectors - others @ (others.T @ vectors)
    return vectors


def _of_one(slices: Slices, number: int, start: np.ndarray) -> tuple[float, np.ndarray]:
    """The eigenvalue alone in its interval, by Rayleigh quotient iteration from inverse iteration at its middle."""
    matrix, nudge = slices.matrix, EPS * slices.scale
    low, high = slices.around(number)
    while True:
        x = start
        for _ in range(2):
            x = _solved(matrix, (low + high) / 2, x, nudge)
            x /= np.linalg.norm(x)
        value, left = float(x @ matrix @ x), np.inf
        for _ in range(ROUNDS):
            y = _solved(matrix, value, x, nudge)
            y /= np.linalg.norm(y)
            value_y = float(y @ matrix @ y)
            now = float(np.linalg.norm(matrix @ y - value_y * y))
            if now >= left:
                break
            x, value, left = y, value_y, now
        if low - slices.least <= value <= high + slices.least and left <= slices.least:
            return value, x
        if high - low <= slices.least:
            raise ArithmeticError(f"no eigenvector was found for eigenvalue {number}")
        low, high = slices.narrower(number)


def _of_several(slices: Slices, low: float, high: float, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues too close to be told apart, with orthogonal vectors, by inverse iteration of them all."""
    x = np.linalg.qr(start)[0]
    for _ in range(4):
        x = np.linalg.qr(_solved(slices.matrix, (low + high) / 2, x, EPS * slices.scale))[0]
    # Within the space found, the quotients of single vectors: the space is exact to rounding, any basis is.
    values = np.einsum("ij,ij->j", x, slices.matrix @ x)
    order = np.argsort(-values)
    return values[order], x[:, order]


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit vectors as columns.

    Those that rounding cannot tell from zero or below it are left out.  The counts
    beside each value certify its number; an ArithmeticError tells where they do not.
    A count takes about n**3 / 3 operations.
    """
    n = len(matrix)
    values, vectors = np.zeros(0), np.zeros((n, 0))
    if not n or not np.abs(matrix).any():
        return values, vectors
    slices = Slices(matrix)
    wanted = min(most, slices.count(slices.least))
    random = np.random.default_rng(0)
    while len(values) < wanted:
        number = len(values) + 1
        low, high = slices.alone(number)
        several = slices.count(low) - slices.count(high)
        if several > 1:
            found, own = _of_several(slices, low, high, _apart(random.standard_normal((n, several)), vectors))
        else:
            value, x = _of_one(slices, number, random.standard_normal(n))
            found, own = np.array([value]), x[:, None]
        close = vectors[:, np.abs(values - found.mean()) < 1e-3 * slices.scale]
        own = np.linalg.qr(_apart(own, close))[0]
        values, vectors = np.append(values, found), np.hstack([vectors, own])
        if slices.count(float(found.min()) - slices.least) < len(values) or slices.count(float(found.max()) + slices.least) >= number:
            raise ArithmeticError(f"the counts do not confirm eigenvalue {number}")
    return values[:wanted], vectors[:, :wanted]
