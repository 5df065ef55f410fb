"""Leading eigenvectors of a symmetric matrix by spectrum slicing.

The inertia of ``matrix - shift`` (signs of the pivots of an LDL' factorisation)
counts the eigenvalues above the shift. Bisection on these counts isolates each
leading eigenvalue, Rayleigh quotient iteration converges to it, and counts just
beside the result certify its number. The matrix is as wide as a vector, whatever
the number of rows it was made from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(np.float64).eps
#: Bunch and Kaufman's bound between pivots of one and of two rows.
ALPHA = (1 + 17 ** 0.5) / 8


@dataclass
class Factors:
    """P (matrix - shift) P' = L D L', with pivots of one or two rows."""
    low: np.ndarray
    order: np.ndarray
    pivots: list[tuple[int, np.ndarray]]

    def above(self) -> int:
        """Number of eigenvalues above the shift."""
        return sum(int(d[0, 0] > 0) if len(d) == 1 else 1 if np.linalg.det(d) < 0 else 2 * int(d[0, 0] > 0)
                   for _, d in self.pivots)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].astype(np.float64)
        for k, d in self.pivots:
            e = k + len(d)
            x[e:] -= self.low[e:, k:e] @ x[k:e]
        for k, d in self.pivots:
            x[k:k + len(d)] = np.linalg.solve(d, x[k:k + len(d)])
        for k, d in reversed(self.pivots):
            e = k + len(d)
            x[k:e] -= self.low[e:, k:e].T @ x[e:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def factorize(matrix: np.ndarray, shift: float) -> Factors:
    """LDL' of ``matrix - shift`` with partial pivoting; a pivot of zero becomes a tiny positive one."""
    n = len(matrix)
    a = matrix - shift * np.eye(n)
    tiny = max(np.abs(a).max(initial=0.0), np.finfo(np.float64).tiny) * EPS
    low, order, pivots = np.eye(n), np.arange(n), []

    def swap(i: int, j: int, done: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            low[[i, j], :done] = low[[j, i], :done]
            order[[i, j]] = order[[j, i]]

    k = 0
    while k < n:
        size, below = 1, np.abs(a[k + 1:, k])
        if len(below) and below.max() > 0 and abs(a[k, k]) < ALPHA * below.max():
            r = k + 1 + int(below.argmax())
            row = np.abs(a[k:, r])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() >= ALPHA * below.max() ** 2:
                pass
            elif abs(a[r, r]) >= ALPHA * row.max():
                swap(k, r, k)
            else:
                swap(k + 1, r, k)
                size = 2
        e = k + size
        if size == 1 and abs(a[k, k]) < tiny:
            a[k, k] = tiny
        d = a[k:e, k:e].copy()
        if e < n:
            low[e:, k:e] = np.linalg.solve(d, a[e:, k:e].T).T
            a[e:, e:] -= low[e:, k:e] @ a[k:e, e:]
        pivots.append((k, d))
        k = e
    return Factors(low, order, pivots)


@dataclass
class Eigenpair:
    number: int
    value: float
    vector: np.ndarray


class Slicer:
    """Counts of eigenvalues above shifts, each shift factorised once."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = (matrix + matrix.T) / 2
        self.size = float(np.abs(self.matrix).sum(axis=1).max(initial=0.0))  # bounds every eigenvalue
        self._counts: dict[float, int] = {self.size * (1 + 1e-9): 0, -self.size * (1 + 1e-9): len(matrix)}

    def above(self, shift: float) -> int:
        if shift not in self._counts:
            self._counts[shift] = factorize(self.matrix, shift).above()
        return self._counts[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The narrowest known (low, high] that holds eigenvalue ``number``."""
        low = max(s for s, c in self._counts.items() if c >= number)
        high = min(s for s, c in self._counts.items() if c < number and s > low)
        return low, high

    def isolate(self, number: int, width: float) -> tuple[float, float]:
        """An interval that holds eigenvalue ``number`` alone, or one of ``width`` that holds several."""
        low, high = self.around(number)
        while high - low > width and not (self.above(low) == number and self.above(high) == number - 1):
            middle = (low + high) / 2
            if middle in (low, high):
                break
            self.above(middle)
            low, high = self.around(number)
        return low, high


def _orthogonal(x: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in to:
            x = x - (q @ x) * q
    return x


def _refine(slicer: Slicer, number: int, start: np.ndarray, found: list[Eigenpair],
            steps: int = 60) -> Eigenpair:
    """Rayleigh quotient iteration inside the eigenvalue's interval.

    A quotient that leaves the interval is replaced by the middle of the interval,
    which one more count has halved.
    """
    a, noise = slicer.matrix, slicer.size * EPS
    low, high = slicer.isolate(number, 4 * len(a) * noise)
    crowd = [p.vector for p in found if low - 8 * noise <= p.value <= high + 8 * noise]
    x, shift, best = _orthogonal(start, crowd), (low + high) / 2, None
    x /= np.linalg.norm(x)
    for _ in range(steps):
        y = _orthogonal(factorize(a, shift).solve(x), crowd)
        length = np.linalg.norm(y)
        if not np.isfinite(length) or length == 0:
            shift = np.nextafter(shift, high)
            continue
        x = y / length
        value = float(x @ a @ x)
        rest = float(np.linalg.norm(a @ x - value * x))
        inside = low <= value <= high or high - low <= 8 * len(a) * noise
        if inside and (best is None or rest < best[0]):
            best = (rest, value, x)
        if inside and rest <= 2 * noise:
            break
        if not inside:
            middle = (low + high) / 2
            slicer.above(middle)
            low, high = slicer.around(number)
            shift = (low + high) / 2
        elif best is not None and rest > 0.5 * best[0] and rest <= 64 * noise and rest != best[0]:
            break
        else:
            shift = value
    _, value, x = best
    return Eigenpair(number, value, x)


def certified(slicer: Slicer, pair: Eigenpair) -> bool:
    """Whether counts beside the value give its number (or the numbers of equal ones around it)."""
    rest = float(np.linalg.norm(slicer.matrix @ pair.vector - pair.value * pair.vector))
    margin = rest + 4 * len(slicer.matrix) * slicer.size * EPS
    return slicer.above(pair.value - margin) >= pair.number > slicer.above(pair.value + margin)


def leading(matrix: np.ndarray, count: int) -> list[Eigenpair]:
    """The largest ``count`` eigenvalues with unit eigenvectors, by falling value.

    Eigenvalues that are zero to rounding are left out, so fewer may come back.
    Eigenvectors of equal eigenvalues are orthogonal, in an arbitrary but repeatable
    order. The entry of largest size (the first of equal ones) is positive.
    """
    slicer = Slicer(matrix)
    floor = 4 * len(matrix) * slicer.size * EPS
    if not slicer.size > 0:
        return []
    found: list[Eigenpair] = []
    draw = np.random.default_rng(11)
    for number in range(1, min(count, slicer.above(floor)) + 1):
        for _ in range(8):
            pair = _refine(slicer, number, draw.standard_normal(len(matrix)), found)
            if certified(slicer, pair):
                break
        else:
            raise ArithmeticError(f"eigenvalue {number} could not be certified")
        top = int(np.abs(pair.vector).argmax())
        pair.vector = pair.vector * (1 if pair.vector[top] >= 0 else -1)
        found.append(pair)
    return found
