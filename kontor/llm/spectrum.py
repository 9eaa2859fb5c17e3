"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

The factorisation P (V - s I) P' = L D L' with blocks of one and two has, by Sylvester's
law, as many positive eigenvalues in D as V has above s.  Halving an interval by such
counts isolates each eigenvalue with its number; Rayleigh quotient iteration from inside
the interval then converges cubically; counts on both sides of the result certify its
number.
"""

from __future__ import annotations

import numpy as np

# Bunch and Kaufman's constant: the growth of one 2 x 2 step equals that of two single ones.
ALPHA = (1 + np.sqrt(17)) / 8
EPSILON = np.finfo(float).eps
HALVINGS = 200


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix are greater than `shift`, by the inertia of L D L'."""
    a = matrix - shift * np.eye(len(matrix))
    n, at, positive = len(a), 0, 0
    while at < n:
        rest = a[at:, at:]
        column = np.abs(rest[1:, 0])
        size = 1
        if len(column) and column.max() > 0:
            r = int(column.argmax()) + 1
            most = column[r - 1]
            if abs(rest[0, 0]) < ALPHA * most:
                row = np.abs(rest[r])
                row[r] = 0
                wide = row.max()
                if abs(rest[0, 0]) * wide >= ALPHA * most**2:
                    pass
                elif abs(rest[r, r]) >= ALPHA * wide:
                    _swap(rest, 0, r)
                else:
                    _swap(rest, 1, r)
                    size = 2
        if size == 1:
            pivot = rest[0, 0]
            positive += bool(pivot > 0)
            if pivot:
                rest[1:, 1:] -= np.outer(rest[1:, 0], rest[1:, 0]) / pivot
        else:
            block, below = rest[:2, :2], rest[2:, :2]
            positive += 1  # such a block has one eigenvalue of each sign
            # The symmetric half of the update is enough, but rounding must not make it unsymmetric.
            update = below @ np.linalg.solve(block, below.T)
            rest[2:, 2:] -= (update + update.T) / 2
        at += size
    return positive


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def _isolated(matrix: np.ndarray, number: int, low: float, high: float, width: float) -> tuple[float, float, bool]:
    """An interval around eigenvalue `number` (from 1, falling), and whether no other lies in it."""
    over_low, over_high = len(matrix), 0
    for _ in range(HALVINGS):
        alone = over_low == number and over_high == number - 1
        if alone or high - low <= width:
            return low, high, alone
        middle = (low + high) / 2
        count = above(matrix, middle)
        if count >= number:
            low, over_low = middle, count
        else:
            high, over_high = middle, count
    return low, high, False


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the `count` largest eigenvalues that are positive, falling.

    Eigenvalues that rounding cannot tell from zero are left out.  Within equal ones any
    orthonormal vectors are right.  Each vector's largest component is positive.
    """
    n = len(matrix)
    radius = np.abs(matrix).sum(axis=1).max(initial=0.0)
    width = 4 * n * EPSILON * radius
    values, vectors = [], np.zeros((0, n))
    for number in range(1, min(count, n) + 1):
        if radius == 0 or above(matrix, width) < number:
            break
        low, high, alone = _isolated(matrix, number, 0.0, radius * (1 + 4 * EPSILON) + width, width)
        value, vector = _iterated(matrix, number, low, high, alone, vectors, width)
        values.append(value)
        vectors = np.vstack([vectors, vector * (1 if vector[np.abs(vector).argmax()] > 0 else -1)])
    return np.array(values), vectors


def _numbered(matrix: np.ndarray, number: int, value: float, width: float) -> bool:
    """Whether counts on both sides certify that eigenvalue `number` is at `value`."""
    return above(matrix, value + width) < number <= above(matrix, value - width)


def _iterated(
    matrix: np.ndarray, number: int, low: float, high: float, alone: bool, known: np.ndarray, width: float,
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration within an interval.

    Where the quotient leaves it, or ends at an eigenvalue of another number, the interval
    is halved by a count and the iteration goes on from its middle.
    """
    start = np.cos(np.arange(1, len(matrix) + 1) * (number + 0.5))  # any vector with a part in every direction
    vector, shift = _clean(start, known), (low + high) / 2
    best = None
    for _ in range(HALVINGS):
        vector = _clean(_solve(matrix, shift, vector), known)
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        inside = low - width <= value <= high + width
        if best is not None and not residual < best[0] / 2:
            break  # rounding allows no smaller residual
        if inside and residual <= 16 * width:
            if _numbered(matrix, number, value, width + residual):
                best = (residual, value, vector)
            else:
                inside, vector = False, _clean(start, known)
        if inside and residual < (high - low) / 4:
            shift = value
        elif alone and high - low > width:
            middle = (low + high) / 2
            if above(matrix, middle) >= number:
                low = middle
            else:
                high = middle
            shift = (low + high) / 2
    if best is None:
        raise ArithmeticError(f"eigenvalue {number} is not certified by its counts")
    return best[1], best[2]


def _clean(vector: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A unit vector orthogonal to the known ones."""
    for _ in range(2):
        vector = vector - known.T @ (known @ vector)
        vector = vector / np.linalg.norm(vector)
    return vector


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    """(matrix - shift I)^-1 vector; a singular matrix is moved by a rounding error."""
    n = len(matrix)
    step = EPSILON * max(abs(shift), float(np.abs(matrix).max()))
    for _ in range(8):
        try:
            solved = np.linalg.solve(matrix - shift * np.eye(n), vector)
            if np.isfinite(solved).all():
                return solved / np.abs(solved).max()
        except np.linalg.LinAlgError:
            pass
        shift, step = shift + step, 2 * step
    raise ArithmeticError("no solution at a shift beside an eigenvalue")
