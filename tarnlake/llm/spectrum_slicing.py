"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

By Sylvester's law, as many eigenvalues of A lie above a shift as the diagonal factor of
A - shift = L D Lᵀ has positive ones. Such counts cut the line until an interval holds one
leading eigenvalue (or is as narrow as rounding); Rayleigh quotient iteration converges to its
vector cubically; a count on either side of what it found certifies its number.
"""

from __future__ import annotations

import numpy as np

#: Bunch and Parlett's bound between single and double pivots.
ALPHA = (1 + 17**0.5) / 8
EPS = np.finfo(np.float64).eps


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``.

    Those of D in P(A - shift)Pᵀ = L D Lᵀ, with the complete pivoting of Bunch and Parlett
    (1971): D has single pivots and double ones, each of which has one positive eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diagonal(a))
        single = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        row, column = divmod(int(off.argmax()), n)
        largest = off[row, column]
        if diagonal[single] == 0 and largest == 0:
            return positive  # what is left is zero: eigenvalues at the shift
        if diagonal[single] >= ALPHA * largest:
            keep = np.arange(n) != single
            pivot, side = a[single, single], a[keep, single]
            positive += pivot > 0
            a = a[np.ix_(keep, keep)] - np.outer(side, side / pivot)
        else:
            keep = np.ones(n, bool)
            keep[[row, column]] = False
            block, side = a[np.ix_([row, column], [row, column])], a[np.ix_(keep, [row, column])]
            positive += 1
            a = a[np.ix_(keep, keep)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return int(positive)


def _interval(matrix: np.ndarray, number: int, low: float, high: float, width: float) -> tuple[float, float]:
    """An interval with eigenvalue ``number`` (from the top, from 1) and no other, if they are apart.

    ``number`` eigenvalues at least are above ``low``, fewer above ``high``.
    """
    below = above(matrix, low)
    over = above(matrix, high)
    while (below != number or over != number - 1) and high - low > width:
        middle = (low + high) / 2
        count = above(matrix, middle)
        if count >= number:
            low, below = middle, count
        else:
            high, over = middle, count
    return low, high


def _apart(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
    """``vector`` without what it has of the orthonormal rows ``found``, at unit length."""
    for _ in range(2):
        vector = vector - found.T @ (found @ vector)
    return vector / np.linalg.norm(vector)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    while True:
        try:
            return np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:  # an eigenvalue to the last digit
            shift += EPS * scale


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, at most ``most``, and their unit vectors as rows.

    Only eigenvalues above rounding are given: a matrix of lower rank has fewer. Equal ones
    have any orthonormal vectors of their space. A vector's largest entry is positive. Raises
    ArithmeticError where the counts do not bear a number out.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((0, n))
    rounding = 8 * n * EPS * scale
    wanted = min(most, above(matrix, rounding))
    random = np.random.default_rng(n)
    values, vectors = np.zeros(0), np.zeros((0, n))
    top = scale * (1 + 4 * EPS)
    for number in range(1, wanted + 1):
        low, high = _interval(matrix, number, 0.0, top, rounding)
        while True:
            shift = (low + high) / 2
            vector = _apart(random.standard_normal(n), vectors)
            for _ in range(2):  # at a fixed shift, into the interval's own direction
                vector = _apart(_solved(matrix, shift, vector, scale), vectors)
            for _ in range(30):
                value = float(vector @ matrix @ vector)
                if np.linalg.norm(matrix @ vector - value * vector) <= n * EPS * scale:
                    break
                vector = _apart(_solved(matrix, value, vector, scale), vectors)
            value = float(vector @ matrix @ vector)
            inside = low - rounding <= value <= high + rounding
            if inside and above(matrix, value + rounding) < number <= above(matrix, value - rounding):
                break
            if high - low <= rounding:
                raise ArithmeticError(f"eigenvalue {number} is not where the counts say")
            for _ in range(4):
                low, high = _halved(matrix, number, low, high)
        vectors = np.vstack([vectors, vector * np.sign(vector[np.abs(vector).argmax()])])
        values = np.r_[values, value]
    falling = np.argsort(-values, kind="stable")  # equal ones differ by rounding
    return values[falling], vectors[falling]


def _halved(matrix: np.ndarray, number: int, low: float, high: float) -> tuple[float, float]:
    middle = (low + high) / 2
    return (middle, high) if above(matrix, middle) >= number else (low, middle)
