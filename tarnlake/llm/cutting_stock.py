"""Cutting stock by column generation, over a histogram of sizes (Gilmore and Gomory, 1961).

The sizes of the problem are bounded by the capacity, whatever the number of pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Pattern:
    """How many pieces of each class one bin takes, and how many bins look so."""

    counts: np.ndarray
    times: int


def best_pattern(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The pattern of most value that fits: an unbounded knapsack by dynamic programming.

    ``sizes`` ascend and are at least 1.
    """
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = fitting[room]
        if n:
            worth = best[room - sizes[:n]] + value[:n]
            top = int(worth.argmax())
            if worth[top] > best[room]:
                best[room], choice[room] = worth[top], top
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return counts, float(best[capacity])


def relaxed(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 5e-4, most: int = 4000
) -> tuple[np.ndarray, np.ndarray]:
    """Basic solution of the linear program: patterns as columns, and how often each is used.

    Revised simplex from one pattern per class. The duals price columns, the knapsack finds
    the best one, and the program ends when none is worth more than a bin or when the bound
    that the best one implies is within ``gap``.
    """
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    cost = np.ones(n)
    use = inverse @ demand
    for _ in range(most):
        duals = cost @ inverse
        worst = int(duals.argmin())
        if duals[worst] < -1e-9:  # more of a class than asked for does no harm
            column, price = np.zeros(n), 0.0
            column[worst] = -1.0
        else:
            counts, worth = best_pattern(sizes, np.maximum(duals, 0), capacity)
            if worth <= 1 + 1e-9 or (cost @ use) * (1 - 1 / worth) <= gap * max(cost @ use, 1.0):
                break
            column, price = counts.astype(float), 1.0
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(n, np.inf)
        ratio[up] = use[up] / direction[up]
        leaving = int(ratio.argmin())
        inverse[leaving] /= direction[leaving]
        others = np.arange(n) != leaving
        inverse[others] -= np.outer(direction[others], inverse[leaving])
        step = max(ratio[leaving], 0.0)
        use = np.maximum(use - step * direction, 0.0)
        use[leaving] = step
        basis[:, leaving], cost[leaving] = column, price
    pattern = (cost > 0) & (use > 1e-9)
    return basis[:, pattern].round().astype(np.int64), use[pattern]


def first_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Bins for what rounding leaves, each filled with the largest classes that still fit."""
    left, bins = demand.astype(np.int64).copy(), []
    while left.any():
        counts, room = np.zeros(len(sizes), np.int64), capacity
        for i in np.flatnonzero(left)[::-1]:
            take = min(int(left[i]), room // int(sizes[i]))
            counts[i], room = take, room - take * int(sizes[i])
        left -= counts
        bins.append(counts)
    return bins


def cut(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns and times that hold all of ``demand``: the program's, rounded down, and the rest."""
    used = demand > 0
    plan: list[Pattern] = []
    if not used.any():
        return plan
    columns, times = relaxed(sizes[used], demand[used].astype(float), capacity)
    left = demand[used].astype(np.int64).copy()
    for column, often in zip(columns.T, np.floor(times + 1e-9).astype(np.int64), strict=True):
        if often > 0:
            plan.append(Pattern(column, int(often)))
            left = np.maximum(left - column * often, 0)
    merged: dict[bytes, Pattern] = {}
    for counts in first_fit(sizes[used], left, capacity):
        merged.setdefault(counts.tobytes(), Pattern(counts, 0)).times += 1
    plan.extend(merged.values())
    for pattern in plan:
        counts = np.zeros(len(sizes), np.int64)
        counts[used] = pattern.counts
        pattern.counts = counts
    return plan
