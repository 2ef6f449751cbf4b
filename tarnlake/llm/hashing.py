"""64-bit hashing over numpy arrays; wrap-around multiplication is what it is for."""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads close keys over 64 bits."""
    x = values.astype(np.uint64, copy=True)
    x += GOLDEN
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(values: np.ndarray, salt: int) -> np.ndarray:
    """Another hash function of the same keys for each ``salt``."""
    with np.errstate(over="ignore"):
        return mix64(values ^ mix64(np.asarray([salt], dtype=np.uint64))[0])


def unit(values: np.ndarray) -> np.ndarray:
    """Hashes as numbers strictly between 0 and 1."""
    return ((values >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / 9007199254740992.0)


def uniform_of(*keys: int) -> float:
    """A number between 0 and 1 that depends on integer keys alone."""
    state = 0
    for key in keys:
        state = _mix_int(state ^ (key & _MASK))
    return ((state >> 11) + 0.5) / 9007199254740992.0


_MASK = (1 << 64) - 1


def _mix_int(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)
