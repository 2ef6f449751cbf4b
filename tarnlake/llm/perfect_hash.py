"""Minimal perfect hashing by levels of collision-free bits (Limasset et al., 2017).

Keys that fall alone on a bit of a level own that bit; the others go to the next level. A
key's index is the number of set bits before its own, so n keys have the indexes 0 to n-1.
Foreign keys get some index too; a stored fingerprint tells them apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tarnlake.llm.hashing import mix64, salted

#: Bits per key left at each level.
ROOM = 2
FINGERPRINT_SALT = 1 << 40


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (salted(keys.view(np.uint64), FINGERPRINT_SALT) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Level sizes in bits and the bits of all levels one after the other."""

    sizes: np.ndarray
    bits: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct 64-bit keys."""
        left = mix64(keys.view(np.uint64))
        if len(np.unique(left)) != len(left):
            raise ValueError("keys must be distinct")
        sizes, parts = [], []
        while len(left):
            size = -(-ROOM * len(left) // 8) * 8
            at = (salted(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            left = left[~alone[at]]
        bits = np.packbits(np.concatenate(parts)) if parts else np.zeros(0, np.uint8)
        return cls(np.asarray(sizes, np.int64), bits)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for a key that owns no bit, which is not one of the set."""
        bit = np.unpackbits(self.bits).astype(bool)
        rank = np.cumsum(bit) - 1
        left, found = mix64(keys.view(np.uint64)), np.full(len(keys), -1, np.int64)
        open_rows, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + (salted(left[open_rows], level) % np.uint64(size)).astype(np.int64)
            own = bit[at]
            found[open_rows[own]] = rank[at[own]]
            open_rows, start = open_rows[~own], start + int(size)
        return found
