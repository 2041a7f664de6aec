"""A minimal perfect hash of 128-bit digests in flat arrays."""

from __future__ import annotations

import numpy as np

#: Places of a level for each digest that is still without a slot.
SPREAD = 2
# Odd multipliers that spread bits over a word.
_ODD = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))


def _places(x: np.ndarray, y: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(2 * level + 1)
    h = x * (_ODD[0] * salt) + y * (_ODD[1] ^ (salt << np.uint64(8)))
    h = (h ^ (h >> np.uint64(33))) * _ODD[2]
    h = (h ^ (h >> np.uint64(29))) * _ODD[3]
    return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for n different digests, given as two uint64 arrays.

    A digest alone at its place of a level has its bit set there, the others go
    on to the next, smaller level; a slot is the rank of the digest's bit. Since
    other digests can meet a set bit too, every slot is verified against the
    digest kept in it.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.sizes, bits = [], [np.zeros(0, bool)]
        left = np.arange(len(x))
        with np.errstate(over="ignore"):
            while len(left):
                size = max(SPREAD * len(left), 8)
                places = _places(x[left], y[left], len(self.sizes), size)
                alone = np.bincount(places, minlength=size) == 1
                self.sizes.append(size)
                bits.append(alone)
                left = left[~alone[places]]
        self.bits = np.concatenate(bits)
        self.rank = np.cumsum(self.bits) - 1
        self.x, self.y = np.zeros(len(x), np.uint64), np.zeros(len(x), np.uint64)
        slots = self._first_bits(x, y)
        self.x[slots], self.y[slots] = x, y

    def _first_bits(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        slots, left, at = np.full(len(x), -1), np.arange(len(x)), 0
        with np.errstate(over="ignore"):
            for level, size in enumerate(self.sizes):
                places = at + _places(x[left], y[left], level, size)
                hit = self.bits[places]
                slots[left[hit]] = self.rank[places[hit]]
                left, at = left[~hit], at + size
        return slots

    def __len__(self) -> int:
        return len(self.x)

    def slots(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that has none."""
        found = self._first_bits(x, y)
        known = np.flatnonzero(found >= 0)
        slots = found[known]
        found[known[(self.x[slots] != x[known]) | (self.y[slots] != y[known])]] = -1
        return found
