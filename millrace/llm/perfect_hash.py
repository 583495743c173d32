"""A minimal perfect hash over distinct 64-bit keys, built and probed with numpy."""

from __future__ import annotations

import numpy as np

from millrace.llm.hashing import mix64


class PerfectHash:
    """Maps each of ``n`` distinct keys to its own number below ``n``.

    Each level is a bit array; a key that is alone in its cell is settled there, the others go on
    to the next level with another seed. A key's number is the count of set bits before its own.
    Two keys that agree in all 64 bits cannot be told apart, so keys must be distinct.
    """

    _LOAD = 1.6

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        settled, left = 0, keys
        while len(left):
            cells = max(1, int(len(left) * self._LOAD))
            place = self._place(left, len(self.levels), cells)
            alone = np.bincount(place, minlength=cells) == 1
            self.levels.append(alone)
            self.ranks.append(settled + np.cumsum(alone) - alone)
            settled += int(alone.sum())
            left = left[~alone[place]]

    @staticmethod
    def _place(keys: np.ndarray, level: int, cells: int) -> np.ndarray:
        mixed = mix64(keys + np.uint64((0xA0761D6478BD642F * (level + 1)) & (2**64 - 1)))
        return (mixed % np.uint64(cells)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, or -1 where the levels show that a key was never added."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            place = self._place(keys[open_], level, len(alone))
            hit = alone[place]
            out[open_[hit]] = rank[place[hit]]
            open_ = open_[~hit]
        return out
