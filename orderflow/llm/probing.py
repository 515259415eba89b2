"""Open-addressed tables in numpy arrays, probed for many keys at once."""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class IntTable:
    """Non-negative integers to non-negative integers, fixed once built. The keys are distinct."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._home(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out
