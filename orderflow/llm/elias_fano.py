"""Elias-Fano coded monotone sequences in flat arrays that can be memory-mapped, queried in bulk."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


_BYTES, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_EIGHT = np.uint64(8)
# Position of the k-th one of a byte, at 8 * byte + k.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for b in range(256) for k in range(8)], np.int64)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the one with ``rank`` ones before it in each 64-bit word: its byte by sums over bytes, then a table."""
    rank = rank.astype(np.uint64)
    ones = word - ((word >> _ONE) & np.uint64(0x5555555555555555))
    ones = (ones & np.uint64(0x3333333333333333)) + ((ones >> np.uint64(2)) & np.uint64(0x3333333333333333))
    sums = ((ones + (ones >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _BYTES
    # the high bit of a byte stays where the ones up to there are no more than the rank
    passed = ((rank * _BYTES | _HIGH) - sums) & _HIGH
    shift = np.minimum(np.bitwise_count(passed).astype(np.uint64), np.uint64(7)) * _EIGHT
    before = ((sums << _EIGHT) >> shift) & np.uint64(255)
    byte = (word >> shift) & np.uint64(255)
    return shift.astype(np.int64) + _IN_BYTE[(byte * _EIGHT + np.minimum(rank - before, np.uint64(7))).astype(np.int64)]


class EliasFano:
    """``n`` rising integers. Of each, the low ``l`` bits are packed one after the other; the high parts are a unary
    bit vector of about 2n bits with the ones counted per 64-bit word."""

    def __init__(self, n: int, l: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.l, self.low, self.high, self.ones = n, l, low, high, ones
        self._zeros = None

    @staticmethod
    def coded(values: np.ndarray) -> "EliasFano":
        values = values.astype(np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        l = max(0, (last // max(n, 1)).bit_length() - 1)
        low = np.zeros((n * l + 63) // 64 + 1, np.uint64)
        if l:
            part = values & np.uint64((1 << l) - 1)
            bit = np.arange(n, dtype=np.uint64) * np.uint64(l)
            word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            # parts in one word come in order: or-ed group by group
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low[word[first]] |= np.bitwise_or.reduceat(part << shift, first)
            over = np.flatnonzero(shift + np.uint64(l) > np.uint64(64))
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        bits = (values >> np.uint64(l)).astype(np.int64) + np.arange(n)
        words = (int(bits[-1]) if n else 0) // 64 + 2
        high = np.zeros(words, np.uint64)
        if n:
            word = bits >> 6
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            high[word[first]] = np.bitwise_or.reduceat(_ONE << (bits & 63).astype(np.uint64), first)
        ones = np.zeros(words, np.uint32)
        ones[1:] = np.cumsum(np.bitwise_count(high).astype(np.int64))[:-1]
        return EliasFano(n, l, low, high, ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.l)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        value = self.low[word] >> shift
        # few parts go on in the next word
        over = np.flatnonzero(shift > np.uint64(64 - self.l))
        if len(over):
            value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.l) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at positions, as unsigned integers."""
        word = np.searchsorted(self.ones, i.astype(np.uint32), "right") - 1
        bit = word * 64 + _select_in_word(self.high[word], i - self.ones[word])
        return ((bit - i).astype(np.uint64) << np.uint64(self.l)) | self._low(i)

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at positions and at those after them. The next one of the high bits mostly lies in the same word."""
        word = np.searchsorted(self.ones, i.astype(np.uint32), "right") - 1
        high = self.high[word]
        at = _select_in_word(high, i - self.ones[word])
        rest = (high >> at.astype(np.uint64)) & ~_ONE
        following = word * 64 + at + np.bitwise_count((rest & (~rest + _ONE)) - _ONE)
        over = np.flatnonzero(rest == 0)
        if len(over):
            # the first one of the next word that has any
            then = np.searchsorted(self.ones, (i[over] + 1).astype(np.uint32), "right") - 1
            first = self.high[then]
            following[over] = then * 64 + np.bitwise_count((first & (~first + _ONE)) - _ONE)
        l = np.uint64(self.l)
        return (((word * 64 + at - i).astype(np.uint64) << l) | self._low(i),
                ((following - i - 1).astype(np.uint64) << l) | self._low(i + 1))

    def _below(self, part: np.ndarray) -> np.ndarray:
        """How many values have a high part less than each of ``part``: ones before as many zeros."""
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        rank = part - 1
        word = np.minimum(np.searchsorted(self._zeros, rank, "right") - 1, len(self.ones) - 1)
        bit = word * 64 + _select_in_word(~self.high[np.maximum(word, 0)], rank - self._zeros[np.maximum(word, 0)])
        return np.where(part <= 0, 0, np.minimum(bit - rank, self.n))

    def _run(self, bit: np.ndarray) -> np.ndarray:
        """How many ones of the high bits follow each other from a position on.

        Most runs end in their word. One that reaches the word's end goes on to the next zero, which is found by its rank.
        """
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        gap = ~(self.high[word] >> shift)
        run = np.bitwise_count((gap & (~gap + _ONE)) - _ONE).astype(np.int64)
        over = np.flatnonzero((run == 64 - (bit & 63)) & (word + 1 < len(self.high)))
        if len(over):
            after = word[over] + 1
            run[over] = self._zero(after * 64 - self.ones[after]) - bit[over]
        return run

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """Where the zero is that has so many zeros before it."""
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(self._zeros, rank, "right") - 1
        return word * 64 + _select_in_word(~self.high[word], rank - self._zeros[word])

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, or -1: the successor of equal value in the run of its high part."""
        values = values.astype(np.uint64)
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        part = (values >> np.uint64(self.l)).astype(np.int64)
        top = int(self.access(np.array([self.n - 1]))[0] >> np.uint64(self.l))
        inside = np.flatnonzero(part <= top)
        low_part = values[inside] & np.uint64((1 << self.l) - 1)
        low = self._below(part[inside])
        high = low + self._run(part[inside] + low)
        here = np.flatnonzero(low < high)
        # lower bound of the low bits in [low, high), all at once; a run of one is only compared
        open_ = np.flatnonzero(high > low + 1)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = self._low(middle - 1) < low_part[open_]
            low[open_] = np.where(less, middle, low[open_])
            high[open_] = np.where(less, high[open_], middle)
            open_ = open_[high[open_] > low[open_] + 1]
        same = here[self._low(low[here]) == low_part[here]]
        out[inside[same]] = low[same]
        return out
