"""A bigram trie in Elias-Fano levels.

Levels: the contexts (64-bit word hashes), pointers to the range of each
context's successors, the successors, and a 16-bit code of each smoothed
probability.  Successors are numbers of words in the shard's own sorted word
list, made one rising sequence by adding the end of the range before
(context-relative values), so they are found by one successor search.
All searches work on arrays of queries.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 15 / 65534   # log10 units between codes; code 65535 stands for none
NONE = 65535


class EliasFano:
    """A rising sequence of unsigned integers: low bits packed, high bits as gaps in a bitmap."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high)
        self.ones = np.r_[0, np.cumsum(ones, dtype=np.int64)]                # ones and zeros before each 64-bit word
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        # Low parts are read as 8 bytes from any byte on.
        self.window = np.ndarray((max(0, len(low) - 7),), "<u8", low.data if len(low) else b"", 0, (1,))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        parts = []
        for at in range(0, n, 1 << 16):
            bits = np.unpackbits(values[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            parts.append(bits[:, :low_bits].ravel())
        low = np.packbits(np.concatenate(parts), bitorder="little") if parts and low_bits else np.zeros(0, np.uint8)
        low = np.r_[low, np.zeros(8, np.uint8)]
        size = (top >> low_bits) + n + 2
        bitmap = np.zeros(-(-size // 64) * 64, bool)
        bitmap[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = True
        return cls(n, low_bits, low, np.packbits(bitmap, bitorder="little").view("<u8"))

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        return (self.window[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def select(self, rank: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Bitmap place of the one (or zero) of each rank, from 0."""
        word = np.searchsorted(before, rank, "right") - 1
        bits = self.high[word]
        bits = ~bits if flip else bits.copy()
        left = rank - before[word]
        place = np.zeros(len(rank), np.int64)
        for width in (32, 16, 8, 4, 2, 1):                                    # halve the word around the bit
            half = bits & np.uint64((1 << width) - 1)
            n = np.bitwise_count(half).astype(np.int64)
            beyond = left >= n
            left = np.where(beyond, left - n, left)
            bits = np.where(beyond, bits >> np.uint64(width), half)
            place += beyond * width
        return word * 64 + place

    def get(self, i: np.ndarray) -> np.ndarray:
        high = self.select(i, self.ones, False) - i
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x: the place of the first value not below it, and whether it is equal."""
        x = x.astype(np.uint64)
        high, low = (x >> np.uint64(self.low_bits)).astype(np.int64), x & np.uint64((1 << self.low_bits) - 1)
        place = np.full(len(x), self.n, np.int64)
        equal = np.zeros(len(x), bool)
        inside = np.flatnonzero(high < self.zeros[-1])                        # beyond: all values are below
        if not len(inside) or not self.n:
            return place, equal
        h, low = high[inside], low[inside]
        # Values with the same high part stand between two zeros; their low parts are searched by halves.
        first = np.where(h > 0, self.select(np.maximum(h - 1, 0), self.zeros, True) + 1 - h, 0)
        stop = self.select(h, self.zeros, True) - h
        left, right = first.copy(), stop.copy()
        open_ = np.flatnonzero(left < right)
        while len(open_):
            middle = (left[open_] + right[open_]) >> 1
            below = self.lows(middle) < low[open_]
            left[open_] = np.where(below, middle + 1, left[open_])
            right[open_] = np.where(below, right[open_], middle)
            open_ = open_[left[open_] < right[open_]]
        place[inside] = left
        found = left < stop
        equal[inside[found]] = self.lows(left[found]) == low[found]
        return place, equal

    def dump(self) -> bytes:
        return struct.pack("<QQQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + b"\0" * (-len(self.low) % 8) + self.high.tobytes()

    @classmethod
    def load(cls, data: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, low_bits, lows, highs = struct.unpack_from("<QQQQ", data, at)
        at += 32
        end = at + lows + -lows % 8
        return cls(n, low_bits, data[at:at + lows], data[end:end + 8 * highs].view("<u8")), end + 8 * highs


class Trie:
    """Contexts, pointers, successors and codes of one shard, over bytes or a memory map of them."""

    def __init__(self, data: np.ndarray):
        at = 0
        levels = []
        for _ in range(4):
            level, at = EliasFano.load(data, at)
            levels.append(level)
        self.contexts, self.words, self.pointers, self.successors = levels
        self.codes = data[at:at + 2 * self.successors.n].view("<u2")

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, probability: np.ndarray) -> bytes:
        """From bigrams sorted by context, then word; ``probability`` is what the context gives the word."""
        contexts, first, size = np.unique(context, return_index=True, return_counts=True)
        words, number = np.unique(word, return_inverse=True)
        last = number[first + size - 1] + 1 if len(first) else np.zeros(0, np.int64)
        base = np.cumsum(last) - last                                          # a range begins behind the end of the last
        relative = number + np.repeat(base, size)
        codes = np.clip(np.rint(-np.log10(probability) / STEP), 0, NONE - 1).astype("<u2")
        levels = (contexts, words, np.r_[first, len(context)], relative)
        return b"".join(EliasFano.of(x).dump() for x in levels) + codes.tobytes() + b"\0" * (-2 * len(codes) % 8)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of the bigrams (context, word); NONE where there is no such bigram."""
        out = np.full(len(context), NONE, np.uint16)
        if not self.successors.n or not len(context):
            return out
        keys, which = np.unique(context, return_inverse=True)
        k, known = self.contexts.successor(keys)
        k = np.where(known, k, 0)
        start = self.pointers.get(k).astype(np.int64)
        base = np.where(start > 0, self.successors.get(np.maximum(start - 1, 0)).astype(np.int64) + 1, 0)
        stop = self.pointers.get(k + 1).astype(np.int64)
        names, whose = np.unique(word, return_inverse=True)
        number, listed = self.words.successor(names)
        ask = np.flatnonzero(known[which] & listed[whose])
        at, found = self.successors.successor(base[which[ask]] + number[whose[ask]])
        mine = found & (at >= start[which[ask]]) & (at < stop[which[ask]])
        out[ask[mine]] = self.codes[at[mine]]
        return out


def probabilities(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == NONE, 0.0, 10.0 ** (-STEP * codes.astype(np.float64)))
