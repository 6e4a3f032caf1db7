"""Elias-Fano sequences over flat buffers, with batched access and successor search.

A sequence of n sorted integers below u keeps its low bits packed, about
log2(u / n) each, and its high bits as a unary bit vector of under 2n bits.
All parts are plain little-endian arrays behind one another, so a sequence
can be read in place from any buffer: bytes from a table, or a file mapped
with numpy.memmap.  Every method takes arrays and works on all of them.
"""

from __future__ import annotations

import numpy as np

_HEAD = 4  # n, universe - 1, low bits, words of the high part
_ONE = np.uint64(1)
_EVERY = 16
_PIECE = 1 << 13
_ODD, _PAIRS, _NIBBLES, _BYTES, _TOPS = (np.uint64(x * 0x0101010101010101) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))
#: place of the r-th set bit of a byte: [r, byte]
_IN_BYTE = np.array([[next((i for i in range(8) if byte >> i & 1 and bin(byte & (1 << i) - 1).count("1") == r), 0)
                      for byte in range(256)] for r in range(8)], np.int64)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """values, bits each, in 64-bit words (one spare word at the end)."""
    out = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    at = np.arange(len(values), dtype=np.int64) * bits
    word, off = at >> 6, (at & 63).astype(np.uint64)
    np.add.at(out, word, values << off)  # bits of different values never meet
    over = off + np.uint64(bits) > np.uint64(64)
    np.add.at(out, word[over] + 1, values[over] >> (np.uint64(64) - off[over]))
    return out


class EliasFano:
    """Read-only view of a sequence; build() makes the buffer."""

    def __init__(self, buffer):
        words = np.frombuffer(buffer, np.uint64) if not isinstance(buffer, np.ndarray) else buffer.view(np.uint64)
        self.n, self.last, self.bits, high = (int(x) for x in words[:_HEAD])
        self.nbytes = words.nbytes
        self.high = words[_HEAD:_HEAD + high]
        self.low = words[_HEAD + high:]
        # rank directory: ones before each word of the high part
        ones = np.zeros(high + 1, np.int64)
        np.cumsum(np.bitwise_count(self.high), out=ones[1:])
        self._ones = ones
        self._zeros = np.arange(high + 1, dtype=np.int64) * 64 - ones
        self._one_at = self._sample(ones, self.n)
        self._zero_at = self._sample(self._zeros, int(self._zeros[-1]))

    @staticmethod
    def build(values: np.ndarray, universe: int) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        length = n + (max(0, universe - 1) >> bits) + 2
        flags = np.zeros(-(-length // 64) * 64, np.uint8)
        flags[at] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        low = _packed(values & np.uint64((1 << bits) - 1), bits) if bits else np.zeros(1, np.uint64)
        return np.concatenate([np.array([n, max(universe, 1) - 1, bits, len(high)], np.uint64), high, low]).tobytes()

    @staticmethod
    def _sample(directory: np.ndarray, count: int) -> np.ndarray:
        """For every _EVERY-th one (or zero), the word that holds it."""
        return (np.searchsorted(directory, np.arange(0, max(count, 1), _EVERY), "right") - 1).astype(np.int32)

    def _select(self, flip: bool, rank: np.ndarray) -> np.ndarray:
        """Position of the rank-th one (or zero, if flip) of the high part."""
        directory, sample = (self._zeros, self._zero_at) if flip else (self._ones, self._one_at)
        word = sample[rank // _EVERY].astype(np.int64)
        move = np.flatnonzero(directory[word + 1] <= rank)
        while move.size:
            word[move] += 1
            move = move[directory[word[move] + 1] <= rank[move]]
        left = (rank - directory[word]).astype(np.uint64)
        bits = self.high[word]
        if flip:
            bits = ~bits
        # counts of the bytes up to each byte, side by side in one word
        sums = bits - ((bits >> np.uint64(1)) & _ODD)
        sums = (sums & _PAIRS) + ((sums >> np.uint64(2)) & _PAIRS)
        sums = ((sums + (sums >> np.uint64(4))) & _NIBBLES) * _BYTES
        full = np.bitwise_count(((left * _BYTES | _TOPS) - sums) & _TOPS)  # bytes that end at or before the rank
        shift = full.astype(np.uint64) << np.uint64(3)
        left -= ((sums << np.uint64(8)) >> shift) & np.uint64(255)
        return (word << 6) + shift.astype(np.int64) + _IN_BYTE[left, (bits >> shift) & np.uint64(255)]

    def _run(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand in a row from bit position at."""
        out = np.zeros(len(at), np.int64)
        open_ = np.arange(len(at))
        while open_.size:
            here = at[open_] + out[open_]
            inverse = ~(self.high[np.minimum(here >> 6, len(self.high) - 1)] >> (here & 63).astype(np.uint64))
            length = np.bitwise_count((inverse & -inverse) - _ONE).astype(np.int64)
            room = 64 - (here & 63)
            out[open_] += np.minimum(length, room)
            open_ = open_[(length >= room) & ((here >> 6) + 1 < len(self.high))]
        return out

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        word, off = at >> 6, (at & 63).astype(np.uint64)
        upper = np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> off) | upper) & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at positions i; of more positions than values, each value is read once."""
        i = np.asarray(i, np.int64)
        if self.n < len(i):
            return self.access(np.arange(self.n))[i]
        out = np.empty(len(i), np.uint64)
        for k in range(0, len(i), _PIECE):
            own = i[k:k + _PIECE]
            high = self._select(False, own) - own
            out[k:k + _PIECE] = (high.astype(np.uint64) << np.uint64(self.bits)) | self._lows(own)
        return out

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of the first value not below x, the end of x's bucket, x's low bits."""
        bucket = (x >> np.uint64(self.bits)).astype(np.int64)
        begin = np.where(bucket > 0, self._select(True, np.maximum(bucket - 1, 0)) + 1, 0)
        lo = begin - bucket
        end = lo + self._run(begin)
        hi = end.copy()
        low = x & np.uint64((1 << self.bits) - 1)
        open_ = np.flatnonzero(lo < hi)
        while open_.size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._lows(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo, end, low

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value not below x (n, if there is none)."""
        x = np.asarray(x, np.uint64)
        inside = x <= np.uint64(self.last)
        return np.where(inside, self._search(np.where(inside, x, np.uint64(0)))[0], self.n)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of x, or -1; looked up in order, in pieces whose arrays stay in the processor's cache."""
        x = np.asarray(x, np.uint64)
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        order = np.argsort(x)
        for i in range(0, len(x), _PIECE):
            own = order[i:i + _PIECE]
            out[own] = self._find(x[own])
        return out

    def _find(self, x: np.ndarray) -> np.ndarray:
        inside = x <= np.uint64(self.last)
        at, end, low = self._search(np.where(inside, x, np.uint64(0)))
        return np.where(inside & (at < end) & (self._lows(np.minimum(at, self.n - 1)) == low), at, -1)
