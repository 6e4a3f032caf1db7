"""Words of Arrow string columns as numpy arrays: offsets and 64-bit hashes.

Everything works on the UTF-8 bytes of a whole batch at once, without a
Python object per word.  Word classes are sets of bytes; bytes from 0x80
up belong to every class, so that a class of ASCII characters plus "all
others" is exact on UTF-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_P = U64(0x9E3779B97F4A7C15)
_P_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WINDOW = 4 << 20
_powers: dict[str, np.ndarray] = {}

#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (splitmix64's finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def join_hash(*parts: np.ndarray) -> np.ndarray:
    """One hash of a sequence of hashes; the order and the number of parts count."""
    out = np.full(parts[0].shape, U64(len(parts) * 0x5851F42D4C957F2D & (1 << 64) - 1))
    for p in parts:
        out = mix(out * _P + p)
    return out


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base)
        have[0] = 1
        _powers[kind] = have = np.multiply.accumulate(have)
    return have[:n]


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets (from 0) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunks
        column = pa.array([], pa.large_string())
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch: start, end (byte positions), hash; word_at[d] is document d's first word."""

    def __init__(self, column, kind: np.ndarray, fold: np.ndarray | None = None, hashes: bool = True):
        self.raw, self.offsets = buffers(column)
        data = self.raw if fold is None else fold[self.raw]
        n = len(data)
        inside = kind[data]
        first = np.zeros(n + 1, bool)
        first[self.offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:-1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.word_at = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.word_at)
        self.hash = self._hashes(data) if hashes else None

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        i, total = 0, len(self.start)
        while i < total:
            at = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, at + _WINDOW, "right")))
            stop = self.end[j - 1]
            size = int(stop - at)
            sums = np.empty(size + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE[data[at:stop]] * _power("p", _P, size), out=sums[1:])
            s, e = self.start[i:j] - at, self.end[i:j] - at
            out[i:j] = (sums[e] - sums[s]) * _power("inv", _P_INV, size)[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, document) of each run of size words inside one document."""
        per = np.maximum(self.count - size + 1, 0)
        doc = np.repeat(np.arange(len(per)), per)
        skip = np.cumsum(per) - per
        return np.arange(per.sum()) - skip[doc] + self.word_at[:-1][doc], doc


def run_hash(hashes: np.ndarray, at: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of the size words from each position in at."""
    size = int(size)
    out = np.full(len(at), U64((size * 0x2545F4914F6CDD1D + salt) & (1 << 64) - 1))
    for k in range(size):
        out = mix(out * _P + hashes[at + k])
    return out


def slices(batch: pa.RecordBatch, text: str, most: int = 2 << 20):
    """Cuts a batch so that each part has at most `most` bytes of text, or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)) if len(column) else []
    i, n = 0, len(column)
    while i < n:
        base = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, base + most, "right")))
        yield batch.slice(i, j - i)
        i = j
