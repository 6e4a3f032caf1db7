"""Questions and answers between blocks of documents and shards of keys.

A block sends each shard the sorted 64-bit keys that its documents hold, a
shard merges what all blocks send and answers in the same order.  A packet
is a run of sorted keys, stored as differences in byte planes and
compressed: about five bytes a key where a shuffle of rows takes over
twenty.  Keys are hashes, so shards are even and a frequent key costs each
block one entry, however often the block's documents repeat it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Any integer array, as compressed byte planes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    body = pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""
    return len(values).to_bytes(8, "little") + body


def unpack(data: bytes, dtype) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if n == 0:
        return np.zeros(0, dtype)
    raw = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).reshape(n)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def shard_cuts(keys: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    """Positions that split sorted keys of so many bits into equal ranges of the key space, one for each shard."""
    edges = [(s << bits) // shards for s in range(1, shards)]
    cuts = np.searchsorted(keys, np.array(edges, np.uint64)) if edges else np.zeros(0, np.int64)
    return np.concatenate([[0], cuts, [len(keys)]]).astype(np.int64)


def totals(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of several sorted runs, their summed weights, and each entry's place among them."""
    if not sum(map(len, keys)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    new = np.empty(len(flat), bool)
    new[0] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    at = np.cumsum(new) - 1
    place = np.empty(len(flat), np.int64)
    place[order] = at
    summed = np.bincount(place, weights=np.concatenate(weights), minlength=at[-1] + 1)
    return ranked[new], summed.astype(np.int64), place


def joined(parts: list[bytes]) -> bytes:
    """Several byte strings as one."""
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def split(data: bytes) -> list[bytes]:
    """The parts of joined()."""
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return out
