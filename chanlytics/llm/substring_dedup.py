"""Removal of long repeated word passages, by difference-cover anchors.

A window is `size` consecutive words of one document.  A window is repeated
if the same words also start earlier (smaller doc_id, or same document and
smaller position); every word that a repeated window covers goes.

1. Anchors: a perfect difference cover of a period v picks positions of
   every document, |cover| of every v.  Any two equal windows hold, at the
   same distance from their starts, picked positions in both, so hashing
   only the size - v + 1 words from picked positions finds every pair.
2. Blocks of documents send their distinct anchors to shards, which answer
   which ones occur more than once in the corpus.
3. Extension: only windows around a repeated anchor are hashed whole (96
   bits).  A block sends each distinct window with its own first place, a
   shard answers whether that is the first place in the corpus.

A window that thousands of documents share is one entry for each block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chanlytics.llm import blocks as B
from chanlytics.llm import packets as P
from chanlytics.llm.words import NOT_SPACE, Words, run_hash

#: Perfect difference covers (every difference modulo the period occurs): period, cover.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}

_PACKET = "shard int, block int, payload binary"
_RESULT = "doc_id long, doc_key long, n_words long, n_removed long, kept string"
_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _period(size: int) -> int:
    """The largest period whose anchors still have a third of the window's words."""
    return max(v for v in COVERS if size - v + 1 >= max(1, size // 3))


def _anchors(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word position, hash) of the anchors of every document."""
    v = _period(size)
    at, doc = words.windows(size - v + 1)
    picked = np.isin((at - words.word_at[:-1][doc]) % v, COVERS[v])
    at = at[picked]
    return at, run_hash(words.hash, at, size - v + 1)


def _rows(shards, block: int, payloads: list[bytes]) -> pa.Table:
    return pa.table({"shard": pa.array(shards, pa.int32()),
                     "block": pa.array([block] * len(payloads), pa.int32()),
                     "payload": pa.array(payloads, pa.binary())})


def _ask_anchors(size: int, shards: int):
    def ask(key: tuple[pa.Scalar, ...], dealt: pa.Table) -> pa.Table:
        words = Words(B.documents(dealt).column("text"), NOT_SPACE)
        keys, count = np.unique(_anchors(words, size)[1], return_counts=True)
        cuts = P.shard_cuts(keys, shards)
        many = np.minimum(count, 2).astype(np.uint8)
        return _rows(range(shards), key[0].as_py(),
                     [P.joined([P.pack_keys(keys[a:b]), P.pack(many[a:b])]) for a, b in zip(cuts, cuts[1:])])
    return ask


def _answer_anchors(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
    parts = [P.split(x) for x in asked.column("payload").to_pylist()]
    keys = [P.unpack_keys(p[0]) for p in parts]
    _, total, place = P.totals(keys, [P.unpack(p[1], np.uint8) for p in parts])
    again = (total > 1)[place]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"shard": pa.array([key[0].as_py()] * len(parts), pa.int32()), "block": asked.column("block"),
                     "payload": pa.array([P.pack(again[e - len(k):e].astype(np.uint8)) for e, k in zip(ends, keys)],
                                         pa.binary())})


def _answers(table: pa.Table, dtype) -> np.ndarray:
    got = [P.unpack(x, dtype) for x in table.sort_by("shard").column("payload").to_pylist()]
    return np.concatenate(got) if got else np.zeros(0, dtype)


class _Windows:
    """Distinct candidate windows of a block, in key order, each with its first place in the block."""

    def __init__(self, words: Words, docs: pa.Table, start: np.ndarray, size: int):
        self.start = start
        doc = np.searchsorted(words.word_at, start, "right") - 1
        ids = docs.column("doc_id")
        self.doc_id = np.asarray(ids.fill_null(np.iinfo(np.int64).max), dtype=np.int64)[doc]
        self.pos = start - words.word_at[doc]
        key, more = run_hash(words.hash, start, size), run_hash(words.hash, start, size, salt=7) >> np.uint64(32)
        order = np.lexsort((self.pos, self.doc_id, more, key))
        key, more = key[order], more[order].astype(np.uint32)
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (more[1:] != more[:-1])
        lead = order[new]
        self.key, self.more = key[new], more[new]
        self.lead_doc, self.lead_pos = self.doc_id[lead], self.pos[lead]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1

    def repeated(self, first: np.ndarray) -> np.ndarray:
        """Starts of repeated windows; first: whether the block's first place is the corpus's."""
        w = self.which
        own = first[w] & (self.doc_id == self.lead_doc[w]) & (self.pos == self.lead_pos[w])
        return self.start[~own]


def _ask_windows(size: int, shards: int):
    def ask(key: tuple[pa.Scalar, ...], dealt: pa.Table, answers: pa.Table) -> pa.Table:
        docs = B.documents(dealt)
        if not docs.num_rows:
            return _rows([], 0, [])
        words = Words(docs.column("text"), NOT_SPACE)
        at, hashes = _anchors(words, size)
        keys, place = np.unique(hashes, return_inverse=True)
        at = at[_answers(answers, np.uint8)[place] > 0] if len(keys) else at
        doc = np.searchsorted(words.word_at, at, "right") - 1
        lo = np.maximum(at - _period(size) + 1, words.word_at[doc])
        hi = np.minimum(at, words.word_at[doc + 1] - size)
        lo, hi = lo[hi >= lo], hi[hi >= lo]
        depth = np.zeros(len(words.start) + 1, np.int64)
        np.add.at(depth, lo, 1)
        np.add.at(depth, hi + 1, -1)
        start = np.flatnonzero(np.cumsum(depth[:-1]) > 0)
        found = _Windows(words, docs, start, size)
        cuts = P.shard_cuts(found.key, shards)
        number = key[0].as_py()
        echo = [b""] * shards  # the block's candidates come back with the answer of one shard
        echo[number % shards] = P.pack(np.diff(start, prepend=0))
        return _rows(range(shards), number, [
            P.joined([echo[s], P.pack_keys(found.key[a:b]), P.pack(found.more[a:b]), P.pack(found.lead_doc[a:b]),
                      P.pack(found.lead_pos[a:b])]) for s, (a, b) in enumerate(zip(cuts, cuts[1:]))])
    return ask


def _answer_windows(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
    parts = [P.split(x) for x in asked.column("payload").to_pylist()]
    keys = [P.unpack_keys(p[1]) for p in parts]
    flat = np.concatenate(keys)
    more = np.concatenate([P.unpack(p[2], np.uint32) for p in parts])
    doc = np.concatenate([P.unpack(p[3], np.int64) for p in parts])
    pos = np.concatenate([P.unpack(p[4], np.int64) for p in parts])
    order = np.lexsort((pos, doc, more, flat))
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (flat[a] != flat[b]) | (more[a] != more[b])
    lead = order[new][np.cumsum(new) - 1] if len(order) else order
    first = np.empty(len(order), np.uint8)
    first[order] = (doc[order] == doc[lead]) & (pos[order] == pos[lead])
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"shard": pa.array([key[0].as_py()] * len(parts), pa.int32()), "block": asked.column("block"),
                     "payload": pa.array([P.joined([p[0], P.pack(first[e - len(k):e])])
                                          for p, k, e in zip(parts, keys, ends)], pa.binary())})


def _remove(size: int, digest: bool):
    def remove(key: tuple[pa.Scalar, ...], dealt: pa.Table, answers: pa.Table) -> pa.Table:
        docs = B.documents(dealt)
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), **({} if digest else {"doc_key": pa.array([], pa.int64())}),
                             "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                             "kept_sha256" if digest else "kept": pa.array([], pa.string())})
        words = Words(docs.column("text"), NOT_SPACE)
        parts = [P.split(x) for x in answers.sort_by("shard").column("payload").to_pylist()]
        start = np.cumsum(P.unpack(next(p[0] for p in parts if p[0]), np.int64))
        found = _Windows(words, docs, start, size)
        again = found.repeated(np.concatenate([P.unpack(p[1], np.uint8) for p in parts]) > 0)
        total = len(words.start)
        depth = np.zeros(total + size + 1, np.int32)
        depth[again] += 1
        depth[again + size] -= 1
        keep = np.cumsum(depth[:total]) == 0
        kept_at = np.concatenate([[0], np.cumsum(keep)])[words.word_at]
        # one byte before each kept word but a document's first becomes its blank
        starts, ends = words.start[keep], words.end[keep]
        size_at = np.concatenate([[0], np.cumsum(ends - starts + 1)])[kept_at]
        joins = np.ones(len(starts), bool)
        joins[kept_at[:-1][np.diff(kept_at) > 0]] = False
        data = words.raw.copy()
        data[starts[joins] - 1] = 0x20
        delta = np.zeros(len(data) + 1, np.int8)
        delta[starts] += 1
        delta[ends] -= 1
        inside = np.cumsum(delta[:-1], dtype=np.int8) > 0
        inside[starts[joins] - 1] = True
        flat = data[inside].tobytes()
        length = np.diff(size_at)
        stop = np.cumsum(np.where(length > 0, length - 1, 0))
        begin = np.concatenate([[0], stop[:-1]])
        n = words.count
        shared = {"n_words": pa.array(n.astype(np.int64)), "n_removed": pa.array((n - np.diff(kept_at)).astype(np.int64))}
        if digest:
            return pa.table({"doc_id": docs.column("doc_id"), **shared, "kept_sha256": pa.array(
                [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(begin, stop)], pa.string())})
        return pa.table({"doc_id": docs.column("doc_id"), "doc_key": docs.column("doc_key"), **shared, "kept": pa.array(
            [flat[a:b].decode() for a, b in zip(begin, stop)], pa.string())})
    return remove


def remove_repeats(df: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one blank (or, with digest, their SHA-256).

    One row for each row of df.  Words are runs without ASCII white space.
    Null and empty texts, and texts of fewer than `size` words, lose
    nothing.  Null ids come after all others; rows with the same id are at
    one place, so of equal rows none is earlier.  Other columns are ignored.
    """
    blocks = B.count_for(df, B.text_bytes(df, text_col), block_bytes)
    by = B.deal(df, blocks, id_col, text_col).groupBy("block")
    anchors = by.applyInArrow(_ask_anchors(size, blocks), _PACKET)
    known = anchors.groupBy("shard").applyInArrow(_answer_anchors, _PACKET)
    windows = by.cogroup(known.groupBy("block")).applyInArrow(_ask_windows(size, blocks), _PACKET)
    firsts = windows.groupBy("shard").applyInArrow(_answer_windows, _PACKET)
    return by.cogroup(firsts.groupBy("block")).applyInArrow(_remove(size, digest), _DIGEST if digest else _RESULT)


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
           FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 19], ' ')) AS h
        FROM w, unnest(range(1, len(ws) - 18)) AS t(s)),
rep AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS r FROM win)
        WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM rep, unnest(range(0, 20)) AS t(o)),
lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
pos AS (SELECT doc_id, ws[i] AS word, i FROM w, unnest(range(1, len(ws) + 1)) AS t(i)),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY i) AS k FROM pos
         LEFT JOIN gone ON gone.doc_id = pos.doc_id AND gone.p = pos.i WHERE gone.p IS NULL GROUP BY pos.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.k, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
