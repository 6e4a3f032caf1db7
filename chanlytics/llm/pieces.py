"""SentencePiece encoding and decoding as a max-plus parallel scan.

The encoding of a text is the segmentation into pieces of the vocabulary
with the largest sum of piece scores: the unigram lattice of SentencePiece.
A character without a piece costs the least score less 10 and is written as
its UTF-8 bytes (byte fallback).  Scores are whole multiples of 1/4096, so
sums are exact, and a piece's score has a fixed addition of 0 to 15 such
steps by its id, which decides between segmentations of equal score.  (What
is left are different orders of the same pieces, as in a run of one letter:
there the result depends on `chunk`, but on nothing else.)

A text up to `chunk` characters is one lattice.  A longer one is cut into
chunks at fixed positions, wherever these fall:
  1. each chunk yields a transfer matrix T[s, t]: the best score from "the
     last piece border is s characters before the chunk" to "the last border
     is t characters before its end" (max-plus, as many states as the
     longest piece has characters);
  2. matrices are combined associatively, first within groups of chunks,
     then over a text's groups; walking back from the end fixes the border
     state at every cut, first between groups, then between chunks;
  3. each chunk is traced back on its own, between its two known states.
No task ever holds more than a chunk of a giant text.

Where two neighbouring characters stand together in no piece, every path has
a border.  No piece has anything before a blank mark inside it, nor a line
feed (checked when the vocabulary is loaded), so a lattice falls into words
and smaller segments; the distinct segments of a batch are solved together.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlytics.llm import common as C
from chanlytics.llm.words import Words, buffers, slices

MARK = "▁"
_OTHER = "\ud800"  # stands for a mark that the text itself holds; no valid text has it
CHUNK = 65_536
FAN = 64
LONG = 256  # characters of a segment from which it is solved on its own
REMEMBERED = 1 << 20  # segments that a task remembers, about 40 bytes each
_STEPS = 4096
_NONE = -(1 << 90)  # no path, among Python integers
_FAR = -(1 << 60)  # no path, in a matrix


# --- vocabulary ---------------------------------------------------------------

def _fields(data: bytes):
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        shift = out = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


class Vocabulary:
    """Pieces and scores of a SentencePiece model file."""

    def __init__(self, data: bytes):
        self.ids: dict[str, int] = {}
        self.scores: list[int] = []  # in steps
        self.text: list[bytes] = []  # what an id decodes to
        byte_of: dict[int, int] = {}
        for number, value in _fields(data):
            if number != 1:
                continue
            piece = dict(_fields(value))
            text, kind = piece.get(1, b"").decode(), piece.get(3, 1)
            i = len(self.scores)
            tie = (i * 2654435761 & 0xFFFFFFFF) >> 28
            self.scores.append(round(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]) * _STEPS) + tie)
            if kind == 6:
                byte_of[int(text[3:5], 16)] = i
                self.text.append(bytes([int(text[3:5], 16)]))
            elif kind in (1, 4):
                self.ids[text] = i
                self.text.append(text.replace(MARK, " ").encode())
            else:
                self.text.append(b"")
        if len(byte_of) != 256:
            raise ValueError("the vocabulary needs byte pieces")
        self.byte_ids = [byte_of[b] for b in range(256)]
        self.unknown = min(self.scores[i] for i in self.ids.values()) - 10 * _STEPS
        self.longest = max(map(len, self.ids))
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces must not hold a line feed, or a blank mark behind other characters")
        #: every prefix of a piece; the value is the piece's id, or -1
        self.table: dict[str, int] = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                self.table.setdefault(p[:k], -1)
            self.table[p] = i
        #: whether two bytes may stand side by side in a piece (blanks as bytes 0x20, non-ASCII always)
        self.joined = np.zeros((256, 256), bool)
        self.joined[0x80:], self.joined[:, 0x80:] = True, True
        for p in self.ids:
            plain = p.replace(MARK, " ")
            for x, y in zip(plain, plain[1:]):
                if x < "\x80" and y < "\x80":
                    self.joined[ord(x), ord(y)] = True
        # the prefix tree as sorted (node, character) keys; node 0 is the empty prefix
        prefixes = list(self.table)
        number = {p: i for i, p in enumerate(prefixes, 1)} | {"": 0}
        key = np.array([number[p[:-1]] << 21 | ord(p[-1]) for p in prefixes], np.int64)
        order = np.argsort(key)
        self.edge, self.child = key[order], order + 1
        self.piece_at = np.array([-1, *self.table.values()], np.int64)
        #: solved segments: hashes, where their ids begin, how many they are, the ids
        self.memo = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in (MARK if char == _OTHER else char).encode())

    def arcs(self, text: str, i: int):
        """(end, score, id or -1 for a character without a piece) of the pieces at position i."""
        table, single = self.table, False
        for j in range(i + 1, min(len(text), i + self.longest) + 1):
            p = table.get(text[i:j])
            if p is None:
                break
            if p >= 0:
                single |= j == i + 1
                yield j, self.scores[p], p
        if not single:
            yield i + 1, self.unknown, -1

    def solve(self, text: str) -> tuple[int, tuple[int, ...]]:
        """Best score and ids of a text that stands alone."""
        n, table, scores, longest = len(text), self.table, self.scores, self.longest
        best = [0] + [_NONE] * n
        back: list = [None] * (n + 1)
        for i in range(n):  # arcs(), written out
            here, single = best[i], True
            for j in range(i + 1, min(n, i + longest) + 1):
                p = table.get(text[i:j])
                if p is None:
                    break
                if p >= 0:
                    if j == i + 1:
                        single = False
                    score = here + scores[p]
                    if score > best[j]:
                        best[j], back[j] = score, (i, p)
            if single and here + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + self.unknown, (i, -1)
        return best[n], self._ids(text, back, 0, n)

    def _ids(self, text: str, back: list, start: int, end: int) -> tuple[int, ...]:
        parts = []
        while end > start:
            i, p = back[end]
            parts.append((p,) if p >= 0 else self.fallback(text[i]))
            end = i
        return tuple(x for part in reversed(parts) for x in part)

    def solve_many(self, codes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """solve() for many short texts, one behind another: (ids of all, how many each has).

        codes: the characters as the lattice reads them.  All texts go
        forward together, one character at a time.
        """
        texts, total = len(length), int(length.sum())
        stop = np.cumsum(length)
        text_of = np.repeat(np.arange(texts), length)
        # arcs: walk down the prefix tree from every character
        at, node = np.arange(total), np.zeros(total, np.int64)
        left = stop[text_of] - at
        single = np.zeros(total, bool)
        arcs = []
        for size in range(1, self.longest + 1):
            inside = left[at] >= size
            at, node = at[inside], node[inside]
            key = node << 21 | codes[at + size - 1]
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            there = self.edge[place] == key
            at, node = at[there], self.child[place[there]]
            if not len(at):
                break
            piece = self.piece_at[node]
            good = piece >= 0
            if size == 1:
                single[at[good]] = True
            arcs.append((at[good], np.full(good.sum(), size), piece[good]))
        lone = np.flatnonzero(~single)
        arcs.append((lone, np.ones(len(lone), np.int64), np.full(len(lone), -1)))
        start, size, piece = (np.concatenate(x) for x in zip(*arcs))
        score = np.append(np.array(self.scores, np.int64), self.unknown)[piece]
        # borders: a text has one more than characters
        first = stop - length + np.arange(texts)
        depth = start - (stop - length)[text_of[start]]
        order = np.argsort(depth.astype(np.int16), kind="stable")  # short texts: LONG at most
        begin, size, piece, score = (start + text_of[start])[order], size[order], piece[order], score[order]
        cuts = np.searchsorted(depth[order], np.arange(length.max(initial=0) + 1))
        best = np.full(total + texts, _FAR, np.int64)
        best[first] = 0
        back = np.zeros((2, total + texts), np.int64)
        for a, b in zip(cuts, cuts[1:]):
            here = begin[a:b]
            end, value = here + size[a:b], best[here] + score[a:b]
            good = np.flatnonzero(value > best[end])  # arcs of one depth and text end at different borders
            best[end[good]] = value[good]
            back[0, end[good]], back[1, end[good]] = size[a:b][good], piece[a:b][good]
        # all texts back together
        now, owner, borders = first + length, np.arange(texts), []
        while len(now):
            going = now > first[owner]
            now, owner = now[going], owner[going]
            borders.append(now)
            now = now - back[0, now]
        border = np.sort(np.concatenate(borders)) if borders else np.zeros(0, np.int64)
        ids, owner = back[1, border], np.searchsorted(first, border, "right") - 1
        count = np.ones(len(ids), np.int64)
        spelt = {}
        for k in np.flatnonzero(ids < 0).tolist():
            spelt[k] = self.fallback(chr(codes[border[k] - owner[k] - 1]))
            count[k] = len(spelt[k])
        out = np.repeat(ids, count)
        begin = np.cumsum(count) - count
        for k, own in spelt.items():
            out[begin[k]:begin[k] + len(own)] = own
        return out.astype(np.int32), np.bincount(owner, count, texts).astype(np.int64)

    # --- one chunk of a longer text ---------------------------------------------

    def cuts(self, text: str) -> list[int]:
        """Positions that no piece crosses."""
        return [i for i in range(1, len(text))
                if text[i] == MARK and text[i - 1] != MARK or text[i] == "\n" or text[i - 1] == "\n"]

    def _paths(self, text: str, start: int, after: int, end: int) -> tuple[list[int], list]:
        """Best scores to positions up to end, from a border at start; borders are at start or beyond `after`."""
        best = [_NONE] * (end + 1)
        back: list = [None] * (end + 1)
        best[start] = 0
        for i in [start, *range(after + 1, end)] if start <= after else range(start, end):
            if best[i] == _NONE:
                continue
            for j, score, p in self.arcs(text, i):
                if after < j <= end and best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, p)
        return best, back

    def _starts(self, begin: int) -> range:
        """Entry states that exist: s characters of the context before the chunk."""
        return range(min(self.longest, begin + 1))

    def transfer(self, text: str, begin: int) -> np.ndarray:
        """T[s, t] of the chunk text[begin:], less its largest entry; text[:begin] is the context that pieces may start in."""
        K, n = self.longest, len(text)
        out = np.full((K, K), _NONE, object)
        inside = [c for c in self.cuts(text) if begin < c <= n - 1]
        if not inside:
            for s in self._starts(begin):
                best, _ = self._paths(text, begin - s, begin, n)
                for t in range(min(K, n + 1)):
                    if n - t > begin or t == n - begin + s:
                        out[s, t] = best[n - t]
            return _levelled(out)
        first, last = inside[0], inside[-1]
        head = np.full(K, _NONE, object)
        for s in self._starts(begin):
            head[s] = self._paths(text, begin - s, begin, first)[0][first]
        tail = np.full(K, _NONE, object)
        best, _ = self._paths(text, last, last, n)
        for t in range(min(K, n - last + 1)):
            tail[t] = best[n - t]
        # what lies between the first and the last cut is the same for all states
        return _levelled(head[:, None] + tail[None, :])

    def trace_ends(self, text: str, begin: int, s: int, t: int) -> tuple[tuple[int, ...], str, tuple[int, ...]]:
        """Between the borders begin - s and len(text) - t: ids up to the first cut, the text between the first
        and the last, which falls into segments, and ids from there."""
        start, end = begin - s, len(text) - t
        inside = [c for c in self.cuts(text) if begin < c < end]
        if not inside:
            ids = self._ids(text, self._paths(text, start, begin, end)[1], start, end) if end > start else ()
            return ids, "", ()
        first, last = inside[0], inside[-1]
        return (self._ids(text, self._paths(text, start, begin, first)[1], start, first), text[first:last],
                self._ids(text, self._paths(text, last, last, end)[1], last, end))

    def trace(self, text: str, begin: int, s: int, t: int) -> tuple[int, ...]:
        """The ids between the borders begin - s and len(text) - t."""
        head, middle, tail = self.trace_ends(text, begin, s, t)
        return (*head, *self.solve(middle)[1], *tail)


def _levelled(matrix: np.ndarray) -> np.ndarray:
    """Only differences count: entries less the largest, which stay small however long the text."""
    top = matrix.max()
    return np.where(matrix > _FAR // 2, matrix - top, _FAR).astype(np.int64)


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    return _levelled((a[:, :, None] + b[None, :, :]).max(axis=1))


def border_states(matrices: list[np.ndarray], s: int, t: int) -> list[int]:
    """The states between consecutive chunks on the best path from s to t: s first, t last."""
    forward = [np.where(np.arange(len(matrices[0])) == s, 0, _FAR)]
    for m in matrices:
        forward.append(_levelled((forward[-1][:, None] + m).max(axis=0)))
    states = [t]
    for f, m in zip(reversed(forward[:-1]), reversed(matrices)):
        states.append(int(np.argmax(f + m[:, states[-1]])))
    states.reverse()
    return states


# --- Spark --------------------------------------------------------------------

def load(spark: SparkSession, path: str | None = None):
    """The vocabulary file's bytes, broadcast (it is a fixed file, about half a megabyte)."""
    path = path or os.path.join(C.tokenizer_dir(), "piece_bpe_32k.model")
    with open(path, "rb") as f:  # on the driver: a parameter file, not an input table
        return spark.sparkContext.broadcast(f.read())


_VOCABULARY: dict[bytes, Vocabulary] = {}  # the last vocabulary, by the file's bytes


def _vocabulary(shared) -> Vocabulary:
    key = shared.value
    if key not in _VOCABULARY:
        _VOCABULARY.clear()
        _VOCABULARY[key] = Vocabulary(key)
    return _VOCABULARY[key]


def marked(text: str, begins: bool) -> str:
    """Text as the lattice reads it: a blank before its begin, blanks as marks."""
    return ((" " if begins else "") + text.replace(MARK, _OTHER)).replace(" ", MARK)


class _Segments(Words):
    """Pieces of a batch's texts between places that no piece of the vocabulary crosses."""

    def __init__(self, column, joined: np.ndarray, begins: bool):
        self.raw, self.offsets = buffers(column)
        if begins:  # the blank before the begin of each text that is not empty
            some = np.diff(self.offsets) > 0
            self.raw = np.insert(self.raw, self.offsets[:-1][some], 0x20)
            self.offsets = self.offsets + np.concatenate([[0], np.cumsum(some)])
        data, n = self.raw, len(self.raw)
        begin = np.zeros(n, bool)
        begin[1:] = ~joined[data[:-1], data[1:]]
        begin[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        self.start = np.flatnonzero(begin)
        self.end = np.append(self.start[1:], n) if n else self.start
        self.word_at = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.word_at)
        self.hash = self._hashes(data)


def _solve(vocabulary: Vocabulary, cut: _Segments, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, how many each has) of some segments, one behind another."""
    begin, count = cut.start[which], (cut.end - cut.start)[which]
    chosen = cut.raw[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
    codes = np.frombuffer(chosen.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.where(codes == ord(MARK), ord(_OTHER), np.where(codes == 0x20, ord(MARK), codes))
    heads = np.concatenate([[0], np.cumsum((chosen & 0xC0) != 0x80)])
    chars = np.diff(heads[np.concatenate([[0], np.cumsum(count)])])
    # a very long segment would hold the others up: it is solved alone
    short = chars <= LONG
    size = np.zeros(len(which), np.int64)
    ids, size[short] = vocabulary.solve_many(codes[np.repeat(short, chars)], chars[short])
    if short.all():
        return ids, size
    parts, a, c = [], 0, 0
    for k, n in enumerate(chars.tolist()):
        if short[k]:
            parts.append(ids[a:a + size[k]])
            a += size[k]
        else:
            parts.append(np.array(vocabulary.solve("".join(map(chr, codes[c:c + n])))[1], np.int32))
            size[k] = len(parts[-1])
        c += n
    return np.concatenate(parts), size


def _encode_batch(vocabulary: Vocabulary, column, begins: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text's begin (one more entry than texts).

    begins: whether the texts are whole, with a blank before their begin.
    """
    cut = _Segments(column, vocabulary.joined, begins)
    distinct, first, place = np.unique(cut.hash, return_index=True, return_inverse=True)
    # segments that earlier batches of the task have solved
    known, known_at, known_size, known_ids = vocabulary.memo
    where = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
    found = known[where] == distinct if len(known) else np.zeros(len(distinct), bool)
    new = np.flatnonzero(~found)
    at, size = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
    at[found], size[found] = known_at[where[found]], known_size[where[found]]
    ids, size[new] = _solve(vocabulary, cut, first[new])
    at[new] = len(known_ids) + np.cumsum(size[new]) - size[new]
    flat = np.concatenate([known_ids, ids])
    if len(known) + len(new) > REMEMBERED:
        vocabulary.memo = distinct[new], at[new] - len(known_ids), size[new], ids
    else:
        every = np.concatenate([known, distinct[new]])
        order = np.argsort(every, kind="stable")
        vocabulary.memo = (every[order], np.concatenate([known_at, at[new]])[order],
                           np.concatenate([known_size, size[new]])[order], flat)
    length = size[place] if len(distinct) else np.zeros(0, np.int64)
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    index = np.repeat(at[place] - (ends - length), length) + np.arange(total) if total else np.zeros(0, np.int64)
    return flat[index], np.concatenate([[0], ends])[cut.word_at]


_PARTS = "doc_key long, doc_id long, part int, md5 string, ids array<int>"


def _id_lists(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32()))


def _encode(shared):
    def encode(batches):
        vocabulary = _vocabulary(shared)
        for batch in batches:
            for rows in slices(batch, "text", 2 << 20):
                ids, at = _encode_batch(vocabulary, rows.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_key"), rows.column("doc_id"), pa.array(np.zeros(rows.num_rows, np.int32)),
                     rows.column("md5"), _id_lists(ids, at)], ["doc_key", "doc_id", "part", "md5", "ids"])
    return encode


_CHUNKS = "doc_key long, part int, last boolean, context int, text string"


def _cut(chunk: int, back: int):
    """Chunks of a text, each with the characters before it that a piece may start in."""
    def cut(batches):
        for batch in batches:
            keys = batch.column("doc_key").to_pylist()
            for i, key in enumerate(keys):
                text = batch.column("text")[i].as_py()
                out = {k: [] for k in ("doc_key", "part", "last", "context", "text")}
                for n, a in enumerate(range(0, len(text), chunk)):
                    context = min(back, a)
                    for k, v in zip(out, (key, n, a + chunk >= len(text), context, text[a - context:a + chunk])):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict({
                    "doc_key": pa.array(out["doc_key"], pa.int64()), "part": pa.array(out["part"], pa.int32()),
                    "last": pa.array(out["last"], pa.bool_()), "context": pa.array(out["context"], pa.int32()),
                    "text": pa.array(out["text"], pa.string())})
    return cut


def _lattice(row: dict, longest: int) -> tuple[str, int]:
    """(text as the lattice reads it, position where the chunk begins in it)."""
    if row["part"] == 0:
        return marked(row["text"], True), 0
    if row["context"] < longest - 1:  # the context reaches the text's begin, and the blank before that
        return marked(row["text"], True), row["context"] + 1
    return marked(row["text"], False), row["context"]


def _transfer(shared):
    def transfer(batches):
        vocabulary = _vocabulary(shared)
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                text, begin = _lattice(row, vocabulary.longest)
                found.append(vocabulary.transfer(text, begin).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_key"), batch.column("part"), pa.array(found, pa.binary())],
                                             ["doc_key", "part", "matrix"])
    return transfer


def _matrices(table: pa.Table, order: str) -> tuple[pa.Table, list[np.ndarray]]:
    table = table.sort_by(order)
    flat = [np.frombuffer(x, np.int64) for x in table.column("matrix").to_pylist()]
    return table, [x.reshape(int(len(x) ** 0.5), -1) for x in flat]


def _product(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    _, matrices = _matrices(table, "part")
    whole = matrices[0]
    for m in matrices[1:]:
        whole = compose(whole, m)
    return pa.table({"doc_key": pa.array([key[0].as_py()], pa.int64()), "grp": pa.array([key[1].as_py()], pa.int32()),
                     "matrix": pa.array([whole.tobytes()], pa.binary())})


def _between_groups(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table, matrices = _matrices(table, "grp")
    states = border_states(matrices, 0, 0)
    return pa.table({"doc_key": table.column("doc_key"), "grp": table.column("grp"),
                     "s": pa.array(states[:-1], pa.int32()), "t": pa.array(states[1:], pa.int32())})


def _between_chunks(key: tuple[pa.Scalar, ...], chunks: pa.Table, group: pa.Table) -> pa.Table:
    chunks, matrices = _matrices(chunks, "part")
    states = border_states(matrices, group.column("s")[0].as_py(), group.column("t")[0].as_py())
    return pa.table({"doc_key": chunks.column("doc_key"), "part": chunks.column("part"),
                     "s": pa.array(states[:-1], pa.int32()), "t": pa.array(states[1:], pa.int32())})


def _trace(shared):
    def trace(batches):
        vocabulary = _vocabulary(shared)
        for batch in batches:
            for part in slices(batch, "text"):
                heads, middles, tails, digest = [], [], [], []
                for row in part.to_pylist():
                    text, begin = _lattice(row, vocabulary.longest)
                    head, middle, tail = vocabulary.trace_ends(text, begin, row["s"], row["t"])
                    heads.append(head)
                    middles.append(middle.replace(MARK, " ").replace(_OTHER, MARK))
                    tails.append(tail)
                    # the characters between the borders, without the blank before the text
                    extra = len(text) - len(row["text"])
                    own = row["text"][max(0, begin - row["s"] - extra):len(text) - row["t"] - extra]
                    digest.append(hashlib.md5(own.encode()).hexdigest())
                ids, at = _encode_batch(vocabulary, pa.array(middles, pa.string()), begins=False)
                whole = [np.concatenate([np.array(h, np.int32), ids[a:b], np.array(t, np.int32)])
                         for h, a, b, t in zip(heads, at, at[1:], tails)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_key"), part.column("part"), pa.array(digest, pa.string()),
                     _id_lists(np.concatenate(whole), np.cumsum([0, *map(len, whole)]))], ["doc_key", "part", "md5", "ids"])
    return trace


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.xxhash64(F.col(id_col), text).alias("doc_key"), F.col(id_col).cast("long").alias("doc_id"),
                     text.alias("text"))


def _short(rows: DataFrame, shared, chunk: int) -> DataFrame:
    """One row for each text up to a chunk."""
    return (rows.where(F.length("text") <= chunk).select("*", F.md5("text").alias("md5"))
            .mapInArrow(_encode(shared), _PARTS))


def _after(first, second):
    """Two batch functions as one."""
    def both(batches):
        yield from second(first(batches))
    return both


def _traces(rows: DataFrame, shared, chunk: int, fan: int) -> DataFrame:
    """The chunks of each distinct longer text, with the border states that the max-plus scan gives them."""
    longest = Vocabulary(shared.value).longest
    chunks = (rows.where(F.length("text") > chunk).select("doc_key", "text")
              .mapInArrow(_cut(chunk, longest - 1), _CHUNKS).dropDuplicates(["doc_key", "part"]))
    matrices = (chunks.mapInArrow(_transfer(shared), "doc_key long, part int, matrix binary")
                .withColumn("grp", F.floor(F.col("part") / fan).cast("int")).checkpoint())
    groups = matrices.groupBy("doc_key", "grp").applyInArrow(_product, "doc_key long, grp int, matrix binary")
    outer = groups.groupBy("doc_key").applyInArrow(_between_groups, "doc_key long, grp int, s int, t int")
    states = (matrices.groupBy("doc_key", "grp").cogroup(outer.groupBy("doc_key", "grp"))
              .applyInArrow(_between_chunks, "doc_key long, part int, s int, t int"))
    return chunks.join(states, ["doc_key", "part"]).select("doc_key", "part", "context", "text", "s", "t")


def _long(rows: DataFrame, shared, chunk: int, fan: int) -> DataFrame:
    """doc_key, part, md5, ids for each distinct longer text."""
    return _traces(rows, shared, chunk, fan).mapInArrow(_trace(shared), "doc_key long, part int, md5 string, ids array<int>")


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_key, doc_id, part, md5, ids: one row for each text, or one for each chunk of a longer text.

    part counts a text's rows from 0; md5 is the digest of the characters
    that the row's ids decode to.  Null and empty texts give one row without
    ids.  Equal rows are answered each; other columns are ignored.
    """
    shared = load(df.sparkSession, model)
    rows = _texts(df, id_col, text_col)
    long = rows.where(F.length("text") > chunk).select("doc_key", "doc_id")
    return _short(rows, shared, chunk).unionByName(long.join(_long(rows, shared, chunk, fan), "doc_key").select(
        "doc_key", "doc_id", "part", "md5", "ids"))


def _decode_batch(vocabulary: Vocabulary, batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(texts, ids of all rows, where each row's ids begin)."""
    size = np.array([len(x) for x in vocabulary.text], np.int64)
    at = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(vocabulary.text), np.uint8)
    lists = batch.column("ids")
    ids = np.asarray(lists.flatten(), dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64))])
    length = size[ids]
    ends = np.concatenate([[0], np.cumsum(length)])
    out = flat[np.repeat(at[ids] - ends[:-1], length) + np.arange(ends[-1])].tobytes()
    begin, stop = ends[off[:-1]], ends[off[1:]]
    # the blank before a text's begin is no part of it
    begin = begin + ((np.asarray(batch.column("part")) == 0) & (stop > begin))
    return [out[a:b] for a, b in zip(begin.tolist(), stop.tolist())], ids, off


def _decode(shared):
    def decode(batches):
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in _decode_batch(_vocabulary(shared), batch)[0]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])
    return decode


def decode(parts: DataFrame, model: str | None = None) -> DataFrame:
    """parts (columns part and ids, and any others but text) with the text that each row's ids stand for.

    Joined by part, they are the text that was encoded, character for
    character.  Null lists decode to the empty text.
    """
    rows = parts.drop("text")
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])
    return rows.mapInArrow(_decode(load(parts.sparkSession, model)), schema)


def _check(shared, keep: list[str]):
    def check(batches):
        for batch in batches:
            texts, ids, off = _decode_batch(_vocabulary(shared), batch)
            value = ids + 1
            sums = np.concatenate([[0], np.cumsum(value)])
            place = np.arange(len(ids)) - np.repeat(off[:-1], np.diff(off)) + 1
            placed = np.concatenate([[0], np.cumsum(value * place % _PRIME)])
            same = [hashlib.md5(t).hexdigest() == d for t, d in zip(texts, batch.column("md5").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.diff(off)), pa.array(np.diff(sums[off]).astype(np.int64)),
                 pa.array(np.diff(placed[off]).astype(np.int64)), pa.array(same, pa.bool_())],
                [*keep, "n", "a", "b", "same"])
    return check


_PRIME = (1 << 31) - 1


def report(df: DataFrame, model: str | None = None, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_pieces, ids_check, round_trip for each row of df.

    ids_check: the sum of place (from 1) * (id + 1) over the text's ids,
    modulo 2^31 - 1; round_trip: whether all parts decode to their text.
    """
    shared = load(df.sparkSession, model)
    rows = _texts(df, "doc_id", "text")
    sums = "n long, a long, b long, same boolean"
    # encoding and its check in one pass: ids need not leave the task
    short = (rows.where(F.length("text") <= chunk).select("*", F.md5("text").alias("md5"))
             .mapInArrow(_after(_encode(shared), _check(shared, ["doc_id"])), f"doc_id long, {sums}")).select(
        "doc_id", F.col("n").alias("n_pieces"), (F.col("b") % _PRIME).alias("ids_check"), F.col("same").alias("round_trip"))
    parts = _traces(rows, shared, chunk, fan).mapInArrow(
        _after(_trace(shared), _check(shared, ["doc_key", "part"])), f"doc_key long, part int, {sums}")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("doc_key").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    whole = (parts.withColumn("c", (F.col("b") + before % _PRIME * (F.col("a") % _PRIME)) % _PRIME).groupBy("doc_key")
             .agg(F.sum("n").alias("n_pieces"), (F.sum("c") % _PRIME).alias("ids_check"), F.every("same").alias("round_trip")))
    long = rows.where(F.length("text") > chunk).select("doc_key", "doc_id").join(whole, "doc_key")
    return short.unionByName(long.drop("doc_key"))
