"""Benchmark decontamination: prefix-filtered containment join on word windows.

A window is `size` consecutive words of a benchmark item (an item with
fewer words is one window).  Containment must be exact, so the prefix of a
window's shingles that a match needs is one shingle: the rarest in the
corpus.  Rarity is counted over all documents.  Documents are scanned for
those shingles only; the shingle's offset fixes where the window would
start (positional bound), the window's length where it would end (length
bound), and the words in between are compared one by one.

The distinct windows are looked up in passes of at most `pass_windows`, the
bound of what is broadcast; larger benchmarks take more passes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics.llm import common as C
from chanlytics.llm.words import ALNUM, LOWER, Words, run_hash, slices

SHINGLE = 3
PASS_WINDOWS = 250_000
_FILTER_BITS = 22


def _item_windows(size: int):
    def windows(batches):
        for batch in batches:
            words = Words(batch.column("text"), ALNUM, LOWER)
            ids = batch.column("item_id").to_pylist()
            for d, n in enumerate(words.count):
                if not n:
                    continue
                own = words.hash[words.word_at[d]:words.word_at[d + 1]]
                k = min(size, n)
                at = np.arange(n - k + 1)
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.array([ids[d]] * len(at), pa.string()),
                    "window": pa.array(run_hash(own, at, k).view(np.int64)),
                    "words": pa.array([own[i:i + k].tobytes() for i in at], pa.binary())})
    return windows


class _Windows:
    """The windows of one pass: their words, and the shingles of each."""

    def __init__(self, keys: list[int], words: list[bytes], size: int):
        self.keys = np.array(keys, np.int64)
        self.length = np.array([len(w) // 8 for w in words], np.int64)
        self.words = np.zeros((len(words), size), np.uint64)
        for i, w in enumerate(words):
            self.words[i, :len(w) // 8] = np.frombuffer(w, np.uint64)
        window, offset, width, key = [], [], [], []
        for n in np.unique(self.length):
            own = np.flatnonzero(self.length == n)
            k = min(SHINGLE, int(n))
            for o in range(n - k + 1):
                window.append(own)
                offset.append(np.full(len(own), o))
                width.append(np.full(len(own), k))
                key.append(run_hash(self.words[own].ravel(), np.arange(len(own)) * size + o, k))
        self.window, self.offset, self.width, self.key = map(np.concatenate, (window, offset, width, key))


class _Lookup:
    """Sorted shingle keys of each width, behind a bit filter."""

    def __init__(self, width: np.ndarray, key: np.ndarray):
        self.by_width = {}
        for k in np.unique(width):
            keys = np.unique(key[width == k])
            flags = np.zeros(1 << _FILTER_BITS, bool)
            flags[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.by_width[int(k)] = (keys, flags)

    def hits(self, words: Words):
        """(width, word positions, place among the width's keys) of every listed shingle in the batch."""
        for k, (keys, flags) in self.by_width.items():
            at, _ = words.windows(k)
            hashes = run_hash(words.hash, at, k)
            near = np.flatnonzero(flags[hashes >> np.uint64(64 - _FILTER_BITS)])
            place = np.searchsorted(keys, hashes[near])
            same = keys[np.minimum(place, len(keys) - 1)] == hashes[near]
            yield k, at[near[same]], place[same]


def _count(shared):
    def count(batches):
        lookup = shared.value
        sums = {k: np.zeros(len(keys), np.int64) for k, (keys, _) in lookup.by_width.items()}
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), ALNUM, LOWER)
                for k, _, place in lookup.hits(words):
                    sums[k] += np.bincount(place, minlength=len(sums[k]))
        for k, n in sums.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"shingle": lookup.by_width[k][0][seen].view(np.int64), "n": n[seen]})
    return count


class _Index(_Lookup):
    """For each kept shingle, the windows that start it and its offset in them."""

    def __init__(self, windows: _Windows, rarity: dict[int, int]):
        count = np.array([rarity.get(int(k), 0) for k in windows.key.view(np.int64)])
        order = np.lexsort((windows.key, count, windows.window))
        lead = order[np.unique(windows.window[order], return_index=True)[1]]
        # windows whose rarest shingle is nowhere in the corpus cannot occur
        lead = lead[count[lead] > 0]
        super().__init__(windows.width[lead], windows.key[lead])
        self.windows = windows
        self.entries = {}
        for k, (keys, _) in self.by_width.items():
            own = lead[windows.width[lead] == k]
            own = own[np.argsort(windows.key[own], kind="stable")]
            self.entries[k] = (np.searchsorted(windows.key[own], keys), own)

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window."""
        w, starts, found = self.windows, [], []
        doc_end = words.word_at[1:]
        for k, at, place in self.hits(words):
            begin, own = self.entries[k]
            stop = np.append(begin[1:], len(own))
            n = stop[place] - begin[place]
            each = np.repeat(np.arange(len(at)), n)
            entry = own[begin[place][each] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            window = w.window[entry]
            start = at[each] - w.offset[entry]
            doc = np.searchsorted(words.word_at, at[each], "right") - 1
            fits = (start >= words.word_at[doc]) & (start + w.length[window] <= doc_end[doc])
            start, window = start[fits], window[fits]
            for o in range(w.words.shape[1]):
                inside = o < w.length[window]
                same = ~inside | (words.hash[np.minimum(start + o, len(words.hash) - 1)] == w.words[window, o])
                start, window = start[same], window[same]
            starts.append(start)
            found.append(window)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(found)


_FOUND = "doc_key long, doc_id long, n_words long, spans array<struct<a:int,b:int>>, windows array<long>"
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _match(shared):
    def match(batches):
        index = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), ALNUM, LOWER)
                start, window = index.matches(words)
                depth = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, start + index.windows.length[window], -1)
                hit = np.cumsum(depth[:-1]) > 0
                doc = words.doc_of_word()
                # runs of hit words inside one document
                first = hit.copy()
                first[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
                last = hit.copy()
                last[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
                a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
                base = words.word_at[doc[a]]
                spans = pa.ListArray.from_arrays(
                    np.searchsorted(a, words.word_at).astype(np.int32),
                    pa.StructArray.from_arrays([pa.array((a - base).astype(np.int32)),
                                                pa.array((b - base).astype(np.int32))], ["a", "b"]))
                pairs = np.unique(np.stack([np.searchsorted(words.word_at, start, "right") - 1,
                                            index.windows.keys[window]]), axis=1)
                lists = pa.ListArray.from_arrays(
                    np.searchsorted(pairs[0], np.arange(len(words.count) + 1)).astype(np.int32), pa.array(pairs[1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_key"), part.column("doc_id"), pa.array(words.count.astype(np.int64)),
                     spans.cast(_SPANS), lists], ["doc_key", "doc_id", "n_words", "spans", "windows"])
    return match


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """doc_key, doc_id, n_words, spans (hit word ranges), n_hit, items (ids as sorted text) for each row of docs.

    Words are runs of a-z, 0-9 and non-ASCII after lower-casing A-Z.  Null
    and empty texts have no words and are never hit; items without words
    have no window; a null item id counts as the empty text.  Repeated rows
    are answered each; other columns are ignored.
    """
    windows, distinct, passes = _item_table(items, size, item_id, item_text, pass_windows)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("doc_key"), F.col(id_col).cast("long").alias("doc_id"),
                       text.alias("text"))
    found = None
    for p in range(passes):
        part = _one_pass(rows, _index(rows, distinct, size, p, passes), p)
        found = part if found is None else found.unionByName(part)
    if passes > 1:  # equal rows of one pass collapse; copies counts them
        found = (found.groupBy("doc_key", "doc_id", "n_words")
                 .agg(F.collect_set(F.struct("pass", "spans", "windows")).alias("g"),
                      (F.count(F.lit(1)) / passes).cast("int").alias("copies"))
                 .select("doc_key", "doc_id", "n_words", F.flatten("g.spans").alias("spans"),
                         F.flatten("g.windows").alias("windows"), F.explode(F.sequence(F.lit(1), "copies"))).drop("col"))
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"),
                              F.greatest(s["end"], x["b"]).alias("end")),
        lambda s: s["n"].cast("long"))
    result = found.withColumn("n_hit", covered)
    named = (result.where("n_hit > 0").select("doc_key", F.explode("windows").alias("window")).distinct()
             .join(windows.select("window", "item_id").distinct(), "window")
             .groupBy("doc_key").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return (result.drop("windows", "pass").join(named, "doc_key", "left")
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))


def _item_table(items: DataFrame, size: int, item_id: str, item_text: str, pass_windows: int):
    """(windows of all items, distinct windows, passes)."""
    listed = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"),
                          F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    windows = listed.mapInArrow(_item_windows(size), "item_id string, window long, words binary")
    distinct = windows.groupBy("window").agg(F.min("words").alias("words"))
    return windows, distinct, max(1, math.ceil(distinct.count() / pass_windows))


def _index(rows: DataFrame, distinct: DataFrame, size: int, number: int, passes: int):
    """The broadcast index of one pass over rows (doc texts in column text), or None if it has no windows."""
    sc = rows.sparkSession.sparkContext
    own = distinct.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == number).collect()  # pass_windows on average
    if not own:
        return None
    group = _Windows([r[0] for r in own], [bytes(r[1]) for r in own], size)
    shingles = sc.broadcast(_Lookup(group.width, group.key))
    counts = rows.select("text").mapInArrow(_count(shingles), "shingle long, n long").groupBy("shingle").agg(F.sum("n"))
    return sc.broadcast(_Index(group, {r[0]: r[1] for r in counts.collect()}))  # one entry a shingle


def _one_pass(rows: DataFrame, index, number: int) -> DataFrame:
    if index is None:
        nothing = F.array()
        return rows.mapInArrow(_match_nothing, "doc_key long, doc_id long, n_words long").select(
            "*", nothing.cast("array<struct<a:int,b:int>>").alias("spans"), nothing.cast("array<long>").alias("windows"),
            F.lit(number).alias("pass"))
    return rows.mapInArrow(_match(index), _FOUND).withColumn("pass", F.lit(number))


def keep_clean(docs: DataFrame, items: DataFrame, size: int = 10, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of an item occurs; null texts stay."""
    _, distinct, passes = _item_table(items, size, item_id, item_text, pass_windows)
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = docs
    for p in range(passes):
        index = _index(texts, distinct, size, p, passes)
        if index is not None:
            out = out.mapInArrow(_clean(index, text_col), docs.schema)
    return out


def _clean(shared, text_col: str):
    def clean(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                words = Words(part.column(text_col), ALNUM, LOWER)
                start, _ = shared.value.matches(words)
                good = np.ones(part.num_rows, bool)
                good[np.searchsorted(words.word_at, start, "right") - 1] = False
                yield part.filter(pa.array(good))
    return clean


def _match_nothing(batches):
    for batch in batches:
        words = Words(batch.column("text"), ALNUM, LOWER, hashes=False)
        yield pa.RecordBatch.from_arrays([batch.column("doc_key"), batch.column("doc_id"),
                                          pa.array(words.count.astype(np.int64))], ["doc_key", "doc_id", "n_words"])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest columns of contamination()."""
    found = contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH low AS (SELECT doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
             FROM documents),
dw AS (SELECT id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') AS k
        FROM bw, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS t(s) WHERE len(ws) > 0),
occ AS (SELECT id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS k
        FROM dw, (SELECT DISTINCT n FROM win) AS sizes, unnest(range(1, len(ws) - n + 2)) AS t(s)),
hit AS (SELECT occ.id, occ.s, occ.n, win.item_id FROM occ JOIN win USING (n, k)),
words AS (SELECT id, count(DISTINCT s + o) AS n_hit FROM hit, unnest(range(0, n)) AS t(o) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
          FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY id)
SELECT dw.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (id) LEFT JOIN named USING (id)
"""
