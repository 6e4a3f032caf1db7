"""Periodic runs of words, found through multi-scale minimizers (op11).

A run is a maximal stretch of words with smallest period q that holds q at
least three times and at least 24 words.  Documents are independent of one
another, so a task scans its Arrow batch, cut into parts of a few MB of
text, and nothing is shuffled.

Short periods (up to SHORT) are found by direct lag scans: the places where
a word equals the one q places on.  Longer ones go by scales.  A scale
looks for periods q from A to B = 3A/2.  It hashes every B-gram of words and
samples those that are the minimum of some window of 2A - B + 1 grams.
* Inside a run of period q >= A a window and its copy q places on both lie
  in the run (its three periods hold q + 2A words), and equal windows
  sample equal places: gram m and gram m + q are both sampled.
* A B-gram holds a whole period, and the period is primitive, so the same
  gram stands nowhere between m and m + q.
Pairs of *successive* equal samples at a distance from A to B therefore meet
every run, and there are no more of them than samples, however often a gram
repeats.  Each chain of overlapping pairs of one distance is extended once,
word by word, to the run's two ends; the hash only proposes, words decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlytics.llm import common as C
from chanlytics.llm.words import mix, slices

#: Least length of a run in words and in periods; longest period of the direct scans.
LEAST_WORDS, LEAST_PERIODS, SHORT = 24, 3, 8
#: Text bytes that are scanned at once (one longer text: all of it).
PART_BYTES = 4 << 20
_P = np.uint64(0x9E3779B97F4A7C15)

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _extreme(x: np.ndarray, size: int, pick) -> np.ndarray:
    """pick over every window of `size` successive values."""
    done = 1
    while done * 2 <= size:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = size - done
    return pick(x[:-rest], x[rest:]) if rest else x


def _sampled(g: np.ndarray, window: int) -> np.ndarray:
    """Places whose value is the least of some window of successive values."""
    if len(g) < window:
        return np.zeros(0, np.int64)
    low = _extreme(g, window, np.minimum)
    edge = np.zeros(window - 1, g.dtype)
    return np.flatnonzero(_extreme(np.concatenate([edge, low, edge]), window, np.maximum) == g)


def _reach(words: np.ndarray, at: int, q: int, step: int) -> int:
    """How many places from `at` on (step 1) or before `at` (step -1) equal the word q places later."""
    most = len(words) - q - at if step > 0 else at
    done, size = 0, 64
    while done < most:
        size = min(size * 2, most - done)
        a = at + done if step > 0 else at - done - size
        differ = np.flatnonzero(words[a:a + size] != words[a + q:a + q + size])
        if len(differ):
            return done + int(differ[0] if step > 0 else size - 1 - differ[-1])
        done += size
    return done


def _primitive(words: np.ndarray, at: int, q: int) -> bool:
    """Whether the q words from `at` are no whole power of fewer."""
    rest, r = q, 2
    while rest > 1:
        if rest % r == 0:
            if np.array_equal(words[at:at + q], words[at + q // r:at + q // r + q]):
                return False
            while rest % r == 0:
                rest //= r
        r = r + 1 if r * r <= rest else max(rest, r + 1)
    return True


def _lag_runs(words: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    least = max(LEAST_WORDS, LEAST_PERIODS * q)
    if len(words) < least:
        return []
    stops = np.flatnonzero(np.concatenate([[True], words[q:] != words[:-q], [True]]))
    size = np.diff(stops) - 1
    return [(int(stops[k]), int(size[k]) + q, q) for k in np.flatnonzero(size >= least - q)
            if _primitive(words, int(stops[k]), q)]


def _scale_runs(words: np.ndarray, g: np.ndarray, a: int, b: int) -> list[tuple[int, int, int]]:
    """Runs of a period from a to b; g: hashes of the b-grams."""
    at = _sampled(g, 2 * a - b + 1)
    order = np.argsort(g[at], kind="stable")
    at = at[order]
    value = g[at]
    lag = np.diff(at)
    near = np.flatnonzero((value[1:] == value[:-1]) & (lag >= a) & (lag <= b))
    place, lag = at[near], lag[near]
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    head = np.ones(len(place), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (np.diff(place) > b)
    out = set()
    for m, q in zip(place[head].tolist(), lag[head].tolist()):
        start = m - _reach(words, m, q, -1)
        length = m - start + _reach(words, m, q, 1) + q
        if length >= max(LEAST_WORDS, LEAST_PERIODS * q) and _primitive(words, start, q):
            out.add((start, length, q))
    return list(out)


def runs_of(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each document's runs, by start, then period.

    documents: word numbers >= 0; equal numbers are equal words.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    long = sorted((k for k, d in enumerate(documents) if len(d) >= LEAST_WORDS), key=lambda k: -len(documents[k]))
    if not long:
        return out
    size = np.array([len(documents[k]) for k in long])
    # longest first, each closed by a number of its own, which no word equals
    words = np.concatenate([x for n, k in enumerate(long) for x in (documents[k], [-1 - n])]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    found = [r for q in range(1, SHORT + 1) for r in _lag_runs(words, q)]
    grams, width = mix(words.astype(np.uint64)), 1  # hashes of the runs of `width` words
    a = SHORT + 1
    while LEAST_PERIODS * a <= size[0]:
        b = a + a // 2
        end = int(begin[np.searchsorted(-size, -LEAST_PERIODS * a, "right")])  # documents that can hold such a run
        while width * 2 <= b:
            grams = mix(grams[:-width] * _P + grams[width:])
            width *= 2
        held = grams[:max(end - width + 1, 0)]
        rest = b - width
        g = mix(held[:-rest] * _P + held[rest:]) if rest else held
        found += _scale_runs(words[:end], g, a, b)
        a = b + 1
    for start, length, q in sorted(found, key=lambda r: (r[0], r[2])):
        k = int(np.searchsorted(begin, start, "right")) - 1
        out[long[k]].append((start - int(begin[k]), length, q))
    return out


def _scan(batches):
    for batch in batches:
        for part in slices(batch, "__text", PART_BYTES):
            raw = part.column(part.schema.get_field_index("__text")).cast(pa.large_binary())
            number: dict[bytes, int] = {}
            texts = [t.split() for t in raw.to_pylist()]  # bytes split at space, tab, newline, \v, \f, return
            found = runs_of([np.fromiter((number.setdefault(w, len(number)) for w in t), np.int64, len(t)) for t in texts])
            kept = []
            for t, runs in zip(texts, found):
                if runs:
                    stay = np.ones(len(t), bool)
                    for start, length, q in runs:
                        stay[start + q:start + length] = False
                    t = [t[i] for i in np.flatnonzero(stay).tolist()]
                kept.append(b" ".join(t))
            names = [n for n in part.schema.names if n != "__text"]
            flat = [r for runs in found for r in runs]
            parts = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)],
                                               ["start", "length", "period"])
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            columns = [part.column(part.schema.get_field_index(n)) for n in names]
            columns += [pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), parts),
                        pc.cast(pa.array(kept, pa.binary()), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "runs", "collapsed"])


def find(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The kept columns, n_words, runs (start, length, period; by start, then period) and the collapsed text.

    collapsed: the words that stand in no run after that run's first period,
    joined by one space.  A null text counts as empty: no words, no runs, an
    empty collapsed text.  Every row is judged by itself, repeated rows
    alike; an empty table gives none.  Columns that are not kept are not
    read, so their names cannot clash; kept ones may not be called n_words,
    runs or collapsed.  A text is scanned whole, in one task, at about 200
    bytes a word.
    """
    rows = df.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    kept = [f for f in rows.schema.fields if f.name != "__text"]
    return rows.mapInArrow(_scan, T.StructType([
        *kept, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]))


def with_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): in every tenth document, by crc32 of its id, the words from some place on repeat.

    h = crc32(id as text), g = h div 10; where h mod 10 = 0 and the text has
    n > 0 words, word i >= a becomes word a + (i - a) mod p, a = g mod n,
    p = 1 + (n - a) div (3 + g mod 8).  A null id counts as the empty text.
    """
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(C.id_text(id_col))
    g = F.floor(h / 10)
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col), h.alias("__h"), g.alias("__g"),
                     F.when(h % 10 == 0, words).alias("__w"))
    n = F.size("__w")
    a = (F.col("__g") % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("__g") % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("__w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice("__w", F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return rows.select(id_col, F.when((F.col("__h") % 10 == 0) & (n > 0), text).otherwise(F.col(text_col)).alias(text_col))


def _digest(runs: Column) -> Column:
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(line, ""), 256)


def _before(x: Column, y: Column) -> Column:
    """Order of runs: the greater length / period (as fractions), the smaller start, the smaller period."""
    more, less = x["length"] * y["period"], y["length"] * x["period"]
    return (F.when(more != less, F.when(more > less, -1).otherwise(1))
            .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
            .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its runs in figures and digests, over texts with planted repeats."""
    found = find(with_repeats(docs.select("doc_id", "text")))
    best = F.get(F.array_sort("runs", _before), 0)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        _digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                       F.col("best.period").alias("period"),
                       F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
