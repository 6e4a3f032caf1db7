"""Keyword frequency with the reference's counting rule.

Rule (per message, on the lower-cased text):
* a one-word keyword counts once per token equal to it;
* a keyword of two or more words counts once per *token of the text*
  when it is a substring of the text (the reference tests phrases inside
  its per-token loop), so a phrase hit adds ``size(tokens)``.

The dictionary is probed inside the row.  It is a literal of the plan: an
array of slots, indexed by crc32, with the words (or phrases) of each slot.
* A token is looked up in its slot, and only the hits are exploded.
* A few phrases are tested one by one.  Of many, an Aho-Corasick automaton
  finds those that a text holds in one pass, in Arrow batches.  Where its
  package is not installed, a phrase is looked up by its first gap between
  words instead: the last characters before it and the first after it (up
  to two each); phrases whose first two words fit there are tested.
So a text never leaves its row: what shuffles is one partial sum per keyword
and group of a task.

A literal needs a bound: words, or phrases, of more than LITERAL_CHARS
characters are a relation instead, which counted tokens (``_joined_words``)
or counted candidates (``_joined_phrases``: spans of a text that a bitmap of
the phrases lets through) are joined to, with the same result; texts do not
move there either.
"""

from __future__ import annotations

import importlib.util
import json
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlytics.functions.text import tokens
from chanlytics.session import stored

# The characters that the reference's language splits at.
_BLANKS = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
BLANK = f"[{_BLANKS}]"
EDGE = 2  # characters on either side of a phrase's first gap
FEW_PHRASES = 32  # so many phrases are tested one by one
#: Characters of a dictionary that may be a literal of the plan.
LITERAL_CHARS = 1 << 20


def _parts(text: Column) -> Column:
    """The blank-separated parts of a text."""
    return F.array_remove(F.split(text, BLANK + "+"), "")


def dictionary(keywords: "DataFrame | list[str]", column: str, like: DataFrame) -> DataFrame:
    """(product_name, parts) of the distinct non-NULL keywords."""
    if isinstance(keywords, list):
        # literals of the plan, of known size; Spark broadcasts them if they are few
        listed = F.array(*[F.lit(k) for k in dict.fromkeys(keywords) if k is not None]).cast("array<string>")
        kw = like.sparkSession.range(1).select(F.explode(listed).alias("product_name"))
    else:
        kw = keywords.select(F.col(column).alias("product_name")).where("product_name is not null").distinct()
    return kw.withColumn("parts", _parts(F.col("product_name")))


def _sides(keywords: "DataFrame | list[str]", column: str, like: DataFrame, most: int) -> list:
    """[words, phrases] of a dictionary: a list of at most ``most`` characters, else a relation."""
    if isinstance(keywords, list):
        own = [k for k in dict.fromkeys(keywords) if k is not None]
        sides = [[k for k in own if len(k.split()) < 2], [k for k in own if len(k.split()) > 1]]
        if all(sum(len(k) + 1 for k in x) <= most for x in sides):
            return sides
    kw = stored(dictionary(keywords, column, like), "keywords")  # made once, whatever it is derived from
    which = [F.size("parts") < 2, F.size("parts") > 1]
    size = kw.agg(*[F.sum(F.when(w, F.length("product_name") + 1)) for w in which]).first()
    return [[r[0] for r in kw.where(w).select("product_name").collect()] if (n or 0) <= most else kw.where(w)
            for w, n in zip(which, size)]


class _Slots:
    """Rows of a dictionary as a literal array of slots, indexed by crc32 of a key."""

    def __init__(self, rows: list[tuple[str, object]], kind: str):
        self.size = 1 << max(4, (2 * len(rows)).bit_length())
        slots: list[list] = [[] for _ in range(self.size)]
        for key, value in rows:
            slots[zlib.crc32(key.encode()) % self.size].append(value)
        # one foldable expression; the optimizer evaluates it once
        self.literal = F.from_json(F.lit(json.dumps(slots)), f"array<array<{kind}>>")

    def of(self, key: Column) -> Column:
        return F.get(self.literal, (F.crc32(key) % self.size).cast("int"))


def _edge(left: Column, right: Column, a: int, b: int) -> Column:
    return F.concat(F.substring(left, -a, a), F.lit(" "), F.substring(right, 1, b))


def _shape(phrase: str) -> tuple[int, int]:
    """Characters that a phrase has before and after its first gap, up to EDGE each."""
    first, second = phrase.split()[:2]
    return min(len(first), EDGE), min(len(second), EDGE)


def _gap(phrase: str) -> str:
    first, second = phrase.split()[:2]
    return f"{first[-EDGE:]} {second[:EDGE]}"


def _automaton(phrases: list[str]):
    """A function of texts: the phrases that each holds, in one pass over it."""
    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for p in phrases:
            automaton.add_word(p, p)
        automaton.make_automaton()
        for texts in batches:
            yield texts.map(lambda t: list({p for _, p in automaton.iter(t)}))
    return found


def _phrase_hits(rows: DataFrame, phrases: list[str], automaton: bool | None = None) -> tuple[DataFrame, Column]:
    """(rows with what the column needs, the phrases that the lower-cased text lt holds)."""
    if automaton is None:
        automaton = importlib.util.find_spec("ahocorasick") is not None
    if len(phrases) <= FEW_PHRASES:
        return rows, F.array_compact(F.array(*[F.when(F.contains("lt", F.lit(p)), F.lit(p)) for p in phrases]))
    if automaton:
        return rows.withColumn("__found", _automaton(phrases)("lt")), F.col("__found")
    slots = _Slots([(_gap(p), dict(zip("fs", p.split()), p=p)) for p in phrases], "struct<f:string,s:string,p:string>")
    shapes = sorted({_shape(p) for p in phrases})
    # parts are used in several places, which keeps them a column of their own
    keyed = rows.withColumn("__parts", _parts(F.col("lt")))

    def at_gap(i: Column) -> Column:
        left, right = F.get("__parts", i), F.get("__parts", i + 1)
        own = F.flatten(F.array(*[slots.of(_edge(left, right, a, b)) for a, b in shapes]))
        return F.transform(F.filter(own, lambda x: F.endswith(left, x["f"]) & F.startswith(right, x["s"])), lambda x: x["p"])

    near = F.flatten(F.transform(F.sequence(F.lit(0), F.size("__parts") - 2), at_gap))
    none = F.array().cast("array<string>")
    keyed = keyed.withColumn("__near", F.when(F.size("__parts") > 1, F.array_distinct(near)).otherwise(none))
    return keyed, F.filter("__near", lambda p: F.contains(F.col("lt"), p))


HIT = "struct<product_name:string,n:bigint>"


def _with_hits(texts: DataFrame, words: list[str], phrases: list[str], text_col: str, group_cols: list[str]) -> DataFrame:
    """(group_cols..., hits): each non-NULL text's keywords as (product_name, n), found in the row."""
    rows = _texts(texts, text_col, group_cols).withColumn("toks", tokens("lt"))
    none = F.array().cast(f"array<{HIT}>")
    hits = none
    if phrases:
        rows, found = _phrase_hits(rows, phrases)
        n = F.size("toks").cast("long")
        hits = F.transform(F.when(n > 0, found), lambda p: F.struct(p.alias("product_name"), n.alias("n"))).cast(f"array<{HIT}>")
        hits = F.coalesce(hits, none)
    if words:
        slots = _Slots([(w, w) for w in words], "string")
        own = F.filter("toks", lambda t: F.array_contains(slots.of(t), t))
        own = F.transform(own, lambda t: F.struct(t.alias("product_name"), F.lit(1).cast("long").alias("n"))).cast(f"array<{HIT}>")
        hits = F.concat(hits, own)
    return rows.select(*group_cols, hits.alias("hits"))


def _texts(texts: DataFrame, text_col: str, group_cols: list[str]) -> DataFrame:
    return texts.where(F.col(text_col).isNotNull()).select(*group_cols, F.lower(F.col(text_col)).alias("lt"))


def _joined_words(src: DataFrame, words: DataFrame, group_cols: list[str]) -> DataFrame:
    """Tokens are counted per group before they meet the words."""
    # outer: a plain explode would have the tokens made twice, for a filter on their number
    return (src.select(*group_cols, F.explode_outer(tokens("lt")).alias("product_name")).where("product_name is not null")
            .groupBy(*group_cols, "product_name").agg(F.count(F.lit(1)).alias("n"))
            .join(words.select("product_name"), "product_name").select(*group_cols, "product_name", "n"))


_BLANK_TABLE = np.zeros(0x3001, bool)
_BLANK_TABLE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
#: Bits of the filter for a phrase, and in all; with more phrases it lets more candidates through.
FILTER_BITS, MOST_FILTER_BITS = 128, 1 << 27
_FIRST, _LAST, _WHOLE = (np.uint64(x) for x in (0x1000193, 0x2000193, 0x3000193))
_CHUNK = 1 << 20  # characters whose hashes are made at once


class _Spans:
    """Some texts as code points, with the hash of any span of them."""

    def __init__(self, texts: list[str]):
        self.text = "\n".join(texts)
        code = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        self.begin = np.cumsum([0] + [len(t) + 1 for t in texts])  # of each text; one character lies between two
        power = np.full(len(code) + 1, _P)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
        back = np.full(len(code) + 1, _P_INV)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        word = ~_BLANK_TABLE[np.minimum(code, 0x3000)] | (code > 0x3000)
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.of = np.searchsorted(self.begin, self.start, "right") - 1

    def bits(self, start: np.ndarray, end: np.ndarray, kind: np.uint64, bits: int) -> np.ndarray:
        """The filter's bit of each span, for one kind of key."""
        x = (self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * kind
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts side by side, of about _CHUNK characters, or one."""
    own, size = [], 0
    for t in texts:
        if own and size + len(t) > _CHUNK:
            yield own
            own, size = [], 0
        own.append(t)
        size += len(t) + 1
    if own:
        yield own


def _phrase_filter(phrases: DataFrame) -> tuple[bytes, int, list[tuple[int, ...]]]:
    """(bitmap, its bits, shapes): what a task needs to find candidates for the phrases.

    The bitmap holds a bit for each phrase, its first and its last part.  A
    shape: how many blanks lead, characters of the first part, parts,
    characters of the last part, blanks at the end.
    """
    name = F.col("product_name")
    shape = F.struct(F.length(F.regexp_extract(name, f"^{BLANK}*", 0)), F.length(F.get("parts", 0)), F.size("parts"),
                     F.length(F.element_at("parts", -1)), F.length(F.regexp_extract(name, f"{BLANK}*$", 0)))
    n, shapes = phrases.agg(F.count(F.lit(1)), F.collect_set(shape)).first()
    bits = min(MOST_FILTER_BITS, max(1 << 16, 1 << (FILTER_BITS * n).bit_length()))

    @F.pandas_udf("long")
    def bit(keys: pd.Series, kind: pd.Series) -> pd.Series:
        out = []
        for own in _chunks(keys.tolist()):
            spans = _Spans(own)
            out.append((spans.begin[:-1], spans.begin[1:] - 1, spans))
        found = [spans.bits(a, b, np.uint64(kind.iloc[0]), bits) for a, b, spans in out]
        return pd.Series(np.concatenate(found) if found else np.zeros(0, np.int64))

    # numbered from 1, as the bitmap functions have it
    keys = [phrases.select((bit(key, F.lit(int(kind))) + 1).alias("b"))
            for key, kind in ((F.get("parts", 0), _FIRST), (F.element_at("parts", -1), _LAST), (name, _WHOLE))]
    rows = (reduce(DataFrame.union, keys).groupBy(F.bitmap_bucket_number("b").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m")).collect())
    bitmap = bytearray(bits // 8)
    for r in rows:
        bitmap[(r.k - 1) * 4096:(r.k - 1) * 4096 + len(r.m)] = r.m
    return bytes(bitmap[:bits // 8]), bits, sorted(map(tuple, shapes))


def _candidates(texts: list[str], bitmap: np.ndarray, bits: int, shapes: list[tuple[int, ...]]) -> list[list[str]]:
    """For each text, its distinct spans of a phrase's shape that the filter lets through: every phrase it holds, and a few more.

    A phrase stands where its first part ends a part of the text, and its last one begins a part.
    """
    spans = _Spans(texts)
    start, end, of = spans.start, spans.end, spans.of
    known: dict[tuple, np.ndarray] = {}

    def passes(a: np.ndarray, b: np.ndarray, kind: np.uint64) -> np.ndarray:
        at = spans.bits(a, b, kind, bits)
        return bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0

    def parts(kind: np.uint64, size: int) -> np.ndarray:
        """Whether each part ends with a first part, or begins with a last one, of so many characters."""
        if (kind, size) not in known:
            out, long = np.zeros(len(start), bool), np.flatnonzero(end - start >= size)
            a = end[long] - size if kind == _FIRST else start[long]
            out[long] = passes(a, a + size, kind)
            known[kind, size] = out
        return known[kind, size]

    found: list[set[str]] = [set() for _ in texts]
    for lead, first, count, last, trail in shapes:
        at = np.flatnonzero(parts(_FIRST, first)[:len(start) - count + 1]) if len(start) >= count else np.zeros(0, np.int64)
        at = at[parts(_LAST, last)[at + count - 1]]
        a, b = end[at] - first - lead, start[at + count - 1] + last + trail
        inside = (of[at] == of[at + count - 1]) & (a >= spans.begin[of[at]]) & (b < spans.begin[of[at] + 1])
        at, a, b = at[inside], a[inside], b[inside]
        hit = passes(a, b, _WHOLE)
        for d, i, j in zip(of[at[hit]].tolist(), a[hit].tolist(), b[hit].tolist()):
            found[d].add(spans.text[i:j])
    return [list(x) for x in found]


def _joined_phrases(src: DataFrame, phrases: DataFrame, group_cols: list[str]) -> DataFrame:
    """A text's candidates are counted per group before they meet the phrases.

    A filter of bounded size goes to the tasks instead of the phrases; what
    it lets through wrongly, the join takes out.  Texts do not move.
    """
    bitmap, bits, shapes = _phrase_filter(phrases)

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = np.frombuffer(bitmap, np.uint8)
        for texts in batches:
            own = [c for some in _chunks(texts.tolist()) for c in _candidates(some, held, bits, shapes)]
            yield pd.Series(own, dtype=object)

    rows = src.select(*group_cols, F.size(tokens("lt")).cast("long").alias("n"), found("lt").alias("p"))
    return (rows.select(*group_cols, "n", F.explode_outer("p").alias("product_name")).where("product_name is not null")
            .groupBy(*group_cols, "product_name").agg(F.sum("n").alias("n"))
            .join(phrases.select("product_name"), "product_name").select(*group_cols, "product_name", "n"))


def _hits(texts: DataFrame, sides: list, text_col: str, group_cols: list[str]) -> list[DataFrame]:
    """(group_cols..., product_name, n): in the row for the sides that are lists, joined for the others."""
    lists = [x if isinstance(x, list) else [] for x in sides]
    out = []
    if any(lists) or all(isinstance(x, list) for x in sides):
        # outer, as above
        hits = _with_hits(texts, *lists, text_col, group_cols).select(*group_cols, F.inline_outer("hits"))
        out.append(hits.where("product_name is not null"))
    src = _texts(texts, text_col, group_cols)
    for side, joined in zip(sides, (_joined_words, _joined_phrases)):
        if not isinstance(side, list):
            out.append(joined(src, side, group_cols))
    return out


def keyword_hits(texts: DataFrame, keywords: "DataFrame | list[str]",
                 text_col: str = "message_text", group_cols: list[str] | None = None,
                 keyword_col: str = "keyword", literal_chars: int = LITERAL_CHARS) -> DataFrame:
    """(group_cols..., product_name, mention_count) over non-NULL texts."""
    group_cols = group_cols or []
    sides = _sides(keywords, keyword_col, texts, literal_chars)
    hits = reduce(DataFrame.unionByName, _hits(texts, sides, text_col, group_cols))
    return (hits.groupBy(*group_cols, "product_name").agg(F.sum("n").cast("long").alias("mention_count"))
            .where("mention_count > 0"))


def first_words(kw: DataFrame, literal_chars: int = LITERAL_CHARS):
    """Column -> Column: whether a word begins a keyword of the dictionary (true for any word if that is too long)."""
    first = kw.select(F.get("parts", 0).alias("k")).where("k is not null").distinct()
    if (first.agg(F.sum(F.length("k") + 1)).first()[0] or 0) > literal_chars:
        return lambda x: F.lit(True)
    slots = _Slots([(r.k, r.k) for r in first.collect()], "string")
    return lambda x: F.array_contains(slots.of(x), x)


def mentions(texts: DataFrame, keywords: "DataFrame | list[str]", key: str, text_col: str = "message_text",
             group_cols: list[str] | None = None, keyword_col: str = "keyword",
             literal_chars: int = LITERAL_CHARS) -> DataFrame:
    """(group_cols..., mentioned): texts and whether they have a hit; texts without one may be missing.

    ``key`` tells texts apart where they are joined.
    """
    group_cols = group_cols or []
    sides = _sides(keywords, keyword_col, texts, literal_chars)
    if all(isinstance(x, list) for x in sides):
        # a column, not a filter, which would be moved down and find the hits again
        return _with_hits(texts, *sides, text_col, group_cols).select(*group_cols, (F.size("hits") > 0).alias("mentioned"))
    hits = reduce(DataFrame.unionByName, _hits(texts, sides, text_col, [key, *group_cols]))
    return hits.where("n > 0").select(key, *group_cols).distinct().select(*group_cols, F.lit(True).alias("mentioned"))
