"""Decontamination and substring dedup against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import types as T

from cases import BASE, LONG, ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import decontaminate, substring_dedup

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(1, BASE), (2, "Beta gamma"), (3, None), (4, ""), (5, "nowhere to be found in any text at all ever"),
         (6, " ".join(LONG.split()[500:540])), (6, "one-two THREE four"), (None, "naïve café"), (10, "a"),
         (11, "a a a a a a a a a a a")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("window", T.IntegerType())]))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def contamination(text, rows):
    words, hit, named = alnum(text), set(), set()
    where = {}
    for i, w in enumerate(words):
        where.setdefault(w, []).append(i)
    for item, t in rows:
        own = alnum(t)
        k = min(10, len(own))
        for s in range(len(own) - k + 1 if k else 0):
            for i in where.get(own[s], ()):
                if words[i:i + k] == own[s:s + k]:
                    hit.update(range(i, i + k))
                    named.add("" if item is None else str(item))
    return len(words), len(hit), sorted(named)


@pytest.mark.parametrize("pass_windows", [250_000, 7])
def test_decontamination(spark, pass_windows):
    C.prepare(spark)
    got = decontaminate.contamination(documents(spark), items(spark), pass_windows=pass_windows).collect()
    want = sorted((str(i), *contamination(t, ITEMS)) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got) == want
    clean = decontaminate.keep_clean(documents(spark), items(spark), pass_windows=pass_windows)
    assert clean.columns == documents(spark).columns
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == sorted(
        str(r) for r in ROWS if not contamination(r[1], ITEMS)[1])


def test_decontamination_of_empty_tables(spark):
    C.prepare(spark)
    assert decontaminate.contamination(empty(spark), items(spark)).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(documents(spark), items(spark, [])).collect()} == {0}
    assert decontaminate.keep_clean(documents(spark), items(spark, [])).count() == len(ROWS)


def repeats(rows, size):
    """(id, words, removed, kept) by the definition; equal (id, start) are not earlier than each other."""
    far = 1 << 62
    texts = [(far if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        for s in range(len(w) - size + 1):
            key = tuple(w[s:s + size])
            first[key] = min(first.get(key, (far + 1, 0)), (i, s))
    out = []
    for (i, _), (o, w) in zip(rows, texts):
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] < (o, s):
                gone.update(range(s, s + size))
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("size,block_bytes", [(20, 1 << 22), (20, 1 << 14), (5, 1 << 16), (1, 1 << 16), (3, 1 << 22)])
def test_substring_dedup(spark, size, block_bytes):
    C.prepare(spark)
    rows = [(i, t if t is None or len(t) < 5000 else " ".join(t.split()[:600])) for i, t in ROWS]
    got = substring_dedup.remove_repeats(documents(spark, rows), size, block_bytes=block_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == repeats(rows, size)


def test_substring_dedup_of_long_texts(spark):
    C.prepare(spark)
    got = substring_dedup.remove_repeats(documents(spark), digest=True, block_bytes=1 << 16).collect()
    want = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in repeats(ROWS, 20)]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def test_substring_dedup_of_an_empty_table(spark):
    C.prepare(spark)
    assert substring_dedup.remove_repeats(empty(spark)).collect() == []


def test_covers_hold_every_difference():
    for v, cover in substring_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
