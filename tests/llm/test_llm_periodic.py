"""Periodic runs against a plain search over every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import periodic


def plain(words):
    """Every maximal stretch of each period, kept if that period is its smallest."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and not any(
                    all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out[i, q] = length
            i = j + 1
    return sorted((s, n, q) for (s, q), n in out.items())


def planted(rng, n, alphabet):
    words = [rng.randrange(alphabet) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n), rng.randrange(1, max(2, n // 4))
        for i in range(a + p, min(n, a + p * rng.randrange(2, 6) + rng.randrange(p))):
            words[i] = words[i - p]
    return words


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_plain_search():
    rng = random.Random(7)
    docs = [planted(rng, rng.randrange(1, 260), rng.choice([1, 2, 3, 5, 50, 1000])) for _ in range(400)]
    docs += [[0] * 100, [0, 1] * 60, fibonacci(300), [k % 37 for k in range(300)], [k % 81 for k in range(243)],
             [k % 81 for k in range(242)], [k % 8 for k in range(24)], [k % 9 for k in range(27)], [k % 9 for k in range(26)],
             [bin(k).count("1") % 2 for k in range(256)] * 3, [], [5]]
    found = periodic.runs_of([np.array(d, np.int64) for d in docs])
    assert [sorted(r) for r in found] == [plain(d) for d in docs]
    assert sum(map(len, found)) > 100
    # alone or in company: the same runs
    assert [periodic.runs_of([np.array(d, np.int64)])[0] for d in docs[:60]] == found[:60]


@pytest.mark.parametrize("n", [3_000, 40_000])
def test_long_documents(n):
    rng = random.Random(n)
    for p in (9, 13, 14, 97, 500, n // 3):
        words = [rng.randrange(10**6) for _ in range(n)]
        for i in range(n // 10 + p, min(n, n // 10 + 3 * p + 5)):
            words[i] = words[i - p]
        start, length = n // 10, min(n, n // 10 + 3 * p + 5) - n // 10
        want = [(start, length, p)] if length >= max(24, 3 * p) else []
        got = [r for r in periodic.runs_of([np.array(words, np.int64)])[0]]
        assert [(s, m, q) for s, m, q in got] == want


def repeated(i, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if i is None else str(i).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + k % p] for k in range(n - a)]
    return words


def want(i, text, search=plain):
    words = repeated(i, text)
    runs = search(words)
    stay = [True] * len(words)
    for s, n, q in runs:
        stay[s + q:s + n] = [False] * (n - q)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (i, len(runs), *((best[0], best[1], best[2], best[1] * 1000 // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for w, k in zip(words, stay) if k)))


def test_report_equals_plain_version(spark):
    C.prepare(spark)
    rng = random.Random(3)
    rows = [(i, " \t\n"[i % 3].join(map(str, planted(rng, rng.randrange(1, 120), rng.choice([2, 7, 99]))))) for i in range(100, 300)]
    rows += [(400, "a " * 30), (400, "a " * 30), (None, "b\x0bc\x0c" * 40), (401, None), (402, ""), (403, "é è " * 25)]
    got = sorted(map(tuple, periodic.report(documents(spark, rows)).collect()), key=str)
    assert got == sorted((want(*r) for r in rows), key=str)


def test_edges(spark):
    """The shared rows, 30,000 words and clashing names included; texts that come back whole."""
    C.prepare(spark)
    df = documents(spark)
    rows = periodic.find(df, keep=("doc_id", "lang")).collect()
    assert len(rows) == len(ROWS)
    for r, (i, text) in zip(sorted(rows, key=lambda r: (str(r.doc_id), r.collapsed)),
                            sorted(ROWS, key=lambda x: (str(x[0]), " ".join((x[1] or "").encode().decode().split(None))))):
        assert r.n_words == len((text or "").encode().split())
        if not r.runs:
            assert r.collapsed.encode() == b" ".join((text or "").encode().split())
    assert periodic.report(empty(spark)).collect() == []
    assert periodic.find(empty(spark)).columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_query_on_the_table(spark):
    from chanlytics.llm.queries import QUERIES

    out = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    rows = {r.doc_id: r for r in out.collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and sum(r.n_runs for r in rows.values()) > 0
    for r in docs:
        if len((r.text or "").split()) <= 400:
            assert tuple(rows[r.doc_id])[:8] == want(r.doc_id, r.text)
    kinds = dict(out.dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))
