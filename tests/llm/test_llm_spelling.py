"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cases import ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(rows, pairs=None):
    words = counts(rows)
    form, out = {}, []
    for w, n in words.items():
        own = sorted((x for x in words if near(w, x)), key=lambda x: (-words[x], x))
        form[w] = own[0] if own and words[own[0]] >= 2 * n else None
        out.append([w, form[w], None, n, len(own), words[form[w]] if form[w] else None])
    for r in out:
        root = r[0]
        while form[root]:
            root = form[root]
        r[2] = root
    return sorted(map(tuple, out))


def corpus(seed, docs, base):
    rng = random.Random(seed)
    letters = "abcdeé÷ÀÿT"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(base)]
    def spoil(w):
        k = rng.randrange(len(w))
        return w if rng.random() < 0.6 else rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k + 1:],
                                                        w[:k] + rng.choice(letters) + w[k:]])
    return [(i, rng.choice([" ", ", ", "\n", "-"]).join(spoil(rng.choice(words[:1 + rng.randrange(base)])) for _ in range(60)))
            for i in range(docs)]


def test_products_equal_edit_test():
    rng = random.Random(1)
    words = list({"".join(rng.choice("abcé") for _ in range(n)) for n in (5, 5, 6, 7) for _ in range(120)})
    by = {n: [w for w in words if len(w) == n] for n in (5, 6, 7)}
    rows = {n: np.array([list(w.encode("latin-1")) for w in ws], np.uint8) for n, ws in by.items()}
    for n, m in ((5, 5), (5, 6), (6, 7), (7, 7)):
        i, j = S.near_pairs(rows[n], rows[m])
        got = {(by[n][a], by[m][b]) for a, b in zip(i, j)}
        assert got == {(a, b) for a in by[n] for b in by[m] if near(a, b)}


@pytest.mark.parametrize("most", [S.TILE, 5])
def test_groups_equal_plain_version(spark, most):
    """Also with tiles of five words, so that every cell is cut."""
    C.prepare(spark)
    rows = corpus(5, 120, 60) + [(None, "chains chain chain " * 9), (7, None), (8, "")] * 2
    got = sorted(map(tuple, S.report(documents(spark, rows), most=most).collect()))
    want = plain(rows)
    assert got == want
    assert any(r[1] for r in want)


def test_edges(spark):
    C.prepare(spark)
    got = sorted(map(tuple, S.report(documents(spark)).collect()))
    assert got == plain(ROWS)
    out = S.report(empty(spark))
    assert out.collect() == []
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint",
                                "form_n": "bigint"}


def test_long_chain_of_forms(spark):
    """Counts 3, 6, 12, ...: each word's form is the next; the root is the last."""
    C.prepare(spark)
    chain = [("a" * (5 + k), 3 * 2 ** k) for k in range(20)]
    got = {r.word: r for r in S.group(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {r.root for r in got.values()} == {chain[-1][0]}
    assert [got[w].form for w, _ in chain] == [w for w, _ in chain[1:]] + [None]


def test_query_on_the_table(spark):
    from chanlytics.llm.queries import QUERIES

    got = {r.word: r for r in QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    words = counts([(r.doc_id, r.text) for r in docs])
    assert {w: r.n for w, r in got.items()} == words
    some = sorted(words)[::max(1, len(words) // 60)]
    for w in some:
        own = sorted((x for x in words if near(w, x)), key=lambda x: (-words[x], x))
        form = own[0] if own and words[own[0]] >= 2 * words[w] else None
        assert (got[w].n_near, got[w].form) == (len(own), form)
