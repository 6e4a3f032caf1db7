"""Language-model scores against a dictionary-based model."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm.ngram_lm import score_texts

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED)) + ["</s>"]


def bucket(c):
    return min(1 + math.floor(2 * math.log2(c)), 47) if c else 0


def model(rows):
    """A scorer: rows of (n_tokens, n_known, base, score), from plain counts."""
    grams = [Counter(), Counter(), Counter()]
    for i, text in rows:
        if held(i):
            continue
        t = ["<s>", *tokens(text)]
        for k in range(1, len(t)):
            grams[0][t[k]] += 1
            grams[1][t[k - 1], t[k]] += 1
            if k > 1:
                grams[2][t[k - 2], t[k - 1], t[k]] += 1
    N, V = sum(grams[0].values()), len(grams[0])
    single = Counter(grams[0])
    single["<s>"] = grams[0]["</s>"]
    weights = []
    for k, context in ((1, lambda g: single[g[0]]), (2, lambda g: grams[1][g[:2]])):
        seen, once = Counter(), Counter()
        for g, c in grams[k].items():
            seen[bucket(context(g))] += c
            once[bucket(context(g))] += c == 1
        w = [1.0] * 48
        for b in range(1, 48):
            share = (once[b] + 0.5) / (seen[b] + 1.0) if seen[b] else 1.0
            w[b] = min(w[b - 1], max(share, 1e-4), 0.999)
        weights.append(w)

    def p1(w):
        return (grams[0][w] + 0.5) / (N + 0.5 * (V + 1))

    def p2(a, w):
        b = weights[0][bucket(single[a])]
        own = grams[1][a, w] / single[a] if single[a] else 0
        return (1 - b) * own + b * p1(w)

    def p3(a, b, w):
        c = grams[1][a, b]
        x = weights[1][bucket(c)]
        return (1 - x) * (grams[2][a, b, w] / c if c else 0) + x * p2(b, w)

    def score(text):
        t = ["<s>", *tokens(text)]
        total = math.log10(p2(t[0], t[1])) + sum(math.log10(p3(*t[k - 2:k + 1])) for k in range(2, len(t)))
        return len(t) - 1, sum(grams[0][w] > 0 for w in t[1:]), sum(math.log10(p1(w)) for w in t[1:]), total
    return score, N


@pytest.fixture()
def one_block(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def check(rows, got, tolerance):
    score, N = model(rows)
    want = sorted((str(i), held(i), *score(t)) for i, t in rows)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in got if r.train_tokens == N)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-6, rel=1e-9)
        if tolerance is not None:
            assert abs(a[5] - b[5]) <= tolerance * a[2] + 1e-9


def test_scores_match_plain_counts(spark, one_block):
    C.prepare(spark)
    # each token's value is rounded to 1/2048 at up to two levels
    check(ROWS, score_texts(documents(spark), C.fold_of("doc_id") == 1, block_bytes=1 << 30).collect(), 2e-3)


def test_counts_are_the_corpus_over_many_blocks(spark):
    C.prepare(spark)
    check(ROWS, score_texts(documents(spark), C.fold_of("doc_id") == 1, block_bytes=1 << 14).collect(), None)


def test_back_off_weights_are_the_corpus_over_many_blocks(spark):
    C.prepare(spark)
    df = documents(spark)
    assert df.count() > 8  # several blocks with documents
    check(ROWS, score_texts(df, C.fold_of("doc_id") == 1, block_bytes=1 << 10).collect(), 2e-3)


def test_held_out_text_is_likelier_than_by_words_alone(spark):
    C.prepare(spark)
    df = C.read_table(spark, "/root/testdata/sf0.01", "documents")
    r = score_texts(df, C.fold_of("doc_id") == 1).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_empty_table(spark):
    C.prepare(spark)
    assert score_texts(empty(spark), C.fold_of("doc_id") == 1).collect() == []
