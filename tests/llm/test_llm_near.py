"""Near duplicates: signatures, verification, components and classes against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import near_dedup as N
from chanlytics.llm.components import components
from chanlytics.llm.words import LOWER, NOT_SPACE, Words

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(text, size=5):
    w = (text or "").translate(LOWERED).split()
    if not w:
        return Counter()
    k = min(size, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def similarity(a, b):
    """The sum over shared elements, term by term (grouped by equal weights)."""
    pairs = Counter((a[x], b[x]) for x in set(a) | set(b))
    return sum(n / sum(m * max(u / p, v / q) for (u, v), m in pairs.items()) for (p, q), n in pairs.items() if p and q)


def classes(rows, threshold=0.8):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and (rows[i][1] == rows[j][1] or bags[i].keys() & bags[j].keys()
                                        and similarity(bags[i], bags[j]) >= threshold - 1e-9):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    ids = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return sorted((str(rows[i][0]), str(ids[find(i)] if bags[i] else rows[i][0])) for i in range(len(rows)))


def noisy_family(seed=3, copies=60, words=120, noise=10):
    """Copies of one text with replaced words: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randrange(noise)):
            w[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(w)))
    return rows


def test_similarity_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a = {int(k): int(n) for k, n in zip(rng.choice(40, 20, False), rng.integers(1, 5, 20))}
        b = {int(k): int(n) for k, n in zip(rng.choice(40, 25, False), rng.integers(1, 5, 25))}
        side = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert N.probability_jaccard(*side) == pytest.approx(similarity(Counter(a), Counter(b)))


def test_signatures_estimate_the_similarity():
    rows = noisy_family(copies=12, words=300, noise=60)
    words = Words(pa.array([t for _, t in rows]), NOT_SPACE, LOWER)
    sig = N.signatures(*N.shingles(words, 5), len(rows), 1024)
    for i in range(len(rows)):
        j = (i + 1) % len(rows)
        want = similarity(bag(rows[i][1]), bag(rows[j][1]))
        assert abs((sig[i] == sig[j]).mean() - want) < 5 * (want * (1 - want) / 1024) ** 0.5 + 1e-9


@pytest.mark.parametrize("block", [2048, 7])
def test_classes(spark, block, monkeypatch):
    C.prepare(spark)
    monkeypatch.setattr(N, "BLOCK", block)
    rows = ROWS + noisy_family()
    got = N.classes(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == classes(rows)


def test_one_row_of_each_class_stays(spark):
    C.prepare(spark)
    rows = ROWS + noisy_family()
    df = documents(spark, rows)
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    blank = [r for r in rows if not (r[1] or "").split()]
    assert sorted(map(str, (r for r in kept if not (r[1] or "").split()))) == sorted(map(str, blank))
    names = Counter(c for (_, c), r in zip(classes(rows), range(len(rows))))
    full = sorted({c for i, c in classes([r for r in rows if (r[1] or "").split()])})
    assert sorted({str(i) for i, t in kept if (t or "").split()}) == full and names
    # id 6 has two texts, of two classes
    assert sum((t or "").split() != [] for _, t in kept) == len(full) + 1


def test_empty_table(spark):
    C.prepare(spark)
    assert N.classes(empty(spark)).collect() == [] and N.keep_one(empty(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    C.prepare(spark)
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    rng.shuffle(edges)
    df = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges] * 2, "u long, v long")
    got = dict((r.node, r.root) for r in components(df).collect())
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(df.where(F.lit(False))).count() == 0
