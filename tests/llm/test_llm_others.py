"""License notices, shard placement, nearest neighbours."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import BASE, ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import licenses, sharding, vamana

NOTICES = [(500, "Some text.\nLicensed under the Apache License, Version 2.0.\nMore"), (501, "all RIGHTS reserved"),
           (502, "This work is licensed under the GNU General Public License, version 3. All rights reserved."),
           (503, "This work is licensed to you under the GNU General Public License, version 3"), (504, "Released under it"),
           (505, BASE * 30 + " Licensed under CC BY-NC 4.0. " + BASE * 30), (506, "released under the mit license"),
           (507, "Licensed under the Apache License"), (508, "rights reserved all")]


def words(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def notices(text):
    w = words(text)
    s = list(zip(w, w[1:]))
    out = []
    for name, template in licenses.TEMPLATES:
        t = words(template)
        own = set(zip(t, t[1:]))
        k, step = len(own), max(1, len(own) // 2)
        best = max((len(own & set(s[a:a + k + step - 1])) / k for a in range(0, len(s), step)), default=0)
        if best >= licenses.CONTAINMENT:
            out.append((name, best))
    return sorted(out)


def test_license_notices(spark):
    C.prepare(spark)
    rows = ROWS + NOTICES
    df = documents(spark, rows)
    got = licenses.scan(df)
    assert got.columns == [*df.columns, "licenses"]
    got = sorted((str(r.doc_id), [(x.license, x.containment) for x in r.licenses]) for r in got.collect())
    assert got == sorted((str(i), notices(t)) for i, t in rows)
    assert sum(bool(x) for _, x in got) == 6
    assert licenses.scan(empty(spark)).collect() == []
    assert {len(r.licenses) for r in licenses.scan(df, templates=(("one", "word"),)).collect()} == {0}


def test_license_scan_is_native(spark):
    C.prepare(spark)
    plan = licenses.report(documents(spark, clash=False))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_table_is_even_and_stable():
    names = tuple(f"s{i}" for i in range(13))
    full = sharding.fill(names, 1009)
    count = Counter(full)
    assert set(count) == set(range(13)) and max(count.values()) - min(count.values()) <= 1
    less = sharding.fill(names[:5] + names[6:], 1009)
    moved = sum(names[a] != (names[:5] + names[6:])[b] for a, b in zip(full, less))
    assert moved < 2.5 * 1009 / 13
    assert sharding.fill(("a",), 2) == [0, 0]
    for bad in ((), ("a", "a")):
        with pytest.raises(ValueError):
            sharding.fill(bad, 11)
    with pytest.raises(ValueError):
        sharding.fill(names, 1000)


def test_placement(spark, tmp_path):
    C.prepare(spark)
    df = documents(spark).drop("shard", "slot", "part")
    got = sharding.assign(df, F.col("doc_id"), ("a", "b", "c"), 101).collect()
    table = sharding.fill(("a", "b", "c"), 101)
    assert len(got) == len(ROWS)
    for r in got:
        slot = sharding._number("" if r.doc_id is None else str(r.doc_id)) % 101
        assert (r.slot, r.shard) == (slot, "abc"[table[slot]])
    assert sharding.assign(empty(spark), F.col("doc_id")).collect() == []
    assert sharding.assign(documents(spark), F.col("text")).count() == len(ROWS)
    sharding.write_shards(df, F.col("doc_id"), str(tmp_path / "out"), ("a", "b", "c"), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, shard string")


def brute(rows, asked, k):
    out = []
    for q, v in asked:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, r, i) for r, (_, i) in enumerate(best, 1)]
    return sorted(out)


def test_small_tables_are_exact(spark):
    C.prepare(spark)
    rng = np.random.default_rng(2)
    fine = [(i, rng.normal(size=4).tolist()) for i in range(90)]
    fine += [(i, fine[3][1]) for i in range(200, 260)]  # equal vectors, more than a result holds
    odd = [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 0.0, 0.0]), (304, [float("nan"), 1.0, 1.0, 1.0]),
           (305, [float("inf"), 0.0, 0.0, 0.0]), (306, [1.0, 2.0]), (None, [1.0] * 4)]
    df = vectors(spark, fine + odd + fine[:5])
    rows = vamana.usable(df)
    got = vamana.nearest(rows, rows.where("vec_id % 5 = 0"), 20, shard_rows=64).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == brute(fine, [x for x in fine if x[0] % 5 == 0], 20)
    by = dict(fine)
    for r in got:
        assert r.score == pytest.approx(sum(a * b for a, b in zip(by[r.query_id], by[r.vec_id])), abs=1e-12)
    few = vamana.usable(vectors(spark, [(0, [1.0, 0.0]), (20, [0.5, 0.5])]))
    assert sorted((r.query_id, r.rank, r.vec_id) for r in vamana.nearest(few, few).collect()) == [(0, 1, 20), (20, 1, 0)]
    none = vamana.usable(vectors(spark, odd[:5]))
    assert vamana.nearest(none, none).collect() == []


def test_each_query_is_searched_among_vectors_of_its_length(spark):
    C.prepare(spark)
    rng = np.random.default_rng(4)
    long, short = ([(i, rng.normal(size=d).tolist()) for i in ids] for d, ids in ((4, range(60)), (2, range(60, 90))))
    rows = vamana.usable(vectors(spark, long + short))
    got = vamana.nearest(rows, rows.where("vec_id % 5 = 0"), 5, shard_rows=32).collect()
    want = sorted(x for part in (long, short) for x in brute(part, [v for v in part if v[0] % 5 == 0], 5))
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == want


def test_recall(spark):
    C.prepare(spark)
    df = C.read_table(spark, "/root/testdata/sf0.1", "embeddings")
    got = vamana.search_table(df).collect()
    table = df.select("vec_id", "embedding").toPandas()
    x = np.stack(table.embedding.values).astype(float)
    hits = total = 0
    for q in table.vec_id[table.vec_id % 20 == 0]:
        s = x @ x[np.flatnonzero(table.vec_id == q)[0]]
        s[np.flatnonzero(table.vec_id == q)] = -np.inf
        best = set(table.vec_id.values[np.argsort(-s)[:20]])
        mine = {r.vec_id for r in got if r.query_id == q}
        assert len(mine) == 20
        hits, total = hits + len(best & mine), total + 20
    assert hits / total >= 0.9


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [1.2, 0.1], [0, 2], [0, 2.1]], np.float32)
    kept = vamana.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, 5, -1, 0]]), 4, 1.2)
    assert kept[0].tolist() == [1, 4, -1, -1]
