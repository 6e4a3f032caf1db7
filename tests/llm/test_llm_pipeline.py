"""The pipeline's stages on a small table, each judged on its own input, and the registered SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from chanlytics.llm import common as C
from chanlytics.llm import pieces, queries
from test_llm_near import bag, similarity
from test_llm_passages import contamination
from test_llm_pii import base

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    C.prepare(spark)
    docs, out = C.read_table(spark, SF, "documents"), {}
    docs = docs.unionByName(docs.limit(0))
    out["input"] = docs.collect()
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
    return out


def test_order_and_columns(spark, stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "sentencepiece"]
    for name in ("quality", "near_dedup", "decontaminate", "pii"):
        assert stages[name][0].asDict().keys() == stages["input"][0].asDict().keys()


def test_quality_keeps_what_is_labelled_good(spark, stages):
    label = {r.doc_id: r.quality for r in C.read_table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in stages["quality"]}
    good = [i for i, q in label.items() if q == 1]
    bad = [i for i, q in label.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_no_near_duplicates_stay_and_no_class_goes(stages):
    before, after = stages["quality"], stages["near_dedup"]
    bags = {r.doc_id: bag(r.text) for r in before}
    left = [r.doc_id for r in after]
    for k, i in enumerate(left):
        for j in left[:k]:
            assert not (bags[i] and bags[i].keys() & bags[j].keys() and similarity(bags[i], bags[j]) >= 0.8)
    gone = set(bags) - set(left)
    linked = {i for i in gone for j in bags if j != i and bags[i].keys() & bags[j].keys() and similarity(bags[i], bags[j]) >= 0.8}
    assert linked == gone


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in C.read_table(spark, SF, "benchmark").collect()]
    want = [r.doc_id for r in stages["near_dedup"] if not contamination(r.text, items)[1]]
    assert sorted(r.doc_id for r in stages["decontaminate"]) == sorted(want)


def test_personal_data_is_masked(stages):
    before = {r.doc_id: r.text for r in stages["decontaminate"]}
    assert sorted(before) == sorted(r.doc_id for r in stages["pii"])
    for r in stages["pii"]:
        assert r.n_chars == len(r.text) and not base(r.text)
        if not base(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_tokens_are_the_texts(spark, stages):
    rows = spark.createDataFrame([(r.doc_id, r.part, r.ids) for r in stages["sentencepiece"]],
                                 "doc_id long, part int, ids array<int>")
    text = {}
    for r in sorted(pieces.decode(rows).collect(), key=lambda r: r.part):
        text[r.doc_id] = text.get(r.doc_id, "") + r.text
    assert text == {r.doc_id: r.text for r in stages["pii"]}


def test_run_is_the_stages(spark, stages):
    got = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.part, r.ids) for r in got) == sorted((r.doc_id, r.part, r.ids) for r in stages["sentencepiece"])


def test_edge_rows_pass(spark):
    from cases import documents, empty

    for df in (documents(spark), empty(spark)):
        for name, stage in P.STAGES:
            out = stage(spark, df, SF)
            n = out.count()
            if name in ("pii", "sentencepiece"):
                assert n >= df.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want.project(", ".join(columns)).fetchall()))
    assert rows and F
