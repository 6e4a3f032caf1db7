"""Positive-unlabelled classifier: held-out accuracy, risk and edge cases."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from cases import ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_features_are_of_each_text_alone():
    texts = [None, "", "a b a", "LOUD!! WORDS!!", "x | y | z", "é" * 30, "same same same same"]
    whole = Q.features(pa.array(texts, pa.string()))
    assert whole.shape == (len(texts), Q.N_FEATURES) and np.isfinite(whole).all()
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], Q.features(pa.array([t], pa.string()))[0])
    assert (whole[0] == whole[1]).all()


def test_fit_separates_positives_from_the_rest():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (3000, Q.N_FEATURES)), rng.normal(0, 1, (600, Q.N_FEATURES))
    bad[:, 0] += 6
    model = Q.fit(good[:1500], np.concatenate([good[1500:2700], bad[:300]]), 0.8)
    assert (model.score(good[2700:]) >= 0.3).mean() > 0.98 and (model.score(bad[300:]) < 0.3).mean() > 0.9


def test_fit_without_positives_gives_the_prior():
    model = Q.fit(np.zeros((0, Q.N_FEATURES)), np.ones((5, Q.N_FEATURES)), 0.7)
    assert np.allclose(model.score(np.random.default_rng(0).normal(size=(4, Q.N_FEATURES))), 0.7)


def test_held_out_accuracy(spark):
    C.prepare(spark)
    got = Q.scored(C.read_table(spark, SF, "documents"), C.read_table(spark, SF, "labels")).toPandas()
    held = got[got.held_out].merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert len(got) == 1000 and (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_sample_of_a_millionth(spark):
    """The bound holds however large the table is: 2 of 3,000,000 rows, and a fit on so few."""
    rows = spark.range(3_000_000).select(F.xxhash64("id").alias("key"))
    for most in (2, 100):
        assert Q._sample(rows, most).count() == most
    assert Q._sample(rows.limit(5), 100).count() == 5 and Q._sample(rows.limit(0), 100).count() == 0
    some = np.random.default_rng(1).normal(size=(4, Q.N_FEATURES))
    assert np.isfinite(Q.fit(some[:2], some[2:], 0.5, steps=20).score(some)).all()


def _plain_risk(weights, zp, zu, prior):
    """The non-negative risk of the sigmoid loss, row by row."""
    def loss(z, y):
        out = 0.0
        for row in z:
            hidden = np.tanh(np.array([sum(row[i] * weights[0][i, j] for i in range(len(row))) + weights[1][j]
                                       for j in range(len(weights[1]))]))
            out += 1 / (1 + np.exp(y * (float(hidden @ weights[2]) + weights[3][0])))
        return out / len(z)
    return prior * loss(zp, 1) + max(0.0, loss(zu, -1) - prior * loss(zp, -1))


def test_fit_lowers_the_plain_risk():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(0, 1, (60, Q.N_FEATURES)), rng.normal(0, 1, (30, Q.N_FEATURES)) + 2
    unlabelled = np.concatenate([good[30:], bad])
    risks = []
    for steps in (1, 50, 400):
        model = Q.fit(good[:30], unlabelled, 0.5, steps=steps)
        risks.append(_plain_risk(model.weights, model.inputs(good[:30]), model.inputs(unlabelled), 0.5))
    assert risks[0] > risks[1] > risks[2] and risks[2] < 0.1


def test_edge_rows(spark):
    C.prepare(spark)
    labels = spark.createDataFrame([(6, 1), (7, 1), (7, 0), (None, 1), (9, None), (12, 0)], "doc_id long, quality int")
    got = Q.scored(documents(spark), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    model = Q.train(documents(spark), labels, F.lit(True))
    kept = Q.keep_good(documents(spark), model, 0.0)
    assert kept.columns == documents(spark).columns and kept.count() == len(ROWS)
    assert Q.scored(empty(spark), labels).collect() == []
    assert Q.scored(documents(spark), labels.where(F.lit(False))).count() == len(ROWS)
