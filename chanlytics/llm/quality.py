"""Quality scores by positive-unlabelled learning.

Trusted positives are rows labelled 1; the web text of the training fold,
labels unseen, is the unlabelled sample.  A small network is fitted by
minimising the non-negative unbiased risk
  R = pi * E_P[l(f, +1)] + max(0, E_U[l(f, -1)] - pi * E_P[l(f, -1)])
with the sigmoid loss l(f, y) = 1 / (1 + exp(y f)); where the second term
falls below zero the step goes up its gradient instead.  pi, the share of positives, is estimated from the
labelled rows of the training fold.

Only the fit is bounded: at most about `positives` and `unlabelled` rows
(parameters), picked by a hash, bring their feature vectors to the driver.
Every text is scored whole.  Features describe the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlytics.llm import common as C
from chanlytics.llm.words import NOT_SPACE, LOWER, Words, mix, slices

POSITIVES, UNLABELLED = 20_000, 40_000

_CLASSES = {
    "upper": list(range(0x41, 0x5B)), "lower": list(range(0x61, 0x7B)), "digit": list(range(0x30, 0x3A)),
    "blank": [0x20, 0x09, 0x0D], "line": [0x0A], "bar": [ord("|")], "bang": [ord("!"), ord("?")],
    "sign": [ord(c) for c in "#$%&*@^~+=<>\\_`/"], "stop": [ord(c) for c in ".,;:"],
    "quote": [ord(c) for c in "\"'()[]{}-"], "high": list(range(0x80, 0x100)),
}
_CLASS_OF = np.zeros(256, np.int64)
for _i, _bytes in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[_bytes] = _i
N_FEATURES = len(_CLASSES) + 10


def features(column) -> np.ndarray:
    """[documents, N_FEATURES]: shares of byte classes, and how far words, word pairs and lengths repeat."""
    words = Words(column, NOT_SPACE, LOWER)
    docs = len(words.count)
    size = np.diff(words.offsets)
    doc_of_byte = np.repeat(np.arange(docs), size)
    kinds = len(_CLASSES) + 1
    table = np.bincount(doc_of_byte * kinds + _CLASS_OF[words.raw], minlength=docs * kinds).reshape(docs, kinds)
    shares = table[:, 1:] / np.maximum(size, 1)[:, None]

    n = words.count
    some = np.maximum(n, 1)
    doc = words.doc_of_word()
    length = words.end - words.start

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc[:len(flags)], flags, docs) / some

    def kinds_and_top(key: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joint, count = np.unique(mix(key + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_counts=True)
        order = np.argsort(mix(key + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
        owner = of[order][np.concatenate([[0], np.cumsum(count)[:-1]])] if len(count) else of
        top = np.zeros(docs)
        np.maximum.at(top, owner, count)
        return np.bincount(owner, minlength=docs), top

    distinct, top = kinds_and_top(words.hash, doc)
    inside = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    same_next = np.zeros(len(doc))
    same_next[inside] = words.hash[inside] == words.hash[inside + 1]
    pairs, top_pair = kinds_and_top(mix(words.hash[inside] * np.uint64(3) + words.hash[inside + 1]), doc[inside])
    last = words.raw[words.end - 1] if len(doc) else np.zeros(0, np.uint8)
    first = words.raw[words.start] if len(doc) else np.zeros(0, np.uint8)
    mean = np.bincount(doc, length, docs) / some
    extra = np.stack([
        np.log1p(n) / 10, mean / 10, np.sqrt(np.bincount(doc, length.astype(float) ** 2, docs) / some) / 10,
        distinct / some, top / some, share(same_next), pairs / some, top_pair / some,
        share(np.isin(_CLASS_OF[last], (6, 7, 8))),
        share((_CLASS_OF[first] == 1) & (_CLASS_OF[last] == 1))], axis=1)
    return np.concatenate([shares, extra], axis=1)


class Model:
    """Standardised features, one hidden layer, one logit."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logit(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        hidden = np.tanh(z @ a + b)
        return hidden @ c + d[0], hidden

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logit(self.inputs(x))[0], -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 1500,
        batch: int = 4096, rate: float = 0.01, seed: int = 7) -> Model:
    """Minimises the non-negative risk by Adam; without any positives the model is the prior."""
    rng = np.random.default_rng(seed)
    pool = unlabelled if len(unlabelled) else np.zeros((1, N_FEATURES))
    weights = [rng.normal(0, 0.3, (N_FEATURES, hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden),
               np.zeros(1)]
    model = Model(pool.mean(axis=0), pool.std(axis=0) + 1e-3, weights)
    if not len(positive) or not len(unlabelled):
        weights[2][:], weights[3][:] = 0, np.log(prior / (1 - prior))
        return model
    zp, zu = model.inputs(positive), model.inputs(unlabelled)
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def sigmoid(f):
        return 1.0 / (1.0 + np.exp(-np.clip(f, -30, 30)))

    def some(z):
        return z if len(z) <= batch else z[rng.integers(0, len(z), batch)]

    for step in range(1, steps + 1):
        p, u = some(zp), some(zu)
        fp, hp = model.logit(p)
        fu, hu = model.logit(u)
        sp, su = sigmoid(fp), sigmoid(fu)
        if su.mean() - prior * sp.mean() >= 0:
            gp, gu = -2 * prior * sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        else:
            gp, gu = prior * sp * (1 - sp) / len(p), -su * (1 - su) / len(u)
        grads = [np.zeros_like(w) for w in weights]
        for z, h, g in ((p, hp, gp), (u, hu, gu)):
            inner = g[:, None] * weights[2] * (1 - h * h)
            for total, part in zip(grads, (z.T @ inner, inner.sum(0), h.T @ g, np.array([g.sum()]))):
                total += part
        now = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g + 1e-4 * w
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def _vectors(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            x = features(part.column("text"))
            flat = pa.array(x.ravel())
            off = np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("trusted"),
                                              pa.ListArray.from_arrays(off, flat)], ["key", "trusted", "x"])


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """`most` rows of a table with a hash column `key`, those of the least second hash, or all if there are fewer.

    A threshold on the 64-bit hash, with room to spare, leaves few more than
    `most` rows at any size of the table; only these are ordered.
    """
    total = rows.count()
    wanted = 2 * most + 64
    order = F.xxhash64("key", F.lit("sample"))
    if wanted < total:
        rows = rows.where(order < F.lit(wanted * (1 << 64) // total - (1 << 63)))
    return rows.orderBy(order, "key").limit(most)


def train(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fits on rows of docs where `training` (a Column over docs) holds.

    Ids labelled more than once count as their least label; null ids and
    null labels are not trusted.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.where(F.coalesce(training, F.lit(False))).select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    marks = (labels.select(F.col(label_id).alias("id"), F.col(label_col).alias("label")).dropna()
             .groupBy("id").agg(F.min("label").alias("label")))
    marked = own.select("id", "key").join(marks, "id")
    counts = marked.agg(F.count(F.lit(1)), F.sum(F.col("label").cast("long"))).first()
    prior = (counts[1] + 0.5) / (counts[0] + 1) if counts[0] else 0.5
    trusted = _sample(marked.where("label = 1").select("key"), positives).distinct()
    plain = _sample(own.select("key"), unlabelled).distinct()
    # at most the two bounds of keys, so they are sent to every scan task
    chosen = (trusted.withColumn("trusted", F.lit(True)).unionByName(plain.withColumn("trusted", F.lit(False)))
              .withColumnRenamed("key", "chosen"))
    rows = (own.select("key", "text").join(F.broadcast(chosen), F.col("key") == F.col("chosen"))
            .select("key", "trusted", "text").mapInArrow(_vectors, "key long, trusted boolean, x array<double>"))
    got = sorted(rows.collect(), key=lambda r: (r[1], r[0]))
    side = {k: np.array([r[2] for r in got if r[1] is k]).reshape(-1, N_FEATURES) for k in (True, False)}
    return fit(side[True], side[False], float(np.clip(prior, 0.02, 0.98)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *extra: Column) -> DataFrame:
    """doc_id, score and the extra columns for each row of docs.

    Null texts count as empty ones, which are scored like any text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                value = shared.value.score(features(part.column("text")))
                rest = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(value)], [*rest.schema.names, "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *extra)
    schema = rows.drop("text").schema.add("score", "double")
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text scores `threshold` or more; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                good = shared.value.score(features(part.column(text_col))) >= threshold
                yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: learnt where crc32(id) mod 5 is not 0."""
    model = train(docs, labels, C.fold_of("doc_id") != 0)
    out = score(docs, model, "doc_id", "text", (C.fold_of("doc_id") == 0).alias("held_out"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
