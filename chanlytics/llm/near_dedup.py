"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Shingles are five consecutive words, weighted by how often they occur in
the document; similarity is the probability Jaccard similarity
  J(a, b) = sum_i 1 / sum_j max(a_j / a_i, b_j / b_i),
which is plain Jaccard for documents that repeat no shingle.

Signature: every element draws a Poisson process of arrivals with its
weight as rate, each arrival at a random slot; a slot keeps the element
that arrives first.  An element stops as soon as its next arrival comes
after the latest first arrival of all slots (early termination).  Two
signatures agree in a slot with probability J.

Bands of `rows` slots give candidates; with 32 bands of 5 rows a pair at
0.8 meets with probability 1 - 3e-6.  Equal texts are one node from the
start.  In each bucket every node is paired with one leader, picked by a
hash of node and band, so a node meets other leaders in other bands; pairs
whose signatures agree so little that 0.8 is 4 standard deviations away are
passed over, the others verified.  Then only buckets whose nodes are of
several classes are left.  The nodes that such buckets connect are a family;
those outside the family's largest class meet all others of it once, block
by block, and their exact similarities are computed inside the task, until
their classes are joined.  Only links leave the task: pairs inside a class
are never compared, and no list of pairs is made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlytics.llm.components import components
from chanlytics.llm.words import LOWER, NOT_SPACE, Words, mix, run_hash, slices

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, weight) of the distinct shingles; a text of fewer words is one shingle."""
    at, doc = words.windows(size)
    hashes = run_hash(words.hash, at, size)
    for k in range(1, size):
        short = np.flatnonzero(words.count == k)
        doc = np.concatenate([doc, short])
        hashes = np.concatenate([hashes, run_hash(words.hash, words.word_at[short], k)])
    key = mix(hashes + doc.astype(np.uint64) * _GOLDEN)
    _, first, weight = np.unique(key, return_index=True, return_counts=True)
    return doc[first], hashes[first], weight


def signatures(doc: np.ndarray, hashes: np.ndarray, weight: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """[docs, slots]: the element that arrives first at each slot; zeros for documents without any."""
    first = np.full(docs * slots, np.inf)
    owner = np.zeros(docs * slots, np.uint64)
    latest = np.full(docs, np.inf)
    time = np.zeros(len(doc))
    turn = 0
    while len(doc):
        turn += 1
        draw = mix(hashes + np.uint64(turn * int(_GOLDEN) & (1 << 64) - 1))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        go = time < latest[doc]
        doc, hashes, weight, time, draw = doc[go], hashes[go], weight[go], time[go], draw[go]
        at = doc * slots + (mix(draw) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        owner[at[won]] = hashes[won]
        live = np.flatnonzero(np.bincount(doc, minlength=docs))
        latest[live] = first.reshape(docs, slots)[live].max(axis=1)
    return owner.reshape(docs, slots)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact, from (sorted distinct hashes, weights) of two documents."""
    keys, place = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    wa = np.bincount(place[:len(a[0])], a[1], len(keys))
    wb = np.bincount(place[len(a[0]):], b[1], len(keys))
    with np.errstate(divide="ignore"):
        ratio = wb / wa
    order = np.argsort(ratio, kind="stable")
    ratio, wa, wb = ratio[order], wa[order], wb[order]
    below = np.concatenate([[0], np.cumsum(wa)])
    above = wb.sum() - np.concatenate([[0], np.cumsum(wb)])
    both = np.flatnonzero((wa > 0) & (wb > 0))
    upto = np.searchsorted(ratio, ratio[both], "right")
    return float(np.sum(1.0 / (below[upto] / wa[both] + above[upto] / wb[both])))


def _sign(size: int, slots: int):
    def sign(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                words = Words(part.column("text"), NOT_SPACE, LOWER)
                n = len(words.count)
                sig = signatures(*shingles(words, size), n, slots)
                short = (sig & np.uint64(0xFFFF)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("doc_id"), pa.array(words.count.astype(np.int64)),
                     pa.array([x.tobytes() for x in short], pa.binary())], ["node", "doc_id", "n_words", "sig"])
    return sign


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row."""
    return (a == b).mean(axis=-1)


def _plausible(slots: int, least: float):
    """Pairs whose signatures do not rule them out."""
    def plausible(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, slots) for c in ("su", "sv"))
            yield batch.select(["u", "v"]).filter(pa.array(_agree(a, b) >= least, pa.bool_()))
    return plausible


def _sets(column, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, weights, cuts) of a column's documents, by document and hash; every document has shingles."""
    words = Words(column, NOT_SPACE, LOWER)
    doc, hashes, weight = shingles(words, size)
    order = np.lexsort((hashes, doc))
    return hashes[order], weight[order], np.searchsorted(doc[order], np.arange(len(words.count) + 1))


def _crossing(size: int, threshold: float):
    """Links between a block of nodes outside the family's largest class and a block of the family."""
    def crossing(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"u": [], "v": []}
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("node"), right.sort_by("node")
            ha, wa, ca = _sets(left.column("text"), size)
            hb, wb, cb = _sets(right.column("text"), size)
            ids = np.unique(np.concatenate([ha, hb]), return_inverse=True)[1]
            ia, ib = ids[:len(ha)], ids[len(ha):]
            total = np.add.reduceat(wb, cb[:-1])
            plain = np.maximum.reduceat(wb, cb[:-1]) == 1
            count = np.diff(cb)
            share = wb / np.repeat(total, count)
            up: dict[int, int] = {}

            def find(r: int) -> int:
                while up.get(r, r) != r:
                    r = up[r]
                return r

            roots = right.column("root").to_pylist()
            for x, (node, root) in enumerate(zip(left.column("node").to_pylist(), left.column("root").to_pylist())):
                own = slice(ca[x], ca[x + 1])
                flag = np.zeros(ids.max() + 1)
                flag[ia[own]] = wa[own] / wa[own].sum()
                # the sum of the smaller shares bounds the similarity from above
                bound = np.add.reduceat(np.minimum(flag[ib], share), cb[:-1])
                near = bound >= threshold - 1e-9
                if wa[own].max() == 1:  # of sets, the similarity itself
                    both = np.add.reduceat(flag[ib] > 0, cb[:-1])
                    n = ca[x + 1] - ca[x]
                    near &= ~plain | (both / (n + count - both) >= threshold - 1e-9)
                for y in np.flatnonzero(near).tolist():
                    a, b = find(root), find(roots[y])
                    if a != b and (plain[y] and wa[own].max() == 1 or probability_jaccard(
                            (ha[own], wa[own]), (hb[cb[y]:cb[y + 1]], wb[cb[y]:cb[y + 1]])) >= threshold - 1e-9):
                        up[max(a, b)] = min(a, b)
                        out["u"].append(node)
                        out["v"].append(right.column("node")[y].as_py())
        return pa.table({c: pa.array(v, pa.binary()) for c, v in out.items()})
    return crossing


def _verify(size: int, threshold: float):
    def verify(batches):
        for batch in batches:
            for part in slices(batch, "ta", 1 << 20):
                (ha, wa, ca), (hb, wb, cb) = (_sets(part.column(c), size) for c in ("ta", "tb"))
                good = [probability_jaccard((ha[ca[i]:ca[i + 1]], wa[ca[i]:ca[i + 1]]),
                                            (hb[cb[i]:cb[i + 1]], wb[cb[i]:cb[i + 1]])) >= threshold - 1e-9
                        for i in range(part.num_rows)]
                yield part.select(["u", "v"]).filter(pa.array(good, pa.bool_()))
    return verify


def _texts(rows_in: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of the given nodes, once each."""
    return rows_in.select("node", "text").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, rows_in: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (u, v) of nodes that reach the threshold, exactly."""
    involved = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    texts = _texts(rows_in, involved).checkpoint()
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("tb"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "ta", "tb").mapInArrow(
        _verify(size, threshold), "u binary, v binary").checkpoint()


BLOCK, BLOCK_BYTES = 1024, 4 << 20  # nodes of a family, and bytes of their texts, that are compared at once


def _labelled(df: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 5,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, doc_id, n_words, root for each row of df; root: the least node that verified links connect."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows_in = df.select(F.unhex(F.md5(text)).alias("node"), F.col(id_col).cast("long").alias("doc_id"),
                        text.alias("text"))
    slots = bands * rows
    least = threshold - 4 * (threshold * (1 - threshold) / slots) ** 0.5
    signed = rows_in.mapInArrow(
        _sign(size, slots), "node binary, doc_id long, n_words long, sig binary").checkpoint()
    nodes = signed.where("n_words > 0").groupBy("node").agg(F.min("sig").alias("sig")).checkpoint()
    # a band's key: its slots, two bytes each
    key = lambda b: F.xxhash64(b, F.substring("sig", b * (2 * rows) + 1, F.lit(2 * rows)))
    entries = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)).alias("band"))
    lead = F.min(F.struct(F.xxhash64("node", "band").alias("h"), F.col("node").alias("node")))
    shared = (entries.groupBy("band").agg(lead["node"].alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    near = entries.join(shared, "band").checkpoint()  # nodes that share a bucket; equal texts are one node

    signs = nodes.select("node", "sig")
    stars = (near.where("node <> leader").select(F.least("leader", "node").alias("u"), F.greatest("leader", "node").alias("v"))
             .distinct())
    both = stars.join(signs.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u").join(
        signs.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v")
    tried = both.mapInArrow(_plausible(slots, least), "u binary, v binary").checkpoint()
    links = _verified(tried, rows_in, size, threshold)
    first = components(links)

    # buckets whose nodes are of several classes, and the families they connect
    labelled = near.join(first, "node", "left").select(
        "band", "node", "leader", F.xxhash64(F.coalesce("root", "node")).alias("root"))
    mixed = (labelled.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo < hi").select("band"))
    open_ = labelled.join(mixed, "band").select("node", "leader", "root").distinct().checkpoint()
    family = components(open_.select(F.col("node").alias("u"), F.col("leader").alias("v")))
    members = (family.withColumnRenamed("root", "family").join(open_.select("node", "root").distinct(), "node")
               .join(_texts(rows_in, open_.select("node").distinct()), "node").checkpoint())
    of_class = members.groupBy("family", "root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("size"))
    whole_family = of_class.groupBy("family").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), F.sum("n").alias("n"), F.sum("size").alias("size"),
        (F.sum("n") - F.max("n")).alias("n_left"), F.count(F.lit(1)).alias("classes")).where("classes > 1")

    def blocks(n: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col("size") / BLOCK_BYTES)).cast("int")

    placed = members.join(whole_family, "family").select(
        "family", "node", "root", "text", (F.col("root") != F.col("largest")).alias("outside"),
        blocks("n_left").alias("rows"), blocks("n").alias("cols"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    left = placed.where("outside").select("family", own("rows").alias("i"), F.explode(
        F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"), "node", "root", "text")
    # new names for the same columns, so that the two sides can be told apart
    right = placed.select(F.col("family").alias("family"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
                          own("cols").alias("j"), *(F.col(c).alias(c) for c in ("node", "root", "text")))
    keys = ("family", "i", "j")
    more = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(_crossing(size, threshold), "u binary, v binary").checkpoint())
    whole = components(links.union(more)) if more.limit(1).count() else first

    return signed.join(whole, "node", "left").select(
        "node", "doc_id", "n_words", F.coalesce("root", "node").alias("root"))


def classes(df: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 5,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, doc_id, n_words, class_id: one row for each row of df.

    node: MD5 of the text; class_id: least doc_id among the documents that
    verified links connect.  Words are lower-cased (A-Z) runs without ASCII
    white space.  Null, empty and blank texts belong to no group: each is a
    class of its own, by its id.  Rows with equal texts share a class.  A
    null id never names a class of other documents (class_id is null if all
    ids of a class are).  Other columns are ignored.
    """
    named = _labelled(df, size, threshold, bands, rows, id_col, text_col)
    least = named.where("n_words > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least, "root", "left").select(
        "node", "doc_id", "n_words",
        F.when(F.col("n_words") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("class_id"))


def keep_one(df: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 5,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, with all their columns, less all but one of each class: the least id's stays.

    Rows without words all stay.  Where rows of a class share the least id,
    the least text digest, and of equal rows one, stays; null ids come last.
    """
    named = _labelled(df, size, threshold, bands, rows, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node"))
    kept = named.where("n_words > 0").groupBy("root").agg(first.alias("k")).select("k.doc_id", "k.node")
    plain = named.where("n_words = 0").select("doc_id", "node").distinct()
    stay = kept.select("doc_id", "node", F.lit(True).alias("one")).unionByName(plain.withColumn("one", F.lit(False)))
    stay = stay.select(F.xxhash64("doc_id", "node").alias("__key"), "one")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = df.withColumn("__key", F.xxhash64(F.col(id_col).cast("long"), F.unhex(F.md5(text)))).join(stay, "__key")
    turn = F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1)))
    single = keyed.where("one").withColumn("__turn", turn).where(F.col("__turn") <= 1)
    return single.select(*df.columns).unionByName(keyed.where("not one").select(*df.columns))
