"""Nearest neighbours by inner product: robust-pruned directed graphs, one a shard.

Vectors are dealt into shards of bounded size.  A shard's graph starts from
random edges; its points are then inserted again in batches: a greedy beam
search on the graph so far proposes neighbours, and relaxed pruning keeps
the nearest candidate and drops those that are closer, by a factor alpha,
to a kept one than to the point, again and again, so edges stay diverse.
Reverse edges are added and pruned alike.  Largest inner product becomes
smallest distance by one more coordinate, sqrt(M^2 - |x|^2).

Every block of queries searches every shard by beam search; candidates are
scored exactly, in double precision, on the original vectors.  Equal
vectors are one point, so a vector that a third of the rows share cannot
fill the beams; its smallest ids stand in the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_BLOCK = 2048
DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA, EXPAND = 32, 64, 160, 1.2, 4


def _distances(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of q[i] to x[ids[i, :]]."""
    near = x[ids]
    return (np.einsum("ij,ij->i", q, q)[:, None] - 2 * np.einsum("ikj,ij->ik", near, q, optimize=True)
            + np.einsum("ij,ij->i", x, x)[ids])


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of each query's beam, nearest first; -1 and inf where it is not full."""
    n, Q = len(x), len(q)
    beam = min(beam, n)
    norm = np.einsum("ij,ij->i", x, x)
    own = np.einsum("ij,ij->i", q, q)
    ids = np.full((Q, beam), -1, np.int64)
    dist = np.full((Q, beam), np.inf, np.float32)
    done = np.ones((Q, beam), bool)
    seen = np.zeros((Q, n), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    ids[:, 0] = entry
    dist[:, 0] = own - 2 * (q @ x[entry]) + norm[entry]
    live = np.arange(Q)
    while live.size:
        open_ = np.where(done[live], np.inf, dist[live])
        pick = np.argpartition(open_, min(EXPAND, beam - 1), axis=1)[:, :EXPAND]
        rows = live[:, None]
        valid = ~done[rows, pick]
        done[rows, pick] = True
        near = np.where(valid[:, :, None], graph[np.maximum(ids[rows, pick], 0)], -1).reshape(len(live), -1)
        fresh = near >= 0
        near = np.maximum(near, 0)
        fresh &= ~seen[rows, near]
        # one place for each new id of a query
        order = np.argsort(np.where(fresh, near, n), axis=1, kind="stable")
        near, fresh = np.take_along_axis(near, order, 1), np.take_along_axis(fresh, order, 1)
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        new = near[r, c]
        seen[live[r], new] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[r, c] = own[live[r]] - 2 * np.einsum("ij,ij->i", x[new], q[live[r]]) + norm[new]
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_d = np.concatenate([dist[live], d], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        dist[live] = np.take_along_axis(all_d, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1) | np.isinf(dist[live])
        live = live[~done[live].all(axis=1)]
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    return np.where(np.isinf(dist), -1, ids), dist


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """[points, degree] kept neighbours (-1: none) out of [points, candidates]; -1 and the point itself are ignored."""
    safe = np.maximum(candidates, 0)
    vectors = x[safe]
    dist = np.maximum(_distances(x, x[points], safe), 0)
    alive = (candidates >= 0) & (candidates != points[:, None])
    kept = np.full((len(points), degree), -1, np.int32)
    rows = np.arange(len(points))
    norm = np.einsum("ikj,ikj->ik", vectors, vectors)
    for r in range(degree):
        d = np.where(alive, dist, np.inf)
        at = d.argmin(axis=1)
        some = np.isfinite(d[rows, at])
        if not some.any():
            break
        kept[some, r] = candidates[rows[some], at[some]]
        star = vectors[rows, at]
        between = np.maximum(norm + norm[rows, at][:, None] - 2 * np.einsum("ikj,ij->ik", vectors, star, optimize=True), 0)
        # squared distances, so alpha counts twice; equal ids have distance 0 and go with the kept one
        alive &= alpha * alpha * between > dist
        alive[rows, at] = False
    return kept


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
          batch: int = 512, seed: int = 5) -> tuple[np.ndarray, np.ndarray, int]:
    """(points with the added coordinate, graph, entry) of a shard."""
    rng = np.random.default_rng(seed)
    norm = np.einsum("ij,ij->i", vectors, vectors)
    x = np.concatenate([vectors, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1).astype(np.float32)
    n = len(x)
    entry = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    degree = min(degree, max(1, n - 1))
    graph = rng.integers(0, n, (n, degree)).astype(np.int32)
    graph[graph == np.arange(n)[:, None]] = -1
    order = rng.permutation(n)
    for i in range(0, n, batch):
        points = order[i:i + batch]
        found, _ = beam_search(x, graph, entry, x[points], beam)
        graph[points] = robust_prune(x, points, np.concatenate([found, graph[points]], axis=1), degree, alpha)
        # reverse edges, for each target its nearest new sources
        source = np.repeat(points, degree)
        target = graph[points].ravel()
        source, target = source[target >= 0], target[target >= 0]
        gap = ((x[source] - x[target]) ** 2).sum(axis=1)
        by = np.lexsort((gap, target))
        source, target = source[by], target[by]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        turn = np.arange(len(target)) - np.repeat(first, count)
        close = turn < degree
        extra = np.full((len(heads), degree), -1, np.int64)
        extra[np.repeat(np.arange(len(heads)), count)[close], turn[close]] = source[close]
        for j in range(0, len(heads), 2048):
            part = heads[j:j + 2048]
            graph[part] = robust_prune(x, part, np.concatenate([graph[part], extra[j:j + 2048]], axis=1), degree, alpha)
    return x, graph, entry


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in order."""
    return np.add.accumulate(a.astype(np.float64) * b.astype(np.float64), axis=1)[:, -1]


_INDEX = "dim int, shard int, reps binary, vectors binary, graph binary, entry long"


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("rep")
    vectors = np.array(table.column("embedding").to_pylist(), np.float64)
    _, graph, entry = build(vectors)
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                     "reps": pa.array([np.asarray(table.column("rep"), dtype=np.int64).tobytes()], pa.binary()),
                     "vectors": pa.array([vectors.tobytes()], pa.binary()),
                     "graph": pa.array([graph.tobytes()], pa.binary()), "entry": pa.array([entry], pa.int64())})


def _search(k: int, beam: int):
    def search(key: tuple[pa.Scalar, ...], index: pa.Table, queries: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        empty = pa.table({"dim": pa.array([], pa.int32()), "query_id": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not index.num_rows or not queries.num_rows:
            return empty
        row = {c: index.column(c)[0].as_py() for c in ("reps", "vectors", "graph", "entry")}
        reps = np.frombuffer(row["reps"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
        graph = np.frombuffer(row["graph"], np.int32).reshape(len(reps), -1)
        norm = np.einsum("ij,ij->i", vectors, vectors)
        x = np.concatenate([vectors, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1).astype(np.float32)
        names = np.asarray(queries.column("vec_id"), dtype=np.int64)
        q = np.array(queries.column("embedding").to_pylist(), np.float64)
        out = []
        for i in range(0, len(q), 512):
            part = q[i:i + 512]
            ids, _ = beam_search(x, graph, row["entry"], np.concatenate(
                [part, np.zeros((len(part), 1))], axis=1).astype(np.float32), beam)
            r, c = np.nonzero(ids >= 0)
            score = np.full(ids.shape, -np.inf)
            score[r, c] = exact_scores(part[r], vectors[ids[r, c]])
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            r, c = np.nonzero(np.isfinite(np.take_along_axis(score, best, 1)))
            at = best[r, c]
            out.append(pa.table({"dim": pa.array([dim] * len(r), pa.int32()), "query_id": names[i:i + 512][r], "rep": reps[ids[r, at]], "score": score[r, at]}))
        return pa.concat_tables(out)
    return search


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Distinct (vec_id, embedding) of vectors that take part.

    Left out: null ids, null, empty and zero vectors, and vectors with null
    or non-finite components.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("embedding"))
            .where("vec_id is not null and embedding is not null").where(fine)
            .where(F.exists("embedding", lambda x: x != 0)).dropDuplicates(["vec_id", "embedding"]))


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, beam: int = QUERY_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of df (usable() rows) found for each row of queries.

    A query is searched among the vectors of its own length, which have
    graphs of their own.  A query's own id is no candidate.  Ties go to the smaller id.  An empty
    table, or one without queries, gives an empty result.
    """
    # equal vectors are one point, with as many of its smallest ids as a result can hold (k and the query's own)
    ranked = df.withColumn("turn", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id")))
    points = (ranked.where(F.col("turn") <= k + 1).groupBy("embedding")
              .agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids")).checkpoint())
    points = points.withColumn("dim", F.size("embedding"))
    queries = queries.withColumn("dim", F.size("embedding"))
    # for each length, its shards and blocks
    deal = F.broadcast(points.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards")).join(
        queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")), "dim"))
    index = (points.join(deal, "dim")
             .select("dim", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int").alias("shard"), "rep", "embedding")
             .groupBy("dim", "shard").applyInArrow(_build, _INDEX).join(deal, "dim")
             .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    spread = (queries.join(deal, "dim")
              .select("dim", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "embedding",
                      F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")))
    found = (index.groupBy("dim", "shard", "block").cogroup(spread.groupBy("dim", "shard", "block"))
             .applyInArrow(_search(k + 1, beam), "dim int, query_id long, rep long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    members = best.join(points.select("dim", "rep", "ids"), ["dim", "rep"]).select("query_id", "score", F.explode("ids").alias("vec_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (members.where("vec_id <> query_id").withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def search_table(df: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k nearest for each row whose vec_id is divisible by `every`, against all rows."""
    rows = usable(df)
    return nearest(rows, rows.where(F.col("vec_id") % every == 0), k)
