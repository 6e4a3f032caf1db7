"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Edges for one partition: a round's tables are small, and are not left in more pieces than they fill.
EDGES = 200_000


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    """As many edges as there were."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").coalesce(parts))


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; root: the least node of its component.

    edges: columns u, v of one orderable type, any direction, repeats and
    loops allowed; nulls are ignored.  Every node ends one step from its
    root after a number of rounds that grows with the logarithm of the
    diameter; each round is checkpointed.  No neighbour list is ever built.
    """
    now = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .distinct().checkpoint())
    state = _state(now)
    while True:
        parts = max(now.sparkSession.sparkContext.defaultParallelism, math.ceil(state[0] / EDGES))
        now = _small_star(_large_star(now.coalesce(parts), parts), parts).checkpoint()
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))
