"""Latest-per-key and top-k-per-group.

``row_number() ... = 1`` / ``<= k`` is planned by Catalyst as a
``WindowGroupLimit``: a partial limit runs in every map task before the
shuffle, so each task ships at most k rows per key, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn" if rank_col is None else rank_col
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out.drop("__rn") if rank_col is None else out


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under ``order`` (give a total order)."""
    return top_k_per_group(df, keys, order, 1)
