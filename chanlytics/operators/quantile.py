"""Exact medians of many groups, none of which has to fit one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lower_medians(counts: DataFrame, groups: list[str], value: str = "value", n: str = "n",
                  pieces: int | None = None) -> DataFrame:
    """(groups..., median): the least value up to which at least half of a group's occurrences lie.

    counts: one row per group and distinct value, with its occurrences.  The
    rows are dealt by ranges of (group, value), so a group of many values
    spans many pieces.  Sums per piece tell in which piece a group's middle
    lies; only that piece's rows are summed up one by one.  Both windows are
    bounded: the first by the number of pieces, the second by a piece.
    ``pieces`` defaults to the session's shuffle partitions.

    Checkpoints the counts and their ranges: the bounds come from a sample,
    so a recomputed range would not have to be the same.
    """
    spark = counts.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = counts.select(*groups, F.col(value).alias("__value"), F.col(n).alias("__n")).checkpoint()
    ranged = own.repartitionByRange(pieces, *groups, "__value").withColumn("__piece", F.spark_partition_id()).checkpoint()
    per = ranged.groupBy(*groups, "__piece").agg(F.sum("__n").alias("__m"))
    group = Window.partitionBy(*groups)
    before = F.sum("__m").over(group.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1))
    placed = per.select(*groups, "__piece", "__m", F.coalesce(before, F.lit(0)).alias("__before"),
                        F.sum("__m").over(group).alias("__total"))
    middle = placed.where((F.col("__before") * 2 < F.col("__total"))
                          & ((F.col("__before") + F.col("__m")) * 2 >= F.col("__total"))).drop("__m")
    same = F.lit(True)
    for c in groups:  # a group may be named by nulls
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}"))
    rows = ranged.alias("r").join(middle.alias("m"), same & (F.col("r.__piece") == F.col("m.__piece"))).select(
        *[F.col(f"r.{c}").alias(c) for c in groups], "__value", "__n", "__before", "__total")
    upto = F.col("__before") + F.sum("__n").over(
        group.orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("__upto", upto).where(F.col("__upto") * 2 >= F.col("__total"))
            .groupBy(*groups).agg(F.min("__value").alias("median")))
