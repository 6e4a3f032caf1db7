"""Lookup joins against channel mappings.

A mapping given as a dict is a literal of the plan.  One given as a
DataFrame is joined plainly: Spark chooses the join from real sizes (AQE),
nothing is counted beforehand and no size changes the code path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_literal(mapping: dict[str, str]) -> Column:
    items = []
    for k, v in sorted(mapping.items()):
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items) if items else F.create_map().cast("map<string,string>")


def map_channel_with_fallback(df: DataFrame, mapping: "DataFrame | dict[str, str]",
                              name_col: str, out_col: str = "channel_username") -> DataFrame:
    """Add ``out_col`` = mapped username, or the channel name when unmapped."""
    if isinstance(mapping, dict):
        looked_up = F.try_element_at(map_literal(mapping), F.col(name_col))
        return df.withColumn(out_col, F.coalesce(looked_up, F.col(name_col)))
    m = mapping.select(F.col("channel").alias("__ch"), F.col("channel_username").alias("__un"))
    joined = df.join(m, F.col(name_col) == F.col("__ch"), "left")
    return joined.withColumn(out_col, F.coalesce(F.col("__un"), F.col(name_col))) \
        .drop("__ch", "__un")


def map_channel_strict(df: DataFrame, mapping: "DataFrame | dict[str, str]", name_col: str,
                       out_col: str = "channel_username") -> tuple[DataFrame, DataFrame]:
    """Split into (mapped rows with ``out_col``, unmapped rows)."""
    if isinstance(mapping, dict):
        looked_up = F.try_element_at(map_literal(mapping), F.col(name_col))
        tagged = df.withColumn(out_col, looked_up)
        return (tagged.filter(F.col(out_col).isNotNull()),
                tagged.filter(F.col(out_col).isNull()).drop(out_col))
    m = mapping.select(F.col("channel").alias("__ch"), F.col("channel_username").alias("__un"))
    joined = df.join(m, F.col(name_col) == F.col("__ch"), "left")
    known = joined.filter(F.col("__un").isNotNull()) \
        .withColumn(out_col, F.col("__un")).drop("__ch", "__un")
    unknown = joined.filter(F.col("__un").isNull()).drop("__ch", "__un")
    return known, unknown
