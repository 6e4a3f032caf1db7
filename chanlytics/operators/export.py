"""Normalise fetched platform messages into landing-export rows.

Input: one row per fetched message (``message_id, channel_username,
posted_at, text, views, forwards, media_type``).  The network fetch is
not part of this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.operators.lookup import map_channel_strict
from chanlytics.operators.topk import top_k_per_group


def normalise_export(fetched: DataFrame, target_channels: dict[str, str],
                     photo_channels: list[str] | None = None,
                     limit: int = model.EXPORT_LIMIT_PER_CHANNEL) -> tuple[DataFrame, DataFrame]:
    """(export rows, rejected rows of unknown channels).

    * only allow-listed usernames (F10); others are returned as rejects
    * latest ``limit`` messages per channel by message id (L7), planned as
      a partial top-k per task before the shuffle
    * NULL text -> '', NULL views/forwards -> 0 (P19); date of the post in
      UTC (P20); has_photo = the message has a photo (P21)
    * photo_path only for photo channels and photo media (P22)
    """
    photo_channels = model.PHOTO_CHANNELS if photo_channels is None else photo_channels
    known, unknown = map_channel_strict(
        fetched.withColumnRenamed("channel_username", "__user"), target_channels, "__user",
        out_col="channel")
    latest = top_k_per_group(known, ["channel"], [F.col("message_id").desc()], limit)
    is_photo = F.coalesce(F.col("media_type") == F.lit("photo"), F.lit(False))
    path = F.when(F.col("channel").isin(photo_channels) & is_photo,
                  F.concat(F.lit("data/images/"), F.col("channel"), F.lit("_"),
                           F.col("message_id").cast("string"), F.lit(".jpg")))
    export = latest.select(
        "message_id", "channel",
        F.to_date("posted_at").alias("date"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("views"), F.lit(0)).cast("int").alias("views"),
        F.coalesce(F.col("forwards"), F.lit(0)).cast("int").alias("forwards"),
        is_photo.alias("has_photo"),
        path.alias("photo_path"),
    )
    return export, unknown.withColumnRenamed("__user", "channel_username")
