"""M1: staging view over the raw messages table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics.functions.keys import surrogate_key

STAGING_COLUMNS = [
    ("message_id", "bigint"),
    ("channel_username", "string"),
    ("channel_name", "string"),
    ("message_date", "date"),
    ("scrape_date", "date"),
    ("message_text", "string"),
    ("message_length", "int"),
    ("views", "int"),
    ("forwards", "int"),
    ("has_photo", "boolean"),
    ("photo_path", "string"),
]


def stage_messages(raw: DataFrame) -> DataFrame:
    """Typed projection of raw messages plus ``message_sk``.

    A pure projection: no shuffle, and Catalyst prunes the columns a
    downstream consumer does not read.
    """
    cols = [F.col(c).cast(t).alias(c) for c, t in STAGING_COLUMNS]
    return raw.select(*cols, surrogate_key("message_id", "channel_username").alias("message_sk"))


def staging_sql(table: str) -> str:
    """The same projection as SQL, for the stored view."""
    columns = ", ".join(f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in STAGING_COLUMNS)
    key = "md5(concat_ws('-', coalesce(CAST(message_id AS STRING), ''), coalesce(CAST(channel_username AS STRING), '')))"
    return f"SELECT {columns}, {key} AS message_sk FROM {table}"
