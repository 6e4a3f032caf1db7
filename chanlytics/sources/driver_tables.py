"""Adapter from the driver's parquet tables to the raw shapes of the model.

The driver ships TPC-H-like tables, not channel exports.  These functions
derive the raw tables from them with plain column arithmetic, so every
query over the model reads the given tables and grows with them.  The
same rules are written as SQL in ``__spark_entry__.oracle_sql`` for the
DuckDB parity check.

Mapping (documents -> raw messages): message_id = doc_id, channel = source,
message_date = 2024-01-01 + doc_id % 90 days, scrape_date = message_date +
doc_id % 5 days, text, views = n_chars % 500, forwards = doc_id % 7,
has_photo = doc_id % 3 = 0, photo_path only when doc_id % 6 = 0.  So that
every rule meets rows on both sides, the raw messages have no text where
doc_id % 19 = 0, a flag word where doc_id % 13 or 17 is 0 and products with
prices where doc_id % 11 = 0, and two
channels are in the mapping; detections of one of these keep its plain
name, so they find no message.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.functions.text import message_length

# Fixed values of the adapter (shared with the oracle SQL).
BASE_DATE = dt.date(2024, 1, 1)
DATE_SPREAD_DAYS = 90
SCRAPE_LAG_DAYS = 5
DETECTION_TIME = dt.datetime(2024, 4, 1, 0, 0, 0)
DEFAULT_CHANNEL = "src0"
MAPPED_CHANNELS = {"src1": "@source_one", "src2": "@source_two"}
PRODUCT_TEXT = " tablet 1,500 birr; test kit 12,5 or (cream) 1234567890123. Tablet 7.25, tablet v1.2.3 2,000.5!"
ORPHAN_CHANNEL = "src2"  # its detections do not follow the mapping
CHANNEL_MAP = model.CHANNEL_USERNAMES | MAPPED_CHANNELS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> landing-export records plus their file and position.

    A file is one channel on one scrape date (``<date>/<channel>.json``);
    the position inside the file follows doc_id.
    """
    d = table(spark, sf_dir, "documents")
    msg_date = F.date_add(F.lit(BASE_DATE), (F.col("doc_id") % DATE_SPREAD_DAYS).cast("int"))
    scrape = F.date_add(msg_date, (F.col("doc_id") % SCRAPE_LAG_DAYS).cast("int"))
    photo = (F.col("doc_id") % 6 == 0)
    return d.select(
        F.col("doc_id").alias("message_id"),
        F.col("source").alias("channel"),
        msg_date.alias("date"),
        F.col("text"),
        (F.col("n_chars") % 500).cast("int").alias("views"),
        (F.col("doc_id") % 7).cast("int").alias("forwards"),
        (F.col("doc_id") % 3 == 0).alias("has_photo"),
        F.when(photo, F.concat(F.lit("data/images/"), F.col("source"), F.lit("_"),
                               F.col("doc_id").cast("string"), F.lit(".jpg"))).alias("photo_path"),
        scrape.alias("scrape_date"),
        F.concat(scrape.cast("string"), F.lit("/"), F.col("source"), F.lit(".json")).alias("source_file"),
        F.col("doc_id").alias("source_pos"),
    )


def message_text() -> "F.Column":
    """The text of a raw message: none, with a flag word, or as in the table."""
    i, t = F.col("message_id"), F.col("text")
    return (F.when(i % 19 == 0, F.lit(None)).when(i % 13 == 0, F.concat(t, F.lit(" URGENT, today")))
            .when(i % 17 == 0, F.concat(F.lit("New Vacancy: "), t))
            .when(i % 11 == 0, F.concat(t, F.lit(PRODUCT_TEXT))).otherwise(t))


def raw_messages(spark: SparkSession, sf_dir: str,
                 mapping: "DataFrame | dict[str, str] | None" = None) -> DataFrame:
    """documents -> the raw messages table (one row per document)."""
    from chanlytics.operators.lookup import map_channel_with_fallback

    ex = export_rows(spark, sf_dir)
    mapping = CHANNEL_MAP if mapping is None else mapping
    ex = map_channel_with_fallback(ex, mapping, "channel").withColumn("text", message_text())
    return ex.select(
        F.col("message_id"),
        F.col("channel").alias("channel_name"),
        F.col("channel_username"),
        F.col("scrape_date"),
        F.col("date").alias("message_date"),
        F.col("text").alias("message_text"),
        message_length("text").alias("message_length"),
        "views", "forwards", "has_photo", "photo_path",
    )


def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings ⟕ documents -> one image per embedding.

    Columns: vec_id, channel, image_path, embedding, label.  Embeddings
    without a document take the default channel.
    """
    v = table(spark, sf_dir, "embeddings")
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("vec_id"), F.col("source"))
    ch = F.coalesce(F.col("source"), F.lit(DEFAULT_CHANNEL))
    return v.join(d, "vec_id", "left").select(
        "vec_id",
        ch.alias("channel"),
        F.concat(F.lit("data/images/"), ch, F.lit("_"), F.col("vec_id").cast("string"),
                 F.lit(".jpg")).alias("image_path"),
        "embedding", "label",
    )


def write_image_files(images: DataFrame, folder: str) -> int:
    """One file per image, named like its path, holding the embedding as float32; the number of files.

    images: image_path, embedding.  Tasks write through pyarrow's file
    systems; a retried task writes the same files again.  The rows are
    dealt to a few tasks a slot: their bytes are few, but each is a file.
    """
    def write(batches):
        import numpy as np
        import pandas as pd
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        for pdf in batches:
            for path, vector in zip(pdf["image_path"], pdf["embedding"]):
                with store.open_output_stream(f"{root}/{path.rsplit('/', 1)[-1]}") as out:
                    out.write(np.asarray(vector, dtype="<f4").tobytes())
            yield pd.DataFrame({"n": [len(pdf)]})

    tasks = 2 * images.sparkSession.sparkContext.defaultParallelism
    return images.select("image_path", "embedding").repartition(tasks, "image_path").mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


def detection_username() -> "F.Column":
    """The mapped name of a detection's channel, but for the channel that stays unmapped."""
    out = F.col("channel")
    for name, user in MAPPED_CHANNELS.items():
        if name != ORPHAN_CHANNEL:
            out = F.when(F.col("channel") == name, F.lit(user)).otherwise(out)
    return out


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings ⟕ documents -> raw.image_detections (one box per embedding)."""
    img = image_paths(spark, sf_dir)
    cls = F.concat(F.lit("class"), F.col("label").cast("string"))
    conf = ((F.col("vec_id") * 7919) % 10000).cast("decimal(20,0)") / F.lit(10000)
    return img.select(
        F.concat(F.col("channel"), F.lit("_"), F.col("vec_id").cast("string"), F.lit(".jpg_"), cls, F.lit("_0"))
        .alias("detection_id"),
        F.col("vec_id").alias("message_id"),
        detection_username().alias("channel_username"),
        F.col("image_path"),
        cls.alias("detected_object_class"),
        conf.cast("decimal(5,4)").alias("confidence_score"),
        F.lit(DETECTION_TIME).cast("timestamp_ntz").alias("detection_timestamp"),
    )


def fetched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> platform messages as fetched (input of the exporter, E3).

    posted_at = 2024-01-01 + doc_id minutes; views NULL for every 11th id;
    media: photo when doc_id % 3 = 0, document when doc_id % 3 = 1.
    """
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("message_id"),
        F.concat(F.lit("@"), F.col("source")).alias("channel_username"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
         + F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("posted_at"),
        F.col("text"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(None)).otherwise(F.col("n_chars") % 500)
        .cast("int").alias("views"),
        (F.col("doc_id") % 7).cast("int").alias("forwards"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("photo"))
        .when(F.col("doc_id") % 3 == 1, F.lit("document")).alias("media_type"),
    )
