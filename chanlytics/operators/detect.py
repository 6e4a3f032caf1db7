"""Score new images in distributed batches with a pluggable detector.

The detector runs inside ``mapInPandas``: Spark partitions the images,
each Python worker loads the model once and scores Arrow batches.  All
other steps (name parsing, channel mapping, processed-set anti join,
flattening boxes, ids, rounding) are built-in column expressions.

A scorer is any picklable object with ``class_names`` and
``predict(payloads: pandas.Series) -> list[list[(class_id, confidence)]]``.
``load()`` may be overridden to fetch weights once per worker (for
example from ``SparkFiles``).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.operators.lookup import map_channel_strict
from chanlytics.session import LISTING_CONF, ensure_checkpoint_dir, listing_tasks

BOXES_TYPE = "array<struct<class_id:int,confidence:double>>"

_WORKER_MODELS: dict[tuple[str, str, str], object] = {}


class Scorer:
    """Base class: subclasses implement ``predict``; ``token`` keys the worker cache.

    Workers outlive a query, so the token has to tell apart what the scorers
    of a class hold: it is made from that, not from where an object lies.
    """

    class_names: list[str] = []
    token: str = "scorer"

    def load(self) -> "Scorer":
        return self

    def predict(self, payloads: pd.Series) -> list[list[tuple[int, float]]]:
        raise NotImplementedError


def _worker_model(scorer: Scorer) -> Scorer:
    key = (type(scorer).__module__, type(scorer).__qualname__, scorer.token)
    m = _WORKER_MODELS.get(key)
    if m is None:
        m = _WORKER_MODELS[key] = scorer.load()
    return m


def _content_token(kind: str, *parts: object) -> str:
    return f"{kind}-" + hashlib.sha256(repr(parts).encode()).hexdigest()


class CentroidScorer(Scorer):
    """Stand-in detector: cosine similarity of a feature vector to class centroids.

    Every class whose similarity reaches ``min_confidence`` is a box, best
    first (ties by class id).  The centroids are a small matrix (classes x
    features) shipped with the task closure.
    """

    def __init__(self, centroids: np.ndarray, class_names: list[str], min_confidence: float = 0.2):
        c = np.asarray(centroids, dtype=np.float64)
        self.unit = c / np.linalg.norm(c, axis=1, keepdims=True)
        self.class_names = list(class_names)
        self.min_confidence = float(min_confidence)
        self.token = _content_token("centroid", c.shape, c.tobytes(), self.class_names, self.min_confidence)

    def predict(self, payloads: pd.Series) -> list[list[tuple[int, float]]]:
        if len(payloads) == 0:
            return []
        x = np.stack([np.asarray(p, dtype=np.float64) for p in payloads])
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        sim = x @ self.unit.T
        out = []
        for row in sim:
            idx = np.nonzero(row >= self.min_confidence)[0]
            idx = idx[np.lexsort((idx, -row[idx]))]
            out.append([(int(i), float(row[i])) for i in idx])
        return out


class CentroidFileScorer(Scorer):
    """The centroid detector with its model in a file shipped by ``addFile``.

    The pattern for real model weights: the driver ships the file once
    (``ship``), each Python worker loads it from ``SparkFiles`` on first use
    (``load``) and keeps it for later batches.
    """

    def __init__(self, file_name: str, class_names: list[str], min_confidence: float = 0.2):
        self.file_name = file_name
        self.class_names = list(class_names)
        self.min_confidence = float(min_confidence)
        self.token = _content_token("centroid-file", file_name, self.class_names, self.min_confidence)

    @staticmethod
    def ship(spark, centroids: np.ndarray, path: str) -> str:
        """Save the centroids to ``path`` (an .npy file) and ship it to every worker."""
        np.save(path, np.asarray(centroids, dtype=np.float64))
        spark.sparkContext.addFile(path)
        return path.rsplit("/", 1)[-1]

    def load(self) -> Scorer:
        from pyspark import SparkFiles

        centroids = np.load(SparkFiles.get(self.file_name))
        return CentroidScorer(centroids, self.class_names, self.min_confidence)


class CentroidBytesScorer(CentroidScorer):
    """The centroid detector over image files that hold a feature vector as float32."""

    def predict(self, payloads: pd.Series) -> list[list[tuple[int, float]]]:
        return super().predict(payloads.map(lambda b: np.frombuffer(b, dtype="<f4")))


def fit_centroids(vectors: DataFrame, label_col: str = "label",
                  vector_col: str = "embedding") -> tuple[np.ndarray, list[int]]:
    """Class centroids computed by Spark (per label and position averages).

    Only the model - one value for each label and feature - reaches the
    driver, from where it is shipped to the workers whole.
    """
    per_dim = (vectors.select(label_col, F.posexplode(vector_col).alias("pos", "x"))
               .groupBy(label_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("v")))
    rows = per_dim.collect()
    labels = sorted({r[0] for r in rows})
    dim = max(r[1] for r in rows) + 1
    c = np.zeros((len(labels), dim))
    li = {lab: i for i, lab in enumerate(labels)}
    for lab, pos, v in rows:
        c[li[lab], pos] = v
    return c, labels


def parse_image_names(images: DataFrame, path_col: str = "path") -> DataFrame:
    """``<Channel>_<message_id>[_...].<ext>`` -> file_name, stem, channel_name, message_ref, name_ok."""
    stem = F.regexp_extract(F.col(path_col), r"([^/]+)\.[^./]+$", 1)
    parts = F.split(stem, "_")
    return images.select(
        "*",
        F.regexp_extract(F.col(path_col), r"([^/]+)$", 1).alias("file_name"),
        stem.alias("stem"),
        F.get(parts, 0).alias("channel_name"),
        F.get(parts, 1).alias("message_ref"),
        (F.size(parts) >= 2).alias("name_ok"),
    )


def image_files_filter(path_col: str = "path"):
    """Extension allow-list, compared lower-cased."""
    ext = F.lower(F.substring_index(F.col(path_col), ".", -1))
    return ext.isin(model.IMAGE_EXTENSIONS) & F.col(path_col).contains(".")


def list_images(spark, image_dir: str) -> DataFrame:
    """The paths of one folder's files (not recursive) with an image extension; no file is opened."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(image_dir)
    return df.select("path").filter(image_files_filter("path"))


def read_images(spark, image_dir: str) -> DataFrame:
    """S4 with contents, for callers that want every image."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(image_dir)
    return df.filter(image_files_filter("path"))


_PATTERN_CHARACTERS = r"[\[\]{}*?\\]"


def _content_scan(spark, paths: list[str]) -> DataFrame:
    """(path, content) of these files and no others.

    The reader takes paths as patterns; a character that means something
    there is matched by '?', and what else that meets is left out.
    """
    odd = any(re.search(_PATTERN_CHARACTERS, p) for p in paths)
    asked = sorted({re.sub(_PATTERN_CHARACTERS, "?", p) for p in paths})
    files = spark.read.format("binaryFile").load(asked).select("path", "content")
    return files.where(F.col("path").isin(paths)) if odd else files


def score_files(spark, paths: DataFrame, scorer: Scorer, batch_paths: int) -> DataFrame:
    """(path, boxes) of the files at ``paths``, read for the scoring alone.

    The paths are dealt by hash into batches of about ``batch_paths``, the
    bound of what the driver holds; a batch's files are one binaryFile scan
    whose rows go to the model in the same task, so contents are never
    shuffled and no other file is read.  A scan has a few tasks a slot, and
    its listing is not kept.  Each batch's paths and scores are stored below
    the checkpoint folder.
    """
    batches = max(1, math.ceil(paths.count() / batch_paths))
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}"
    asked = paths.select("path").distinct().withColumn("batch", F.pmod(F.xxhash64("path"), F.lit(batches)))
    asked.repartition("batch").write.partitionBy("batch").parquet(f"{out}/paths")
    asked = spark.read.schema("path string, batch bigint").parquet(f"{out}/paths")
    schema = f"path string, boxes {BOXES_TYPE}"
    spark.createDataFrame([], schema).write.parquet(f"{out}/boxes")
    tasks = listing_tasks(spark)
    with _setting(spark, LISTING_CONF, tasks), _setting(spark, SCAN_TASKS_CONF, tasks), _setting(spark, LISTING_CACHE_CONF, "0"):
        for k in range(batches):
            own = [r.path for r in asked.where(F.col("batch") == k).select("path").collect()]
            if own:
                scored = score_images(_content_scan(spark, own), scorer, "content")
                if any(map(re.compile(_PATTERN_CHARACTERS).search, own)):
                    scored = scored.dropDuplicates(["path"])  # a file that two patterns meet is read twice
                scored.write.mode("append").parquet(f"{out}/boxes")
    return spark.read.schema(schema).parquet(f"{out}/boxes")


@contextmanager
def _setting(spark, key: str, value: str | None):
    """A session setting for the jobs of a block; None leaves it as it is."""
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@dataclass
class Detections:
    scored: DataFrame      # one row per scored image with its boxes
    detections: DataFrame  # raw.image_detections rows (one per box)
    scan_log: DataFrame    # E2: image_path, n_boxes, scored_at (zero-box images kept)
    rejects: DataFrame     # image_path, reason


def score_images(todo: DataFrame, scorer: Scorer, payload_col: str) -> DataFrame:
    """mapInPandas: (image_path, boxes) per image; the model loads once per worker."""
    keep = [c for c in todo.columns if c != payload_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in todo.schema.fields if f.name in keep) + f", boxes {BOXES_TYPE}"

    def run(batches):
        m = _worker_model(scorer)
        for pdf in batches:
            boxes = m.predict(pdf[payload_col])
            out = pdf[keep].copy()
            out["boxes"] = [[{"class_id": c, "confidence": v} for c, v in b] for b in boxes]
            yield out

    return todo.mapInPandas(run, schema)


def prepare_images(images: DataFrame, mapping: "dict[str, str] | DataFrame | None" = None,
                   processed: DataFrame | None = None, path_col: str = "path",
                   payload_col: str = "content",
                   image_prefix: str = "data/images/") -> tuple[DataFrame, DataFrame]:
    """(images to score, rejected images) before any model runs.

    * names: under two ``_`` parts -> 'bad_name'; unmapped channel ->
      'unmapped_channel' (P17)
    * ``processed`` (detections or a scan log with ``image_path``) is
      anti-joined out (J6)
    """
    mapping = model.CHANNEL_USERNAMES if mapping is None else mapping
    parsed = parse_image_names(images, path_col).withColumn(
        "image_path", F.concat(F.lit(image_prefix), "file_name"))
    bad_name = parsed.filter(~F.col("name_ok")).select("image_path", F.lit("bad_name").alias("reason"))
    known, unknown = map_channel_strict(parsed.filter("name_ok"), mapping, "channel_name")
    todo = known
    keep = [c for c in (payload_col, path_col) if c in images.columns]
    if processed is not None:
        from chanlytics.operators.ingest import new_images

        todo = new_images(todo, processed)
    todo = todo.select("image_path", "file_name", "channel_username", "message_ref", *keep)
    rejects = bad_name.unionByName(
        unknown.select("image_path", F.lit("unmapped_channel").alias("reason")))
    return todo, rejects


def flatten_scores(scored: DataFrame, class_names: list[str],
                   run_ts: dt.datetime) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(detections, scan log, rejects) from scored images.

    An image with boxes whose id is not an integer is rejected
    ('bad_message_id'), as the reference fails on that image.
    detection_id = ``<file name>_<class>_<box index>``: reproducible, and
    different for images that differ in their extension alone.  ``run_ts``
    is the time of the run.
    """
    ts = F.lit(run_ts).cast("timestamp_ntz")
    n_boxes = F.size("boxes")
    msg_id = F.expr("try_cast(message_ref AS BIGINT)")
    scan_log = scored.select("image_path", n_boxes.alias("n_boxes"), ts.alias("scored_at"))
    bad_id = scored.filter((n_boxes > 0) & msg_id.isNull()) \
        .select("image_path", F.lit("bad_message_id").alias("reason"))
    names = F.array(*[F.lit(n) for n in class_names])
    boxes = scored.filter(msg_id.isNotNull()).select(
        "file_name", "channel_username", "image_path", msg_id.alias("message_id"),
        F.posexplode("boxes").alias("box_idx", "box"))
    cls = F.get(names, F.col("box.class_id"))
    detections = boxes.select(
        F.concat_ws("_", F.col("file_name"), cls, F.col("box_idx").cast("string")).alias("detection_id"),
        "message_id", "channel_username", "image_path",
        cls.alias("detected_object_class"),
        F.round(F.col("box.confidence"), 4).cast("decimal(5,4)").alias("confidence_score"),
        ts.alias("detection_timestamp"),
    )
    return detections, scan_log, bad_id


def detect_objects(images: DataFrame, scorer: Scorer, run_ts: dt.datetime,
                   mapping: "dict[str, str] | DataFrame | None" = None,
                   processed: DataFrame | None = None,
                   path_col: str = "path", payload_col: str = "content",
                   image_prefix: str = "data/images/") -> Detections:
    """Score every new image and flatten the boxes to detection rows (E1), lazily."""
    todo, early = prepare_images(images, mapping, processed, path_col, payload_col, image_prefix)
    scored = score_images(todo.drop(path_col), scorer, payload_col)
    detections, scan_log, bad_id = flatten_scores(scored, scorer.class_names, run_ts)
    return Detections(scored, detections, scan_log, early.unionByName(bad_id))


ARROW_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
SCAN_TASKS_CONF = "spark.sql.files.maxPartitionNum"
LISTING_CACHE_CONF = "spark.sql.hive.filesourcePartitionFileCacheSize"


#: Image files that one scan of the enrichment job opens, and of which the driver holds the paths.
BATCH_PATHS = 10_000


def run_detection(spark, images: DataFrame, scorer: Scorer, detections_path: str,
                  run_ts: dt.datetime, scan_log_path: str | None = None, mapping=None,
                  path_col: str = "path",
                  payload_col: str = "content", image_prefix: str = "data/images/",
                  batch_rows: int | None = 64, batch_paths: int = BATCH_PATHS) -> Detections:
    """The enrichment job: score new images and append detections (I4).

    ``images``: paths (``list_images``).  Names, channels and the processed
    set are settled on these, and only the files of new images are opened
    (``score_files``).  A frame that has the payloads already is scored as it
    is.  Scores are checkpointed once (the model runs once per image), then
    detections are appended insert-if-absent on detection_id.  With
    ``scan_log_path`` images with zero boxes are remembered too and are
    not scored again next run (E2).
    """
    from pyspark.sql.types import _parse_datatype_string

    from chanlytics.operators.ingest import append_if_absent, read_table

    ensure_checkpoint_dir(spark)
    processed = read_table(spark, detections_path, model.RAW_DETECTIONS_SCHEMA).select("image_path")
    # images are large: score them in small Arrow batches (bounded worker memory)
    log_schema = _parse_datatype_string("image_path string, n_boxes int, scored_at timestamp_ntz")
    if scan_log_path:
        processed = processed.unionByName(
            read_table(spark, scan_log_path, log_schema).select("image_path"))
    by_path = payload_col not in images.columns
    todo, early = prepare_images(images, mapping, processed, path_col, payload_col, image_prefix)
    with _setting(spark, ARROW_BATCH_CONF, str(batch_rows) if batch_rows else None):
        if by_path:
            todo = todo.withColumnRenamed(path_col, "path").checkpoint(eager=True)
            scored = todo.join(score_files(spark, todo.select("path"), scorer, batch_paths), "path").drop("path")
        else:
            scored = score_images(todo.drop(path_col), scorer, payload_col).checkpoint(eager=True)
    detections, scan_log, bad_id = flatten_scores(scored, scorer.class_names, run_ts)
    append_if_absent(spark, detections, detections_path, model.RAW_DETECTIONS_SCHEMA,
                     model.RAW_DETECTIONS_KEY, [F.col("image_path")])
    if scan_log_path:
        # keyed by image: a retried run does not log an image twice
        append_if_absent(spark, scan_log.select(*[f.name for f in log_schema.fields]),
                         scan_log_path, log_schema, ["image_path"], [F.col("scored_at")])
    return Detections(scored, detections, scan_log, early.unionByName(bad_id))
