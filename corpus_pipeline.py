"""Corpus pipeline: quality, near duplicates, decontamination, personal data, tokens.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents for the next stage, with the columns of the table
documents; the last one returns token ids.  run() writes each stage's
documents as Parquet into the shared checkpoint folder and reads them again.

Every stage works on all rows that the one before it kept, whole texts:
  quality        rows whose text scores below 0.3 go
  near_dedup     of each class of near duplicates the document of least id stays
  decontaminate  documents in which ten consecutive benchmark words occur go
  pii            personal data is replaced by its kind, n_chars follows
  sentencepiece  one row for each text, or each 65,536 characters of a longer one

Null texts count as empty; empty texts pass every stage but the first,
which scores them like any text.  Repeated rows are one class in the second.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlytics.llm import common as C
from chanlytics.llm import decontaminate, near_dedup, pieces, pii, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    model = quality.train(docs, C.read_table(spark, sf_dir, "labels"), C.fold_of("doc_id") != 0)
    return quality.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    return near_dedup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    return decontaminate.keep_clean(docs, C.read_table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    return pieces.encode(docs).select("doc_id", "part", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: SQL can express neither a fitted model nor the lattice of pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token rows of the documents that pass all stages."""
    C.prepare(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = C.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
