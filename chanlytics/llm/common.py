"""Helpers shared by the operators: tables, checkpoints, block sizes, ids."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows and bytes of an Arrow batch: texts may be long, and a task holds a batch several times.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def prepare(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    """Session settings, the shared checkpoint folder, and the package on the executors."""
    from chanlytics.session import configure, ship_package

    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        where = sc.getConf().get("spark.checkpoint.dir", None)
        if not where:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            where = tempfile.mkdtemp(prefix="llm-ckpt-")
        sc.setCheckpointDir(where)
    ship_package(spark)
    return spark


def id_text(col: str) -> Column:
    """An id as text; a null id counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold_of(col: str) -> Column:
    """crc32(id as text) mod 5."""
    return F.pmod(F.crc32(id_text(col)), F.lit(5)).cast("int")


def tokenizer_dir() -> str:
    """Folder of the public vocabulary files (a parameter; the variable overrides it)."""
    return os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
