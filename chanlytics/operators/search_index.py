"""Trigram postings of a stored message table: which files can hold a text.

A search for ``LIKE '%query%'`` has to read every text.  The postings of a
stored table, one row for each (trigram, file) of its lower-cased texts,
tell beforehand which files lack some trigram of the query's literal parts;
the others are read and searched as before, so the rows are the same.

Postings are written with the table and belong to its files: a file that
they do not list (appended later) is always read.  Files are told apart by
their name, so the table is one folder without partition folders, as the
daily job writes it.  Postings are sorted by trigram, so a query reads the
few row groups that hold its own.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlytics.functions.text import like_runs

#: Texts are cut into overlapping pieces of so many characters, the bound of the trigrams held at once.
PIECE = 1 << 16
#: Stands for a file as such in the postings.
_LISTED = ""


def write_postings(spark: SparkSession, table: str, postings: str, text: str = "message_text") -> DataFrame:
    """The (trigram, file) rows of a stored table, written to a folder and read back.

    Null texts and texts of fewer than three characters have no trigrams;
    each file with a row is listed under the empty trigram too.
    """
    rows = spark.read.parquet(table).select(F.lower(text).alias("t"), F.col("_metadata.file_name").alias("file"))
    starts = F.sequence(F.lit(0), F.coalesce(F.length("t"), F.lit(0)), F.lit(PIECE))
    pieces = rows.select("file", "t", F.explode(starts).alias("start")).select(
        "file", F.substring("t", F.col("start") + 1, F.lit(PIECE + 2)).alias("piece"))
    found = F.array_distinct(F.regexp_extract_all("piece", F.lit("(?s)(?=(.{3}))"), 1))
    listed = F.array(F.lit(_LISTED))
    grams = pieces.select("file", F.explode(F.concat(listed, F.coalesce(found, F.array().cast("array<string>")))).alias("trigram"))
    (grams.select("trigram", "file").distinct().repartitionByRange("trigram", "file").sortWithinPartitions("trigram", "file")
     .write.mode("overwrite").parquet(postings))
    return spark.read.schema("trigram string, file string").parquet(postings)


def query_trigrams(query: str, literal: bool = False) -> list[str]:
    """The trigrams that every text LIKE ``%query%`` holds; none for a query without three plain characters in a row."""
    return sorted({run[i:i + 3] for run in like_runs(query, literal) for i in range(len(run) - 2)})


def candidate_files(fact: DataFrame, postings: DataFrame, query: str, literal: bool = False) -> list[str]:
    """The paths of a stored table's files that may hold the query.

    The list is as long as the table has files at most, which the driver
    holds for any scan.
    """
    paths = {unquote(os.path.basename(p)): p for p in fact.inputFiles()}
    grams = query_trigrams(query, literal)
    if not grams:
        return sorted(paths.values())
    per_file = postings.where(F.col("trigram").isin([_LISTED, *grams])).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    without = {r.file for r in per_file.where(F.col("n") <= len(grams)).select("file").collect()}
    return sorted(p for name, p in paths.items() if name not in without)


def prune(fact: DataFrame, postings: DataFrame, query: str, literal: bool = False) -> DataFrame:
    """The stored table without the files that cannot hold the query: the input of ``search_messages``."""
    files = candidate_files(fact, postings, query, literal)
    if not files:
        return fact.where(F.lit(False))
    return fact.sparkSession.read.schema(fact.schema).parquet(*[unquote(p) for p in files])
