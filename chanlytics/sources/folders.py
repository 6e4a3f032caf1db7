"""Folders of many files: which of them are new, without a list of them on the driver.

Spark's file source and its readers hold several objects for each file in the
driver.  Here a folder is listed in pieces, which are written as they come,
and what an earlier listing had is left out by a join.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATHS_SCHEMA = "path string"
#: Paths that the driver holds at once.
PIECE = 50_000


def _path(spark: SparkSession, name: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_roots(spark: SparkSession, folder: str) -> list:
    """The status of ``folder``, or of each path that it matches as a pattern."""
    p, fs = _path(spark, folder)
    found = fs.globStatus(fs.makeQualified(p))
    if found is None:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {folder}.")
    return list(found)


def _entries(fs, path) -> Iterator[tuple[str, bool]]:
    """(name, is a folder) of a folder's entries, as the store hands them out.

    Hadoop's own listing of a local folder is one array, so that is read by the system's.
    """
    if fs.getUri().getScheme() == "file":
        with os.scandir(path.toUri().getPath()) as entries:
            for e in entries:
                if e.is_dir() or e.is_file():
                    yield e.name, e.is_dir()
        return
    entries = fs.listStatusIterator(path)
    while entries.hasNext():
        status = entries.next()
        yield status.getPath().getName(), status.isDirectory()


def _readable(name: str) -> bool:
    """Spark's readers pass hidden files over, and Hadoop names that are not UTF-8."""
    if name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"):
        return False
    return not any("\ud800" <= c <= "\udfff" for c in name)


def folder_files(spark: SparkSession, folder: str) -> Iterator[str]:
    """The paths of a folder's files, those in partition folders (``column=value``) included, one at a time."""
    def below(fs, path):
        base = path.toString().rstrip("/")
        for name, is_folder in _entries(fs, path):
            if _readable(name):
                if not is_folder:
                    yield f"{base}/{name}"
                elif "=" in name:
                    yield from below(fs, _path(spark, f"{base}/{name}")[0])

    for root in folder_roots(spark, folder):
        path = root.getPath()
        if root.isDirectory():
            yield from below(_path(spark, path.toString())[1], path)
        else:
            yield path.toString()


def new_files(spark: SparkSession, folder: str, state: str, number: int, piece: int = PIECE) -> DataFrame:
    """The paths of the folder's files that no listing before ``number`` has seen.

    ``state`` keeps the folder's listing, and of every path seen a row as of
    this listing and as of the one before; asked again, a listing gives the
    same paths and what has come since.
    """
    found, seen = f"{state}/found", f"{state}/seen"
    files, mode = folder_files(spark, folder), "overwrite"
    while paths := list(islice(files, piece)):
        spark.createDataFrame([(p,) for p in paths], PATHS_SCHEMA).write.mode(mode).parquet(found)
        mode = "append"
    if mode == "overwrite":
        return spark.createDataFrame([], PATHS_SCHEMA)
    new = spark.read.schema(PATHS_SCHEMA).parquet(found)
    at, fs = _path(spark, seen)
    kept = [s.getPath() for s in fs.listStatus(at)] if fs.exists(at) else []
    before = sorted((n, p) for p in kept if (n := int(p.getName().split("=")[1])) < number)
    listed = new
    if before:
        old = spark.read.schema(PATHS_SCHEMA).parquet(before[-1][1].toString())
        new = new.join(old, "path", "left_anti")
        listed = old.unionByName(new)
    if not new.isEmpty():
        listed.repartition("path").write.mode("overwrite").parquet(f"{seen}/listing={number}")
        for _, p in before[:-1]:
            fs.delete(p, True)
    return new
