"""Landing exports: one JSON array per channel per day.

Layout: ``<base>/<YYYY-MM-DD>/<Channel>.json``.  A JSON array cannot be
split, so a file is read whole as one row and stays the unit of
parallelism and of atomicity: validation runs on the array with
higher-order functions (no shuffle), and only accepted files are
exploded into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanlytics import model

# Records are parsed as string maps first, so a missing key (absent from
# the map) differs from a null value (key present, value NULL).
RECORDS_TYPE = "array<map<string,string>>"

#: Records of an array file at most: the messages the exporter takes of a channel.
ARRAY_RECORDS = 100


def export_folder(base: str, date: str | None = None) -> str:
    return base.rstrip("/") + (f"/{date}" if date else "")


FILES_SCHEMA = "source_file string, part int, content string, scrape_date date"
_PARTS_SCHEMA = "value string, export_date date, export string, part int"


def read_export_files(spark: SparkSession, base: str, date: str | None = None) -> DataFrame:
    """(source_file, part, content, scrape_date) for each export file of one date (or all).

    Two layouts, side by side: the exporter's ``<date>/<Channel>.json``, an
    export in one file (part 0), and exports in parts as ``write_exports``
    leaves them, ``export_date=<date>/export=<Channel>/part=<n>``, whose
    source_file is ``<date>/<Channel>.json`` as well.  A folder that does not
    exist holds no files.
    """
    from chanlytics.operators.ingest import path_exists

    root = base.rstrip("/")
    out = spark.createDataFrame([], FILES_SCHEMA)
    if path_exists(spark, export_folder(root, date)):
        files = (spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
                 .text(export_folder(root, date), wholetext=True))
        path = F.col("_metadata.file_path")
        out = out.unionByName(files.select(
            path.alias("source_file"), F.lit(0).alias("part"), F.col("value").alias("content"),
            F.regexp_extract(path, DATE_FOLDER, 1).try_cast("date").alias("scrape_date")))
    days = f"{root}/export_date={date}" if date else f"{root}/export_date=*"
    if path_exists(spark, root if not date else days) and (date or _has_parts(spark, root)):
        parts = spark.read.schema(_PARTS_SCHEMA).option("basePath", root).text(days, wholetext=True)
        name = F.concat(F.col("export_date").cast("string"), F.lit("/"), "export", F.lit(".json"))
        out = out.unionByName(parts.select(name.alias("source_file"), "part", F.col("value").alias("content"),
                                           F.col("export_date").alias("scrape_date")))
    return out


# The scrape date of an export file is the date folder it was exported to.
DATE_FOLDER = r"/(\d{4}-\d{2}-\d{2})/[^/]+$"


def _has_parts(spark: SparkSession, root: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/export_date=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def parsed_json(text: Column, kind: str) -> Column:
    """``text`` parsed as one JSON value of the given type; NULL if it is anything else.

    A JSON reader stops at the end of the first value.  Two wrappings make
    what follows it count: inside an object, anything after the value breaks
    the object; inside an array, a second value makes a second element.
    """
    alone = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{kind}>")) == 1
    value = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {kind}")["v"]
    return F.when(alone, value)


def parse_export_files(files: DataFrame) -> DataFrame:
    """(source_file, [part, scrape_date,] records) where records is NULL for an unparsable file."""
    key = [c for c in ("source_file", "part", "scrape_date") if c in files.columns]
    return files.select(*key, parsed_json(F.col("content"), RECORDS_TYPE).alias("records"))


def array_files(export: DataFrame, records: int = ARRAY_RECORDS) -> DataFrame:
    """(source_file, part, content): the export as JSON arrays of at most so many records, in parts 0, 1, ...

    ``export``: rows with source_file (the channel's day) and source_pos, a
    record's own place in it.  The parts follow the order of source_pos, as
    do the records in them, with every key, NULL or not.  Only places are
    ranked over a whole channel-day; texts meet in their part.
    """
    places = export.select("source_file", "source_pos").distinct()
    rank = F.row_number().over(Window.partitionBy("source_file").orderBy("source_pos"))
    places = places.select(F.col("source_file").alias("__f"), F.col("source_pos").alias("__p"),
                           F.floor((rank - 1) / records).cast("int").alias("part"))
    record = F.to_json(F.struct(*model.EXPORT_KEYS), {"ignoreNullFields": "false"})
    rows = export.select("source_file", "source_pos", record.alias("j")).join(
        places, F.col("source_file").eqNullSafe(F.col("__f")) & F.col("source_pos").eqNullSafe(F.col("__p")))
    listed = rows.groupBy("source_file", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col("source_pos").alias("p"), "j"))).alias("r"))
    return listed.select("source_file", "part", F.concat(
        F.lit("["), F.array_join("r.j", ","), F.lit("]")).alias("content"))


def write_exports(files: DataFrame, base: str) -> None:
    """Array files as array_files makes them, each to a file of its own (I1, the exporter's layout in parts).

    source_file: ``<date>/<Channel>.json``.  A written day replaces only its own exports.
    """
    name = F.split("source_file", "/")
    (files.select(F.col("content").alias("value"), F.get(name, 0).alias("export_date"),
                  F.regexp_replace(F.get(name, 1), r"\.json$", "").alias("export"), "part")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1)
     .partitionBy("export_date", "export", "part").text(base))


def seals_folder(base: str) -> str:
    """Where the seals of a landing zone stand: beside it, as its own folders are data."""
    return base.rstrip("/") + "_seals"


SEAL_SCHEMA = "scrape_date date, channel string"


def seal_exports(exports: DataFrame, base: str) -> None:
    """Declares exports (scrape_date, channel) of the lines layout complete, however many files they have.

    A stream judges an export when its seal arrives, never by some of its
    files.  An export that is written again is sealed again.
    """
    (exports.select("scrape_date", "channel").distinct().coalesce(1)
     .write.mode("append").json(seals_folder(base)))


#: Text of a channel-day that one key of the landing writer's shuffle should hold.
CELL_BYTES = 16 << 20
_RECORD_BYTES = 200  # of a record besides its text


def _in_cells(rows: DataFrame) -> DataFrame:
    """Rows with a number, __cell, that deals large channel-days out evenly; the others have 0."""
    from chanlytics.session import stored

    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + _RECORD_BYTES)
    sizes = rows.groupBy("scrape_date", "channel").agg(F.ceil(size / CELL_BYTES).alias("__cells")).where("__cells > 1")
    large = stored(sizes, "sizes").withColumnsRenamed({"scrape_date": "__d", "channel": "__c"})
    own = F.col("scrape_date").eqNullSafe(F.col("__d")) & F.col("channel").eqNullSafe(F.col("__c"))
    cell = F.pmod(F.xxhash64(*rows.columns), F.coalesce("__cells", F.lit(1)))
    return rows.join(large, own, "left").select(*rows.columns, cell.alias("__cell"))


def write_landing(export: DataFrame, base: str, seal: bool = True, append: bool = False) -> None:
    """Write export rows to the landing zone as JSON lines, one folder per date and channel.

    Every key is written, NULL or not, with the record's place in the export
    (``source_pos``, when given).  Rebalancing gives a large channel-day
    several files of the advisory size; it can split what a task has read no
    further than by key, so such a channel-day has a key for each CELL_BYTES
    of text.  A re-export of the same day
    replaces only that day's channel folders (dynamic partition overwrite),
    as the reference overwrites a file.  When the data is written its exports
    are sealed.  An export that is written in several steps is appended to
    (``append``), and sealed by the caller at the end (``seal=False``,
    ``seal_exports``).
    """
    if "source_pos" not in export.columns:
        export = export.withColumn("source_pos", F.lit(None).cast("long"))
    cols = [c for c in model.EXPORT_KEYS if c != "channel"] + ["source_pos", "scrape_date", "channel"]
    rows = _in_cells(export.select(*cols)).hint("rebalance", "scrape_date", "channel", "__cell")
    (rows.drop("__cell")
     .write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "dynamic")
     .option("ignoreNullFields", "false").partitionBy("scrape_date", "channel").json(base))
    if seal:
        seal_exports(export, base)
