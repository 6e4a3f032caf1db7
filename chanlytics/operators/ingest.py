"""Ingest with insert-if-absent semantics.

* ``validate_export_files``  per-file accept/reject with a reason (I6)
* ``export_records``         accepted files -> typed rows with file position
* ``to_raw_messages``        export rows -> raw table rows (P16, P18, I7)
* ``new_rows``               first in batch and not yet stored (I3/I4)
* ``load_accounting``        recorded / skipped per file (I5)
* ``append_if_absent``       the writer: new rows, checkpoint, append
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.functions.text import message_length
from chanlytics.operators.keyed import KeyedTable, id_block
from chanlytics.operators.lookup import map_channel_with_fallback, map_literal
from chanlytics.operators.topk import latest_per_key


def _reason(r: Column, mapping: dict[str, str]) -> Column:
    """Rejection reason of a record (a map of its values as text); NULL = accepted."""
    def value(key: str) -> Column:
        return F.try_element_at(r, F.lit(key))

    def bad(key: str, kind: str) -> Column:
        return value(key).isNotNull() & value(key).try_cast(kind).isNull()

    missing = F.lit(False)
    for key in model.EXPORT_KEYS:
        missing = missing | ~F.map_contains_key(r, key)
    channel = value("channel")
    username = F.coalesce(F.try_element_at(map_literal(mapping), channel), channel)
    longest = F.greatest(F.length(channel), F.length(username))
    return (F.when(missing, "missing_key")
            .when(value("message_id").try_cast("bigint").isNull(), "bad_message_id")
            .when(channel.isNull(), "null_channel")
            .when(longest > model.VARCHAR_LIMIT, "value_too_long")
            .when(bad("date", "date"), "bad_date")
            .when(bad("views", "int") | bad("forwards", "int"), "bad_number")
            .when(bad("has_photo", "boolean"), "bad_boolean"))


def validate_export_files(parsed: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """(source_file, records, n_records, reason): reason NULL = accepted.

    Any bad record rejects its whole file, other files go on (I6).  Runs
    per file row with higher-order functions: no shuffle.
    """
    mapping = model.CHANNEL_USERNAMES if mapping is None else mapping
    reasons = F.filter(F.transform("records", lambda r: _reason(r, mapping)), lambda x: x.isNotNull())
    key = [c for c in ("source_file", "part", "scrape_date") if c in parsed.columns]
    return parsed.select(
        *key, "records",
        F.size("records").alias("n_records"),
        F.when(F.col("records").isNull(), F.lit("unparsable"))
         .otherwise(F.get(reasons, 0)).alias("reason"))


def export_verdicts(parts: DataFrame) -> DataFrame:
    """(source_file, n_records, reason) of files in parts: a bad part rejects its whole file.

    ``parts``: what validate_export_files makes of files with a part.  One
    unparsable part makes the file unparsable; else the first reason counts.
    """
    bad = F.when(F.col("reason").isNotNull(), F.col("part"))
    return parts.groupBy("source_file").agg(
        F.sum("n_records").cast("int").alias("n_records"),
        F.coalesce(F.max(F.when(F.col("reason") == "unparsable", F.col("reason"))),
                   F.min_by("reason", bad)).alias("reason"))


def accepted_parts(parts: DataFrame) -> DataFrame:
    """Parts of the accepted files, with the place of their first record in the file (first_pos).

    Verdicts and places go by rows without records; each part's records stay
    where they are.
    """
    ok = export_verdicts(parts).where("reason is null").select("source_file")
    before = Window.partitionBy("source_file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("source_file", "part", "n_records").join(ok, "source_file").select(
        "source_file", "part", F.coalesce(F.sum("n_records").over(before), F.lit(0)).alias("first_pos"))
    return parts.join(first, ["source_file", "part"])


def export_records(validated: DataFrame) -> DataFrame:
    """Accepted files -> one typed row per record, with (source_file, source_pos).

    Files in parts: as accepted_parts gives them.
    """
    ok = validated.filter(F.col("reason").isNull())
    first = F.col("first_pos") if "first_pos" in validated.columns else F.lit(0)
    more = [c for c in ("scrape_date",) if c in validated.columns]
    rows = ok.select("source_file", *more, first.alias("first_pos"), F.posexplode("records").alias("source_pos", "r"))
    return rows.select(*_typed(F.col("r")), "source_file",
                       (F.col("source_pos") + F.col("first_pos")).cast("long").alias("source_pos"), *more)


def _typed(r: Column) -> list[Column]:
    """The export columns of an accepted record."""
    return [r.getItem(f.name).cast(f.dataType).alias(f.name) for f in model.EXPORT_SCHEMA.fields]


def to_raw_messages(export: DataFrame, scrape_date: "dt.date | Column",
                    mapping: "dict[str, str] | DataFrame | None" = None) -> DataFrame:
    """Export rows -> the raw messages table rows (+ source_file, source_pos).

    ``scrape_date`` is the run date, a parameter (I7) so reruns repeat.
    """
    mapping = model.CHANNEL_USERNAMES if mapping is None else mapping
    sd = scrape_date if isinstance(scrape_date, Column) else F.lit(scrape_date).cast("date")
    mapped = map_channel_with_fallback(export, mapping, "channel")
    return mapped.select(
        "message_id",
        F.col("channel").alias("channel_name"),
        "channel_username",
        sd.alias("scrape_date"),
        F.col("date").alias("message_date"),
        F.col("text").alias("message_text"),
        message_length("text").alias("message_length"),
        "views", "forwards", "has_photo", "photo_path",
        "source_file", "source_pos",
    )


def first_rows(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """In-batch first write wins: the first row of every key under ``order``.

    Planned as a ``WindowGroupLimit``: every map task keeps one row per key
    before the shuffle, so a key repeated in a third of the batch costs one
    row per task, not a third of the batch in one task.
    """
    return latest_per_key(batch, keys, order)


def new_rows(batch: DataFrame, target_keys: DataFrame, keys: list[str],
             order: list[Column]) -> DataFrame:
    """Rows an ``INSERT ... ON CONFLICT DO NOTHING`` of the batch would add.

    The batch is evaluated once; the anti join against the stored keys (key
    columns only) uses the partitioning that the first-row step has made.
    """
    return first_rows(batch, keys, order).join(target_keys.select(*keys), keys, "left_anti")


def load_accounting(batch: DataFrame, new: DataFrame, file_col: str = "source_file",
                    files: DataFrame | None = None) -> DataFrame:
    """(source_file, recorded, skipped) per file.

    recorded = new rows from the file, skipped = the file's other rows.
    Both are partial aggregates per file; ``files`` adds files with no
    rows as 0/0.
    """
    total = batch.groupBy(file_col).agg(F.count(F.lit(1)).alias("__n"))
    rec = new.groupBy(file_col).agg(F.count(F.lit(1)).alias("recorded"))
    acc = total.join(rec, file_col, "left").select(
        file_col, F.coalesce("recorded", F.lit(0)).cast("long").alias("recorded"),
        (F.col("__n") - F.coalesce("recorded", F.lit(0))).cast("long").alias("skipped"))
    if files is not None:
        acc = (files.select(file_col).distinct().join(acc, file_col, "left")
               .select(file_col, F.coalesce("recorded", F.lit(0)).cast("long").alias("recorded"),
                       F.coalesce("skipped", F.lit(0)).cast("long").alias("skipped")))
    return acc


# ---------------------------------------------------------------------------
# Writers
# ---------------------------------------------------------------------------

def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table's own columns (a keyed table has a block column besides); an absent table is empty."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return spark.createDataFrame([], schema)


def write_partition(df: DataFrame, path: str, column: str, value) -> None:
    """Write ``df`` as the ``column=value`` partition of a table, replacing only it.

    Dynamic partition overwrite: a retried run rewrites its own partition
    instead of appending a second copy.
    """
    (df.withColumn(column, F.lit(value)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))


# The block of a key: message ids lie close together in a day's batch.  Ids of
# detections and paths of images hold the message id after the channel.
_NAMED_ID = "try_cast(regexp_extract({}, '[^/_]*_([0-9]{{1,18}})[^/]*$', 1) AS BIGINT)"
KEY_BLOCKS = {
    "message_id": id_block("message_id"),
    "detection_id": id_block(_NAMED_ID.format("detection_id")),
    "image_path": id_block(_NAMED_ID.format("image_path")),
}


def keyed_table(spark: SparkSession, path: str, schema, keys: list[str], buckets: int | None = None) -> KeyedTable:
    """The stored table of a key (its first column decides the block)."""
    return KeyedTable(spark, path, schema, tuple(keys), KEY_BLOCKS.get(keys[0], "0"), buckets)


def append_if_absent(spark: SparkSession, batch: DataFrame, target_path: str, schema,
                     keys: list[str], order: list[Column], before_append=None, totals: dict | None = None) -> DataFrame:
    """Append the new rows of ``batch`` to the keyed table at ``target_path``.

    Returns the appended rows.  They are stored below the shared checkpoint
    folder before the append, so they cannot change when the target grows,
    and a retried run finds them in the target and appends nothing twice.
    ``before_append(new)`` runs between the two, so what it records cannot
    be lost to a crash after the append.  ``totals`` receives the numbers of
    rows, recorded and skipped (I5), observed in the jobs that run anyway.
    Two concurrent writers to one table are not supported.
    """
    from chanlytics.session import stored

    target = keyed_table(spark, target_path, schema, keys)
    totals = {} if totals is None else totals
    new = stored(target.absent(batch, order, totals), "new_rows")
    if before_append is not None:
        before_append(new)
    target.append(new, totals)
    totals["skipped"] = totals["rows"] - totals["recorded"]
    return new


def _load(spark: SparkSession, raw: DataFrame, raw_path: str, accounting_path: str | None,
          run_date: dt.date, files: DataFrame | None, totals: dict | None = None) -> DataFrame:
    """Append ``raw``; the accounting per file, stored before the append under a run id of its own."""
    import uuid

    run_id = uuid.uuid4().hex

    def record(new: DataFrame) -> None:
        if accounting_path:
            (load_accounting(raw, new, files=files)
             .withColumns({"run_date": F.lit(run_date).cast("date"), "run_id": F.lit(run_id)})
             .write.mode("append").partitionBy("run_date", "run_id").parquet(accounting_path))

    new = append_if_absent(spark, raw, raw_path, model.RAW_MESSAGES_SCHEMA, model.RAW_MESSAGES_KEY,
                           [F.col("source_file"), F.col("source_pos")], record, totals)
    return load_accounting(raw, new, files=files)


def judge_exports(files: DataFrame, mapping: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(typed records, accepted exports, rejected exports) of array files.

    The one rule of the loader, the stream and the queries: an export is all
    its parts, and a bad record in any of them rejects it whole (I6).  The
    parts are parsed and checked once and stored.
    """
    from chanlytics.session import stored
    from chanlytics.sources.exports import parse_export_files

    parts = stored(validate_export_files(parse_export_files(files), mapping), "exports")
    verdicts = export_verdicts(parts)
    rejected = verdicts.where("reason is not null").select("source_file", "n_records", "reason")
    accepted = verdicts.where("reason is null").select("source_file")
    return export_records(accepted_parts(parts)), accepted, rejected


def load_exports(spark: SparkSession, base: str, run_date: dt.date | None, raw_path: str,
                 quarantine_path: str | None = None, mapping: dict[str, str] | None = None,
                 accounting_path: str | None = None, totals: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Load one day's exports into the raw table (the loader job); run_date None: all days, each with its own date.

    Returns (accounting per export, rejected exports).  Rejected exports are
    written to ``quarantine_path`` when given, the accounting of each run
    to ``accounting_path``, the run's totals to the dict ``totals``.  A day
    without a folder loads nothing.
    """
    from chanlytics.sources.exports import read_export_files

    files = read_export_files(spark, base, run_date.isoformat() if run_date else None)
    records, accepted, rejected = judge_exports(files, mapping)
    if quarantine_path:
        write_partition(rejected, quarantine_path, "run_date", run_date)
    raw = to_raw_messages(records, run_date or F.col("scrape_date"), mapping)
    return _load(spark, raw, raw_path, accounting_path, run_date, accepted, totals), rejected


LINES_SCHEMA = "value string, scrape_date date, channel string"


def read_landing_day(spark: SparkSession, base: str, run_date: "dt.date | list[dt.date] | None" = None) -> DataFrame:
    """One day (or some, or all) of the JSON-lines landing layout: value, scrape_date, channel.

    Splittable input: a large day is read by many tasks.  ``channel`` and
    ``scrape_date`` come from the partition folders and have declared types.
    A day without a folder has no rows.
    """
    root = base.rstrip("/")
    days = run_date if isinstance(run_date, list) else [run_date]
    paths = [root + (f"/scrape_date={d.isoformat()}" if d else "") for d in days]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], LINES_SCHEMA)
    return spark.read.schema(LINES_SCHEMA).option("basePath", base).text(paths)


def check_landing_rows(rows: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """(source_file, scrape_date, r, source_pos, reason) of landing lines; reason NULL = the line is fine.

    Same record rules as ``validate_export_files``: values as text, every
    key present (the channel is the folder's), a line that is not one JSON
    object is 'unparsable'.  A channel's day is one export, however many
    files hold it: source_file = <scrape_date>/<channel>.
    """
    from chanlytics.sources.exports import parsed_json

    mapping = model.CHANNEL_USERNAMES if mapping is None else mapping
    record = parsed_json(F.col("value"), "map<string,string>")
    own = F.map_concat(F.map_filter(record, lambda k, _: k != "channel"),
                       F.create_map(F.lit("channel"), F.col("channel")))
    parsed = rows.select(F.concat_ws("/", F.col("scrape_date").cast("string"), "channel").alias("source_file"),
                         "scrape_date", own.alias("r"))
    return parsed.select("source_file", "scrape_date", "r",
                         F.try_element_at("r", F.lit("source_pos")).try_cast("long").alias("source_pos"),
                         F.when(F.col("r").isNull(), "unparsable").otherwise(_reason(F.col("r"), mapping)).alias("reason"))


def split_checked_rows(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted typed export rows, rejected exports with a reason).

    Any bad line rejects its whole export: the bad ones are found with a
    partial aggregate per export and removed with an anti join.  They are
    stored first, so the join goes by their real size and the lines of the
    others, a few exports at times, are not dealt out by export.
    """
    from chanlytics.session import stored

    bad_files = stored(checked.filter(F.col("reason").isNotNull()).groupBy("source_file")
                       .agg(F.min("reason").alias("reason"), F.count(F.lit(1)).alias("n_bad_records")), "rejected")
    ok = checked.filter(F.col("reason").isNull()).join(
        bad_files.select("source_file"), "source_file", "left_anti")
    return ok.select(*_typed(F.col("r")), "source_file", "source_pos", "scrape_date"), bad_files


def validate_landing_rows(rows: DataFrame, mapping: dict[str, str] | None = None
                          ) -> tuple[DataFrame, DataFrame]:
    """(accepted typed export rows, rejected exports) for JSON-lines input."""
    return split_checked_rows(check_landing_rows(rows, mapping))


def load_landing_day(spark: SparkSession, base: str, run_date: dt.date, raw_path: str,
                     quarantine_path: str | None = None, mapping: dict[str, str] | None = None,
                     accounting_path: str | None = None, totals: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """The loader for the JSON-lines landing layout: (accounting per export, rejected exports).

    The day's lines are parsed and checked once and stored; every later step
    reads that.  In-batch first write wins by (export, place in
    it), as in the array layout.
    """
    def keep(rejected: DataFrame) -> None:
        if quarantine_path:
            write_partition(rejected, quarantine_path, "run_date", run_date)

    raw, rejected = judge_landing(read_landing_day(spark, base, run_date), mapping, keep)
    return _load(spark, raw, raw_path, accounting_path, run_date, None, totals), rejected


def judge_landing(rows: DataFrame, mapping: dict[str, str] | None = None, keep_rejected=None) -> tuple[DataFrame, DataFrame]:
    """(raw rows, rejected exports) of landing lines, parsed and checked once and stored.

    The one rule of the loader and the stream.  ``keep_rejected(rejected)``
    runs before any row is stored.
    """
    from chanlytics.session import stored

    typed, rejected = split_checked_rows(stored(check_landing_rows(rows, mapping), "lines"))
    if keep_rejected is not None:
        keep_rejected(rejected)
    return to_raw_messages(typed, F.col("scrape_date"), mapping), rejected


def new_images(images: DataFrame, processed: DataFrame, path_col: str = "image_path") -> DataFrame:
    """Images whose path is not yet processed."""
    return images.join(processed.select(path_col), path_col, "left_anti").select(*images.columns)
