"""Incremental ingest as file streams.

The file source remembers which files it has seen (in the checkpoint);
of image files, which are many, a table there does.  Each micro-batch
runs the same batch operator as the daily job inside ``foreachBatch``.  The state that matters - which keys are stored - lives
in the target table (insert-if-absent), so nothing grows in a state store
and a retried micro-batch appends nothing twice.  No watermark: as in the
reference, a message of any date is accepted at any time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chanlytics import model
from chanlytics.operators import ingest as I
from chanlytics.sources.exports import DATE_FOLDER, SEAL_SCHEMA, export_folder, seals_folder


def start_export_ingest(spark: SparkSession, landing_base: str, raw_path: str,
                        checkpoint_path: str, quarantine_path: str | None = None,
                        mapping: dict[str, str] | None = None,
                        available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """New export files -> validated, insert-if-absent into the raw table.

    For the exporter's layout, where an export is one file, which is complete
    when it appears.
    """
    stream = (spark.readStream.option("wholetext", "true").option("pathGlobFilter", "*.json")
              .option("recursiveFileLookup", "true").text(export_folder(landing_base)))
    path = F.col("_metadata.file_path")
    files = stream.select(path.alias("source_file"), F.lit(0).alias("part"), F.col("value").alias("content"),
                          F.to_date(F.regexp_extract(path, DATE_FOLDER, 1)).alias("scrape_date"))

    def ingest_batch(batch: DataFrame, epoch_id: int) -> None:
        records, _, rejected = I.judge_exports(batch, mapping)
        if quarantine_path:
            # a retried micro-batch rewrites its own epoch partition
            I.write_partition(rejected, quarantine_path, "epoch_id", epoch_id)
        raw = I.to_raw_messages(records, F.col("scrape_date"), mapping)
        I.append_if_absent(batch.sparkSession, raw, raw_path, model.RAW_MESSAGES_SCHEMA,
                           model.RAW_MESSAGES_KEY, [F.col("source_file"), F.col("source_pos")])

    return _start(files.writeStream.foreachBatch(ingest_batch), checkpoint_path, available_now, processing_time)


def _start(writer, checkpoint_path: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint_path)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time or "1 minute").start()


def start_landing_ingest(spark: SparkSession, landing_base: str, raw_path: str,
                         checkpoint_path: str, quarantine_path: str | None = None,
                         mapping: dict[str, str] | None = None,
                         available_now: bool = True,
                         processing_time: str | None = None) -> StreamingQuery:
    """T1 for the splittable JSON-lines landing layout (``write_landing``).

    An export may have many files, which arrive one after the other, and a
    bad line in any of them rejects it whole.  So the stream is of seals: a
    micro-batch reads the exports whose seals have arrived, all their files,
    and judges them as the batch loader does (``judge_landing``).  Files
    without a seal wait.  Nothing is kept between micro-batches, and a
    retried one reads and appends the same.
    """
    seals = spark.readStream.schema(SEAL_SCHEMA).json(seals_folder(landing_base))

    def ingest_batch(batch: DataFrame, epoch_id: int) -> None:
        own = batch.select("scrape_date", "channel").where("scrape_date is not null").distinct().checkpoint()
        days = [r.scrape_date for r in own.select("scrape_date").distinct().collect()]
        if not days:
            return
        rows = I.read_landing_day(batch.sparkSession, landing_base, sorted(days))
        rows = rows.join(own, ["scrape_date", "channel"], "left_semi").select("value", "scrape_date", "channel")

        def keep(rejected: DataFrame) -> None:
            if quarantine_path:
                I.write_partition(rejected, quarantine_path, "epoch_id", epoch_id)

        raw, _ = I.judge_landing(rows, mapping, keep)
        I.append_if_absent(batch.sparkSession, raw, raw_path, model.RAW_MESSAGES_SCHEMA,
                           model.RAW_MESSAGES_KEY, [F.col("source_file"), F.col("source_pos")])

    return _start(seals.writeStream.foreachBatch(ingest_batch), checkpoint_path, available_now, processing_time)


def start_image_scoring(spark: SparkSession, image_dir: str, scorer, detections_path: str,
                        checkpoint_path: str, scan_log_path: str | None = None,
                        mapping=None, run_ts=None, available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """New image files -> scored -> detections appended insert-if-absent.

    A file source keeps each path of its folder in the driver several times
    over, so the stream is a clock's: a micro-batch lists the folder in pieces
    and scores the files that no earlier one has listed (``new_files``, below
    the checkpoint).  A retried one does the same again, and what it has
    stored already is skipped.

    Detections carry the time (UTC) at which their micro-batch ran, or
    ``run_ts`` if one is given.
    """
    from chanlytics.operators.detect import image_files_filter, run_detection
    from chanlytics.sources.folders import folder_roots, new_files

    folder_roots(spark, image_dir)  # an absent folder is the caller's error, not the stream's
    state = checkpoint_path.rstrip("/")
    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        now = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        images = new_files(batch.sparkSession, image_dir, f"{state}/images", epoch_id)
        run_detection(batch.sparkSession, images.filter(image_files_filter("path")), scorer,
                      detections_path, now, scan_log_path, mapping)

    return _start(clock.writeStream.foreachBatch(score_batch), f"{state}/clock", available_now, processing_time)
