"""The daily job - ingest, detect, stage, model, test.

One Spark application runs the steps in order; each mart is written as a
parquet table (full rebuild, I8) and read back for the next step, so
lineage is cut at every table and a lost executor costs at most the step
in progress.

A rebuild goes to folders of its own version.  When all of them are written,
the run is published: the named tables are pointed at the new version one by
one, so a reader of a name always sees one complete table, the old one or
the new.  Old versions stay until ``drop_old_versions``.  Staging is a
persistent view (I9) over the raw messages.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from chanlytics import model
from chanlytics.operators import ingest as I
from chanlytics.operators import quality as Q
from chanlytics.operators.search_index import write_postings
from chanlytics.plans import marts as M
from chanlytics.plans.staging import stage_messages, staging_sql


@dataclass
class Layout:
    """Where the tables of one deployment live (a shared warehouse folder)."""

    warehouse: str
    landing: str
    images: str | None = None
    # "array": one JSON array per channel and day (the exporter's files);
    # "lines": the splittable JSON-lines layout written by write_landing
    landing_format: str = "array"
    database: str = "marts"
    # trigram postings of fct_messages are built with it, for searches that read few files
    search_postings: bool = False

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"

    def version(self, name: str, run: str) -> str:
        return f"{self.table(name)}/version-{run}"


@dataclass
class RunResult:
    accounting: DataFrame
    rejected_files: DataFrame
    checks: DataFrame
    tables: dict[str, str] = field(default_factory=dict)
    reports: dict[str, str] = field(default_factory=dict)
    totals: dict[str, int] = field(default_factory=dict)  # rows, recorded, skipped of the load


#: Tables that every run builds anew, in versions.
MARTS = ("dim_channels", "dim_dates", "fct_messages", "fct_image_detections")
#: Built with the marts where the layout asks for it.
POSTINGS = "fct_message_trigrams"


def new_run() -> str:
    """A name for a run's versions; later runs sort later."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def write_table(df: DataFrame, path: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Full rebuild of a table (overwrite), read back to cut the lineage.

    ``cluster_by`` sorts each task's rows before writing (no shuffle), so
    the parquet row groups hold narrow ranges of those columns and the
    reports' pushed-down equality filters skip most of them.
    """
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def side_by_side(spark: SparkSession, steps: list[Callable]) -> list:
    """What the steps return; their jobs run at once, so one fills the slots that another's last tasks leave.

    The steps must not need each other.  All of them end before an error of one is raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        # the caller's job group and tags are the steps' too; without pinned threads this gives the session back
        own = [inheritable_thread_target(spark) for _ in steps]
        running = [pool.submit(step if wrap is spark else wrap(step)) for wrap, step in zip(own, steps)]
    return [r.result() for r in running]


def build_marts(spark: SparkSession, raw_messages: DataFrame, raw_detections: DataFrame,
                layout: Layout, run: str | None = None) -> dict[str, DataFrame]:
    """Stage and model into a version of its own, which is not published yet; dimensions first, so the fact joins read small stored tables."""
    run = run or new_run()
    staging = stage_messages(raw_messages)
    dim_channels = write_table(M.build_dim_channels(staging), layout.version("dim_channels", run))
    dim_dates = write_table(M.build_dim_dates(staging), layout.version("dim_dates", run))
    # clustered for the reports: channel activity filters channel_sk,
    # detections-by-message filters message_sk
    fct_messages = write_table(M.build_fct_messages(staging, dim_channels, dim_dates),
                               layout.version("fct_messages", run), ["channel_sk", "message_date_sk"])
    fct_det = write_table(M.build_fct_image_detections(raw_detections, fct_messages),
                          layout.version("fct_image_detections", run), ["message_sk"])
    if layout.search_postings:
        write_postings(spark, layout.version("fct_messages", run), layout.version(POSTINGS, run))
    return {
        "raw_messages": raw_messages,
        "raw_image_detections": raw_detections,
        "stg_messages": staging,
        "dim_channels": dim_channels,
        "dim_dates": dim_dates,
        "fct_messages": fct_messages,
        "fct_image_detections": fct_det,
    }


def run_daily(spark: SparkSession, layout: Layout, run_date: dt.date, scorer=None,
              mapping: dict[str, str] | None = None) -> RunResult:
    """Ingest the day's exports, score new images, rebuild the marts, run the checks, publish."""
    from chanlytics.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    run, totals = new_run(), {}
    raw_path = layout.table("raw_messages")
    det_path = layout.table("raw_image_detections")
    loader = I.load_landing_day if layout.landing_format == "lines" else I.load_exports
    accounting, rejected = loader(spark, layout.landing, run_date, raw_path,
                                  layout.table("quarantine_files"), mapping,
                                  layout.table("load_accounting"), totals)
    if scorer is not None and layout.images:
        from chanlytics.operators.detect import list_images, run_detection

        run_detection(spark, list_images(spark, layout.images), scorer, det_path,
                      dt.datetime.combine(run_date, dt.time()), layout.table("image_scan_log"),
                      mapping)
    raw_messages = I.read_table(spark, raw_path, model.RAW_MESSAGES_SCHEMA)
    raw_detections = I.read_table(spark, det_path, model.RAW_DETECTIONS_SCHEMA)
    tables = build_marts(spark, raw_messages, raw_detections, layout, run)
    checks, reports = side_by_side(spark, [
        lambda: write_table(Q.run_checks(tables), layout.table(f"test_results/run_date={run_date}")),
        lambda: write_reports(tables, layout, run)])
    publish(spark, layout, run)
    paths = {k: layout.version(k, run) if k in MARTS else layout.table(k) for k in tables if not k.startswith("stg")}
    return RunResult(accounting, rejected, checks, paths, reports, totals)


def write_reports(tables: dict[str, DataFrame], layout: Layout, run: str) -> dict[str, str]:
    """The reports without arguments, stored as the last step of a run."""
    from chanlytics.plans import reports as R

    fm, dc, dd = tables["fct_messages"], tables["dim_channels"], tables["dim_dates"]
    made = {
        "top_products": R.top_products(fm),
        "list_channels": R.list_channels(dc),
        "daily_volume": R.daily_volume(fm, dd),
        "visual_share": R.visual_share(fm, dc),
        "object_mix": R.object_mix(tables["fct_image_detections"], fm),
    }
    paths = {name: layout.version(f"reports/{name}", run) for name in made}
    side_by_side(fm.sparkSession, [lambda df=df, path=paths[name]: df.write.mode("overwrite").parquet(path)
                                   for name, df in made.items()])
    return paths


REPORTS = ("top_products", "list_channels", "daily_volume", "visual_share", "object_mix")


def publish(spark: SparkSession, layout: Layout, run: str) -> None:
    """Makes a run's versions the current ones: a marker in the warehouse, then the names."""
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(layout.table(f"_published/{run}"))
    create_tables(spark, layout)


def _runs(spark: SparkSession, layout: Layout) -> list[str]:
    """The published runs, oldest first."""
    folder = layout.table("_published")
    if not I.path_exists(spark, folder):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().getName() for f in found)


def create_tables(spark: SparkSession, layout: Layout, database: str | None = None) -> None:
    """The stored tables under names, for SQL; what is absent is created, what has a newer version follows it.

    Raw tables and staging are views over the keyed tables.  The marts and
    reports are tables over the folders of the last published run.
    """
    db = database or layout.database
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{layout.table('_database')}'")
    stored = {"raw_messages": (model.RAW_MESSAGES_SCHEMA, model.RAW_MESSAGES_KEY),
              "raw_image_detections": (model.RAW_DETECTIONS_SCHEMA, model.RAW_DETECTIONS_KEY)}
    for name, (schema, keys) in stored.items():
        keyed = I.keyed_table(spark, layout.table(name), schema, keys)
        keyed.ensure()
        columns = ", ".join(f"`{c}`" for c in schema.names)
        spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{name}` AS SELECT {columns} FROM {keyed.name}")
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`stg_messages` AS {staging_sql(f'`{db}`.`raw_messages`')}")
    runs = _runs(spark, layout)
    if not runs:
        return
    marts = MARTS + ((POSTINGS,) if I.path_exists(spark, layout.version(POSTINGS, runs[-1])) else ())
    for name, folder in [(n, n) for n in marts] + [(f"report_{n}", f"reports/{n}") for n in REPORTS]:
        path = layout.version(folder, runs[-1])
        if not spark.catalog.tableExists(f"{db}.{name}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{name}` ({columns}) USING parquet LOCATION '{path}'")
        else:
            spark.sql(f"ALTER TABLE `{db}`.`{name}` SET LOCATION '{path}'")
            spark.catalog.refreshTable(f"{db}.{name}")


def drop_old_versions(spark: SparkSession, layout: Layout, keep: int = 2) -> list[str]:
    """Deletes the folders of published runs but the last ``keep``; the names of the runs that went."""
    old = _runs(spark, layout)[:-keep] if keep > 0 else []
    for run in old:
        for path in [layout.version(n, run) for n in (*MARTS, POSTINGS, *(f"reports/{r}" for r in REPORTS))] + [layout.table(f"_published/{run}")]:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return old
