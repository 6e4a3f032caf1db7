"""SparkSession helpers.

Library code never builds its own session: it takes the caller's.  The
helpers here are for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for repeatable results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "chanlytics") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the library needs to a caller's session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    tasks = listing_tasks(spark)
    if tasks is not None:
        spark.conf.set(LISTING_CONF, tasks)
    return spark


def listing_tasks(spark: SparkSession) -> str | None:
    """A few tasks a slot for listing many files; the default is one a path, 10,000 at most."""
    try:
        return str(4 * spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - Spark Connect: the server's default stays
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is always used as
    given.  Only on a local master, when it is unset, is a private folder
    made; on any other master that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server side owns checkpoints
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="chanlytics-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: a checkpoint that is compressed and by column."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``chanlytics`` importable in Python workers (``addPyFile`` of a zip).

    Needed by the operators that run Python on executors (``mapInPandas``);
    done once per SparkContext.
    """
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: ship with addArtifacts instead
        sc = None
    key = sc.applicationId if sc is not None else "connect"
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="chanlytics-pkg-"), "chanlytics.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(key)
