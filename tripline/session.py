"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tripline job relies on.  Dates, hours and weekdays are derived
# in the session time zone, so it is pinned; ANSI stays on (try_divide /
# try_cast are used where a NULL is the intended answer); AQE re-plans joins
# and coalesces shuffle partitions from measured sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tripline",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as is.  When it is unset, a local session gets a fresh folder; any other
    master is an error, as executors would write to disks of their own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            current = None
    if not current:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tripline-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(current)
        except Exception:
            pass
        spark.conf.set("spark.checkpoint.dir", current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused output folder under the shared checkpoint folder.
    The driver's file system removes it when the application ends; frames read
    from it are lazy, so it cannot go earlier."""
    path = f"{ensure_checkpoint_dir(spark)}/tripline-out/{name}-{uuid.uuid4().hex[:12]}"
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:  # Spark Connect has no gateway: the folder stays there
        folder = jvm.org.apache.hadoop.fs.Path(path)
        storage = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        storage.mkdirs(folder)
        storage.deleteOnExit(folder)
    return path
