"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers are for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes (see README "Session").
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "histevents") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    master = master or os.environ.get("HISTEVENTS_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HISTEVENTS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only where it is unset and all tasks run in this process (master
    ``local[..]``, as in tests) a scratch folder of this machine is created:
    elsewhere each executor would write to a disk of its own and a table read
    back would be incomplete, so that is an error."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="histevents-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)  # the context keeps it: the setting itself is fixed when a session starts
    return current


def _hadoop_path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store; other faults raise."""
    where, fs = _hadoop_path(spark, path)
    return bool(fs.exists(where))


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, in whatever store."""
    where, fs = _hadoop_path(spark, pattern)
    return [str(found.getPath()) for found in fs.globStatus(where) or []]


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """The files of no bytes that a path or pattern names: Spark's readers pass
    over them.  Empty files inside a folder are parts without rows."""
    where, fs = _hadoop_path(spark, path)
    return [str(f.getPath()) for f in fs.globStatus(where) or [] if f.isFile() and not f.getLen()]


def touch_path(spark: SparkSession, path: str) -> None:
    """Write an empty marker file."""
    where, fs = _hadoop_path(spark, path)
    fs.create(where, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    where, fs = _hadoop_path(spark, path)
    fs.delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def staged(df, name: str):
    """``df`` written once to the shared folder and read back: what follows
    reads the files, also after an executor is lost."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
