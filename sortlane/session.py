"""Session helpers: a local session for tests/bench and the shared work folder.

Lineage is cut with reliable ``checkpoint()`` and staged tables, both under the
folder named by ``spark.checkpoint.dir``.  On a cluster that setting must point
at shared storage; it is only filled in here when it is unset and Spark runs in
local mode (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sortlane") -> SparkSession:
    """A local session configured the way tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SORTLANE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    Reads ``SparkContext.getCheckpointDir()`` first, then the
    ``spark.checkpoint.dir`` setting.  When neither is set, a fresh folder is
    made only in local mode; on a cluster a machine-local folder would not be
    visible to other executors, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; point it at shared storage "
                "(HDFS/S3/ABFS) visible to every executor"
            )
        configured = tempfile.mkdtemp(prefix="sortlane-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for staged tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/work/{name}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store Spark reaches; a missing folder has none.

    Only a missing path counts as empty: any other storage error is raised.
    """
    fs, where = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Files of a table with sizes and times of change: differs when the table was rewritten."""
    fs, where = _folder(spark, path)
    files = fs.listStatus(where)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that its owner no longer needs."""
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
