"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests, bench and the entry points."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the cluster's ``spark.checkpoint.dir``.

    The setting is read from the session.  Only when it is unset on a local
    master (tests) a fresh scratch folder is created and registered; a cluster
    without the setting is an error, since its executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        conf = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the session's file system has ``path`` (any scheme it knows)."""
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of everything below ``path``."""
    p, fs = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


__all__ = ["local_session", "shared_dir", "scratch_path", "path_exists", "stored_bytes"]
