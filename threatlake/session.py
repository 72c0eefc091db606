"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (all domain timestamps are stored as
# TIMESTAMP_NTZ in UTC), adaptive execution for runtime re-planning (partition
# coalescing, size-checked broadcast conversion, skew-join splitting).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "threatlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster, ``master`` stays None and the submitter's settings win; the shuffle
    partition count is only set when asked (tests use 8 for ``local[8]``).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Cluster jobs must find it set by the submitter (it has to be on shared storage that
    survives executor loss). Only when it is unset — local runs and tests — a private
    scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="threatlake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core confs may be read-only at runtime; the context keeps it
            pass
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def few_listing_tasks(spark: SparkSession) -> None:
    """Folders and files are listed by four tasks a core; the default is a task for each of up to 10,000 paths."""
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
