"""Session settings and the shared scratch area.

Everything that has to survive an executor loss (stream checkpoints,
bronze tables written by a query, versioned SCD2 stores) is written under
the folder the cluster names in ``spark.checkpoint.dir``.  Only a local
session (unit tests, a bare laptop) may leave it unset.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library should run with.  Shuffle
# partition count is left to the caller / cluster; AQE coalesces small
# partitions and splits skewed ones at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# How jobs that write tables run.
JOB_CONF = {
    # Rows for two folders (passed and failed) go to two open files instead of being sorted by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    # A table's shuffle files go when it is written, not when the driver's garbage collector comes by.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# Scans whose rows are sorted on their way (feeds, Bronze, Silver): compressed columns take a few bytes for
# a row of some 200 in memory, so a task's rows fit its share and its sort doesn't spill.
SORTED_SCANS = {"spark.sql.files.maxPartitionBytes": str(16 << 20)}


@contextmanager
def settings(spark: SparkSession, conf: dict):
    """``conf`` holds inside; what the caller has set stays as it is."""
    mine = {k: v for k, v in conf.items() if spark.conf.get(k, None) is None}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def in_parallel(fn, names, workers: int) -> dict:
    """``fn(name)`` for each name, ``workers`` at a time: independent jobs go together, so small ones share the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {n: pool.submit(fn, n) for n in names}
        return {n: f.result() for n, f in futures.items()}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster run, sized from the bytes a job reads.

    The shuffle starts with enough partitions for ~``target_partition_bytes``
    each (never fewer than 200); AQE then coalesces small ones to the
    advisory size and splits skewed ones.  Scans split files at the same
    size, so a task's input fits executor memory.
    """
    parts = max(200, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # runtime broadcast only for join sides measured below 64 MB
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str = "local[8]", app: str = "godown", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session.  Only a ``local`` session, whose executors are
    the driver itself, may leave it unset and gets a folder of its own; on a
    cluster that would be a place other machines don't see, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="godown-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique (not yet existing) folder under the checkpoint root for one run."""
    return "/".join([checkpoint_root(spark), "godown", *parts, uuid.uuid4().hex[:12]])


def written(df: DataFrame, *name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: evaluated once, and its lineage ends here."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, *name)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
