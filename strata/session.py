"""Session settings and the shared scratch location.

Scratch output (stream sinks, checkpoints, rebuilt tables) always goes under
the folder the cluster names in ``spark.checkpoint.dir``: on a cluster that is
shared storage every executor and a restarted driver can reach.  Only when the
setting is absent (local tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata job relies on.  UTC keeps event instants stable, AQE
# re-plans joins and coalesces partitions from runtime statistics, and the
# skew-join split handles a key that holds a large share of the rows.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


# Sizing for a large cluster (hundreds of executors, tens of TB per run).
# Many shuffle partitions up front and AQE coalescing them to ~256 MB keeps
# every reduce task within executor memory at any volume; scan splits of
# 256 MB keep the task count of a 100 TB scan around 400 k; a skewed
# partition is split when it is 5x the median and over 512 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names it.  Where that is unset, a local folder is
    made on a local master only (tests); on a cluster the driver's disk is out
    of the executors' reach, so this raises.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of a location, as Spark itself resolves it."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one job; it goes when the driver's JVM ends."""
    path = f"{checkpoint_root(spark)}/strata-scratch/{purpose}-{uuid.uuid4().hex[:12]}"
    fs, where = hadoop_path(spark, path)
    fs.deleteOnExit(where)
    return path
