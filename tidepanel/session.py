"""Session helpers.

On a cluster the session is configured by the deployment; these helpers only
fill in settings that are unset, so local runs and tests behave like a small
cluster (AQE on, UTC, sane shuffle width).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Settings the plans are written for on a large cluster, for a deployment to copy.
# Shuffle width is left to AQE: start wide, coalesce to ~256 MB partitions, split skewed ones.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tidepanel") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The shared folder is read from the session. Only when it is unset *and*
    the master is local (tests, single-machine runs) do we create one under
    the system temp dir; on a cluster an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS/S3)")
        base = tempfile.mkdtemp(prefix="tidepanel-ckpt-")  # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", base)
    _register_checkpoint_dir(spark, base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of ``path``, wherever it is stored."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files below ``path`` that Spark's readers see (no hidden ones), in order; none if it does not exist."""
    fs, top = file_system(spark, path)
    if not fs.exists(top):
        return []
    top, out = fs.getFileStatus(top).getPath(), []
    found = fs.listFiles(top, True)
    while found.hasNext():
        name = found.next().getPath().toString()
        below = name[len(top.toString()):]
        # folders like year=1997 may begin with anything, files and other folders are hidden by _ or .
        if below.strip("/") and not any(p.startswith((".", "_")) and "=" not in p for p in below.strip("/").split("/")):
            out.append(name)
    return sorted(out) or ([top.toString()] if fs.getFileStatus(top).isFile() else [])


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this process. DataFrames that read them can no longer be used."""
    n = 0
    while _SCRATCH:
        fs, p = file_system(spark, _SCRATCH.pop())
        n += bool(fs.delete(p, True))
    return n


def checkpointed(df):
    """Materialize ``df`` once with a reliable ``checkpoint()`` into the shared
    checkpoint folder (never ``localCheckpoint``), so several branches of a
    plan read it instead of recomputing it, and an executor loss does not
    recompute it either."""
    scratch_dir(df.sparkSession, "ckpt")  # resolves / validates the shared folder and registers it
    return df.checkpoint(eager=True)


def _register_checkpoint_dir(spark: SparkSession, base: str) -> None:
    """Classic sessions need the folder on the SparkContext; Spark Connect reads the conf."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect has no SparkContext)
        return
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
