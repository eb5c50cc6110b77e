"""Session construction and the shared working folder.

Everything the pipeline writes (catalog tables, the fact lake, streaming
checkpoints) lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (local runs, tests) do we
create one of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# No web page and no progress bar: they are fixed when the context starts.
START_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Settings this pipeline relies on, filled in where the deployment (its
# spark-defaults, submit options or an existing session) says nothing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole documents travel through Arrow: cap batches by rows and by bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "vellum",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = START_CONF | (extra or {})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    said = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if not said.contains(k) and k not in conf:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for tables and checkpoints.

    Read from the session (``spark.checkpoint.dir``, or a directory already
    set with ``setCheckpointDir``).  Set our own only where it is unset, and
    only in one process: executors elsewhere don't see a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub folder of the shared root."""
    return f"{shared_root(spark)}/vellum-{label}-{uuid.uuid4().hex[:12]}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a working folder with all below it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def move_files(spark: SparkSession, source: str, target: str) -> list[str]:
    """Move every data file of a folder into ``target``, one rename each; the paths they have then.

    What Spark writes into a folder of its own comes into a table so, as its committer would bring it there, but
    without the folder for temporary files that two writers of one table share and delete.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder, to = path(source), path(target)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    fs.mkdirs(to)
    moved = []
    for found in fs.listStatus(folder):
        name = found.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if not fs.rename(found.getPath(), path(to, name)):
            raise OSError(f"{found.getPath().toString()} could not be moved to {target}")
        moved.append(f"{target}/{name}")
    return moved


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme and host, the default one's where it names none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
