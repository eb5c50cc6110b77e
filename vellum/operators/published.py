"""Tables that change as a whole: versions beside each other, one small record says which one counts.

A version is a folder of its own, written by Spark's own commit protocol and
never touched again.  Publishing adds one row to the table's commits (one file,
written after the version), and readers open the newest commit's folder.  A reader
sees the old version or the new one, never none; a refresh that dies leaves a folder
no commit names.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.catalog import read_table

COMMITS = T.StructType([T.StructField("n", T.LongType()), T.StructField("folder", T.StringType()), T.StructField("mark", T.StringType())])


def commits(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/commits", COMMITS)


def current(spark: SparkSession, root: str) -> Row | None:
    """The newest commit (n, folder, mark), None before the first one."""
    rows = commits(spark, root).orderBy(F.col("n").desc(), "folder").limit(1).collect()
    return rows[0] if rows else None


def new_version() -> str:
    """Name of a folder for the next version, relative to the table's root."""
    return f"versions/v-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folder: str, mark: str | None = None) -> None:
    """Make ``folder`` the version that counts.  ``mark`` is the writer's own note, e.g. how far it has read."""
    last = current(spark, root)
    row = (last.n + 1 if last else 1, folder, mark)
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{root}/commits")


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the version that counts now; a later publish doesn't change what this frame reads."""
    now = current(spark, root)
    if now is None:
        raise ValueError(f"nothing published under {root}")
    return spark.read.parquet(f"{root}/{now.folder}")
