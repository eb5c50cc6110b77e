"""Expressions and settings that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import new_workspace

# Fixed pattern of the contracts: a word is a run of characters other than
# space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


# Spark's own bound of an Arrow batch, and the one taken in its place: a task holds a batch several times over
# (JVM buffer, its copy for the worker, the worker's own).
SPARK_BATCH_BYTES, BATCH_BYTES = 64 << 20, 4 << 20
BATCH_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"

_temporary: list[list[str]] = []  # folders of the open ``temporary_tables`` blocks, innermost last


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` in this session where Spark's default holds; another value is the deployment's."""
    if spark.conf.get(BATCH_BOUND).rstrip("b") == str(SPARK_BATCH_BYTES):
        spark.conf.set(BATCH_BOUND, str(BATCH_BYTES))


def _give_back() -> None:
    """Return what Arrow's and C's allocators hold free to the system; where there is no ``malloc_trim``, Arrow's only."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` that leaves its worker small: workers are reused, and would keep their largest task's memory while the JVM sorts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            _give_back()

    return run


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a later executor loss rereads the files instead of
    repeating the work, and several consumers share one computation.
    """
    spark = df.sparkSession
    path = new_workspace(spark, label)
    if _temporary:
        _temporary[-1].append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that ``written`` makes inside the block when it ends, also by an error.

    What is needed later must be written by then outside of the block or read no such
    table: a frame on a dropped table fails when it is run, it doesn't lose rows.
    """
    _temporary.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _temporary.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def lasting(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``written`` for a result that outlives the ``temporary_tables`` block it is made in."""
    inner = _temporary.pop() if _temporary else None
    try:
        return written(df, label, compression)
    finally:
        if inner is not None:
            _temporary.append(inner)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
