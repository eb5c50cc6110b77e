"""Append-only catalog tables (RAW file inventory, PROCESSED documents).

A table is a Parquet folder with a fixed schema.  Rows are only ever appended.
The version key of a file is (relative_path, last_modified): a file written
again with a new mtime is a new version and gets a new row; the old row stays.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.paths import file_name, is_pdf

VERSION_KEY = ["relative_path", "last_modified"]

RAW_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("relative_path", T.StringType()),
    T.StructField("file_url", T.StringType()),
    T.StructField("scoped_url", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("last_modified", T.TimestampNTZType()),
    T.StructField("extracted", T.VariantType()),
    T.StructField("insert_ts", T.TimestampType()),
])

PROCESSED_SCHEMA = T.StructType([
    T.StructField("pdf_id", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("relative_path", T.StringType()),
    T.StructField("file_url", T.StringType()),
    T.StructField("last_modified", T.TimestampNTZType()),
    T.StructField("pdf_metadata", T.VariantType()),
    T.StructField("page_count", T.DecimalType(38, 0)),
    T.StructField("extracted_text", T.StringType()),
    T.StructField("insert_ts", T.TimestampType()),
])

# rows that cannot enter a catalog: NULL version key, or a file that cannot be opened
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("relative_path", T.StringType()),
    T.StructField("last_modified", T.TimestampNTZType()),
    T.StructField("reason", T.StringType()),
    T.StructField("insert_ts", T.TimestampType()),
])


def raw_rows(listing: DataFrame) -> DataFrame:
    """RAW catalog columns of the listed PDF files (T1's SELECT list)."""
    return listing.where(is_pdf("relative_path")).select(
        file_name("relative_path").alias("file_name"),
        "relative_path", "file_url", "scoped_url", "size",
        F.col("last_modified").cast("timestamp_ntz").alias("last_modified"),
        F.lit(None).cast("variant").alias("extracted"),
    )


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table's rows, or None if its folder isn't there; any other fault is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """CREATE TABLE IF NOT EXISTS: an empty Parquet folder with the schema."""
    if _stored(spark, path, schema) is None:
        spark.createDataFrame([], schema).write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    table = _stored(spark, path, schema)
    return spark.createDataFrame([], schema) if table is None else table


def append_counted(rows: DataFrame, path: str, schema: T.StructType) -> int:
    """Append ``rows`` and return their number; without rows nothing is written.

    The rows are computed once and kept by the executors until they are written;
    a lost one computes its share again.
    """
    held = conform(rows, schema).persist()
    try:
        n = held.count()
        if n:
            held.write.mode("append").parquet(path)
        return n
    finally:
        held.unpersist()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the table's columns in order, cast to its types; missing columns are NULL."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def null_key(key: list[str]) -> F.Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])


def new_versions(candidates: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``existing`` (NOT EXISTS).

    Deduplicates inside the batch first: an anti-join alone keeps two equal
    new rows.  Rows with a NULL key part are excluded (they never match, so an
    anti-join would re-insert them on every run).  The anti-join ships key
    columns only; Spark picks broadcast vs. shuffled join from measured sizes.
    """
    return (candidates.where(~null_key(key))
            .dropDuplicates(key)
            .join(existing.select(*key), key, "left_anti"))


def append_new(spark: SparkSession, candidates: DataFrame, path: str, schema: T.StructType,
               key: list[str] = VERSION_KEY, quarantine_path: str | None = None,
               unseen: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int:
    """INSERT INTO path SELECT ... WHERE NOT EXISTS (same key): idempotent append.

    Re-running with the same candidates appends nothing and writes no file.
    ``insert_ts`` is stamped at write time (column default
    CURRENT_TIMESTAMP()).  ``unseen(candidates, existing)`` stands in for
    ``new_versions``.  Returns the number of rows appended.
    """
    create_table(spark, path, schema)
    existing = read_table(spark, path, schema)
    new = unseen(candidates, existing) if unseen else new_versions(candidates, existing, key)
    rows = new.withColumn("insert_ts", F.current_timestamp())
    n = append_counted(rows, path, schema)
    if quarantine_path is not None:
        bad = (candidates.where(null_key(key))
               .select("relative_path", "last_modified", F.lit("NULL version key").alias("reason")))
        quarantine(spark, bad, quarantine_path)
    return n


def quarantine(spark: SparkSession, bad: DataFrame, path: str) -> None:
    """Append (relative_path, last_modified, reason) rows not already quarantined.

    Keys may be NULL here, so the anti-join uses NULL-safe equality.
    """
    seen = read_table(spark, path, QUARANTINE_SCHEMA).alias("q")
    cols = ["relative_path", "last_modified", "reason"]
    cond = reduce(lambda a, b: a & b, [F.col(f"b.{c}").eqNullSafe(F.col(f"q.{c}")) for c in cols])
    rows = (bad.select(*cols).dropDuplicates(cols).alias("b")
            .join(seen, cond, "left_anti")
            .withColumn("insert_ts", F.current_timestamp()))
    append_counted(rows, path, QUARANTINE_SCHEMA)
