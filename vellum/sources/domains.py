"""Staged files of the five retail domains and their COPY INTO load.

Staging writes each domain from the driver tables in the format a source
system would drop (JSON lines for nested or free-text records, CSV for flat
ones).  Loading reads each folder with an explicit schema -- never inferred --
in PERMISSIVE mode with a corrupt-record column, and appends to the RAW-layer
Parquet table; rejected rows stay visible through that column.  A load is
published with its history in one commit, and a file's newer version replaces
its older one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.catalog import read_table
from vellum.sources.tables import table

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Domain:
    name: str
    fmt: str                 # "json" | "csv"
    schema: T.StructType     # load schema (without the corrupt-record column)


DOMAINS = [
    Domain("product_master", "json", T.StructType([
        T.StructField("product_id", T.LongType()), T.StructField("name", T.StringType()),
        T.StructField("brand", T.StringType()), T.StructField("category", T.StringType()),
        T.StructField("l1", T.VariantType())])),
    Domain("sales_transactions", "csv", T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()), T.StructField("total_price", T.DoubleType())])),
    Domain("customer_reviews", "json", T.StructType([
        T.StructField("review_id", T.LongType()), T.StructField("product_id", T.StringType()),
        T.StructField("order_id", T.LongType()), T.StructField("rating", T.IntegerType()),
        T.StructField("review_text", T.StringType()), T.StructField("lang", T.StringType())])),
    Domain("media_metadata", "csv", T.StructType([
        T.StructField("media_id", T.LongType()), T.StructField("product_id", T.StringType()),
        T.StructField("url", T.StringType())])),
    Domain("returns_issues", "csv", T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.DoubleType())])),
]


def _source_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """What a source system drops for each domain (driver tables in the fixture roles)."""
    from vellum.plans import fixtures as fx

    if name == "product_master":
        return fx.product_json(spark, sf_dir).select("product_json")
    if name == "sales_transactions":
        return table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("total_price"))
    if name == "customer_reviews":
        reviews = fx.reviews(spark, sf_dir).join(fx.ratings(spark, sf_dir), "review_id", "left")
        docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), "lang")
        return reviews.join(docs, "review_id").select(
            "review_id", "product_id", "order_id", "rating", "review_text", "lang")
    if name == "media_metadata":
        return table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("media_id"),
            (F.col("page_id") % fx.MEDIA_PRODUCTS).cast("string").alias("product_id"), "url")
    if name == "returns_issues":
        return (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
                .select(F.col("l_orderkey").alias("order_id"),
                        F.col("l_partkey").cast("string").alias("product_id"),
                        F.col("l_quantity").alias("quantity")))
    raise ValueError(name)


def stage(spark: SparkSession, sf_dir: str, stage_root: str) -> None:
    """Drop every domain's files under ``stage_root/<domain>/``."""
    for d in DOMAINS:
        rows = _source_rows(spark, sf_dir, d.name)
        path = f"{stage_root}/{d.name}"
        if d.name == "product_master":
            rows.write.mode("overwrite").text(path)          # already JSON documents
        elif d.fmt == "json":
            rows.write.mode("overwrite").json(path)
        else:
            rows.write.mode("overwrite").option("header", "true").csv(path)


HISTORY_SCHEMA = T.StructType([T.StructField("load_file", T.StringType()), T.StructField("load_time", T.TimestampType()),
                               T.StructField("load_id", T.StringType())])


def _history_path(table_path: str) -> str:
    return f"{table_path}_load_history"


def _file(path: F.Column, encoded: bool = False) -> F.Column:
    """One spelling of a file's path: a listing gives it plain, the metadata of rows percent-encoded."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/+", "file:/")


def files_to_load(spark: SparkSession, stage_path: str, table_path: str) -> list:
    """Files of the stage folder that aren't in the load history with their modification time, by name.

    Every file that Spark doesn't hide counts, whatever its name.  The files' names come to the driver, the rows don't.
    """
    listed = (spark.read.format("binaryFile").load(stage_path)
              .select("path", _file(F.col("path")).alias("load_file"), F.col("modificationTime").alias("load_time")))
    history = read_table(spark, _history_path(table_path), HISTORY_SCHEMA)
    return listed.join(history, ["load_file", "load_time"], "left_anti").orderBy("load_file").collect()


def write_load(spark: SparkSession, d: Domain, fresh: list, table_path: str) -> str:
    """Write the files' rows under a load id of their own; they don't count until ``publish``."""
    load_id = f"l-{uuid.uuid4().hex}"
    schema = T.StructType(d.schema.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if d.fmt == "csv":
        reader = reader.option("header", "true")
    rows = reader.format(d.fmt).load([r.path for r in fresh])
    rows = rows.select("*", _file(F.col("_metadata.file_path"), encoded=True).alias("load_file"),
                       F.col("_metadata.file_modification_time").alias("load_time"))
    rows.write.parquet(f"{table_path}/load_id={load_id}", compression="zstd")
    return load_id


def publish(spark: SparkSession, fresh: list, load_id: str, table_path: str) -> None:
    """Add the load's files to the history, in one file: that is the commit of the load."""
    rows = [(r.load_file, r.load_time, load_id) for r in fresh]
    spark.createDataFrame(rows, HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(_history_path(table_path))


def copy_into(spark: SparkSession, d: Domain, stage_path: str, table_path: str) -> int:
    """COPY INTO table FROM @stage, exactly once: typed read, bad rows kept in the corrupt column.

    The load history (file, modification time, load) decides what is new and
    what counts.  Rows are written first, under a load id; the load's history,
    one file, makes them count.  A load that dies in between leaves rows no
    history names, and its files are loaded again.  A file that changed is
    loaded again under its new time, and ``loaded`` then reads that version
    only.  Returns the number of files loaded.
    """
    fresh = files_to_load(spark, stage_path, table_path)
    if fresh:
        publish(spark, fresh, write_load(spark, d, fresh, table_path), table_path)
    return len(fresh)


def loaded(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows that count: of every file its newest published version, each with load_file, load_time and load_id.

    Rows whose file changed while it was being read carry a time no history has, and don't count either.  The
    side of the join that grows with the rows isn't shuffled as long as the files' names are few (measured sizes).
    """
    rows = spark.read.parquet(table_path)
    newest = (read_table(spark, _history_path(table_path), HISTORY_SCHEMA)
              .groupBy("load_file").agg(F.max(F.struct("load_time", "load_id")).alias("v"))
              .select("load_file", "v.load_time", "v.load_id"))
    return rows.join(newest, ["load_file", "load_time", "load_id"], "left_semi")


def load(spark: SparkSession, root: str) -> dict[str, str]:
    """Load what is new of every domain under ``root/stage`` into ``root/raw``."""
    tables = {d.name: f"{root}/raw/{d.name}" for d in DOMAINS}
    for d in DOMAINS:
        copy_into(spark, d, f"{root}/stage/{d.name}", tables[d.name])
    return tables


def stage_and_load(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    stage(spark, sf_dir, f"{root}/stage")
    return load(spark, root)


def load_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Per domain: rows loaded and rows rejected (non-NULL corrupt column)."""
    parts = [
        loaded(spark, path).agg(
            F.lit(name).alias("domain"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(CORRUPT).alias("n_rejected"))
        for name, path in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
