"""Domain views over the driver tables.

The driver ships no PDFs, flights or reviews, so its tables play those roles.
Every view is a lazy DataFrame over whole tables (nothing sampled, nothing
dropped); Catalyst prunes the columns each query does not use.  The
equivalent SQL of each view is in ``vellum.plans.oracles``.

Fixed values of the fixture mapping (not of the reference): 200 products own
the manuals, 150 products receive reviews, 100 products have media, 30 days of
file mtimes from 2024-01-01, and the coordinate rule of a nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.sources.tables import table

MANUAL_PRODUCTS = 200
REVIEWED_PRODUCTS = 150
MEDIA_PRODUCTS = 100
MTIME_BASE = "2024-01-01"
MTIME_DAYS = 30
STAGE_NAME = "@docs_stage"
JSON_LEVELS = 8


def _pid() -> F.Column:
    return F.col("page_id")


def stage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document stage: one file per page; its bytes are the page HTML.

    Names mix '.pdf', '.PDF' and '.html' so the case-insensitive PDF filter
    and the suffix strip are exercised.
    """
    pid = _pid()
    ext = F.when(pid % 3 == 0, ".pdf").when(pid % 3 == 1, ".PDF").otherwise(".html")
    rel = F.concat(F.lit("manuals/"), (pid % MANUAL_PRODUCTS).cast("string"), F.lit("_Manual-"),
                   (F.floor(pid / MANUAL_PRODUCTS) + 1).cast("string"), ext)
    mtime = F.date_add(F.lit(MTIME_BASE).cast("date"), (pid % MTIME_DAYS).cast("int")).cast("timestamp_ntz")
    return table(spark, sf_dir, "pages").select(
        rel.alias("relative_path"),
        F.col("url").alias("file_url"),
        F.concat(F.lit(STAGE_NAME + "/"), rel).alias("scoped_url"),
        F.octet_length("html").cast("bigint").alias("size"),
        mtime.alias("last_modified"),
        F.col("html").alias("content"),
    )


def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DIRECTORY(@stage): metadata only."""
    return stage_files(spark, sf_dir).drop("content")


def stage_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(relative_path, content): what opening a file of the stage returns."""
    return stage_files(spark, sf_dir).select("relative_path", "content")


def ontime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-time facts: one row per line item; delay = days from order to ship,
    cancelled = returned line."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"),
        F.month("l_shipdate").alias("month"),
        F.col("l_shipdate").cast("date").alias("fl_date"),
        F.col("l_orderkey").alias("flight_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("carrier_id"),
        F.datediff("l_shipdate", "o_orderdate").alias("arr_delay"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("cancelled"),
        F.col("l_extendedprice").alias("fare"),
    )


def product_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master as nested JSON text: product attributes at the top, then
    an 8-level hierarchy l1 ... l8 whose leaf array holds two {value, brand}
    elements, empty for every tenth product."""
    p = table(spark, sf_dir, "part")
    leaf = F.filter(
        F.array(F.struct((F.col("p_size") + 0).alias("value"), F.col("p_brand").alias("brand")),
                F.struct((F.col("p_size") + 1).alias("value"), F.col("p_brand").alias("brand"))),
        lambda _: F.col("p_partkey") % 10 != 0)
    node = leaf
    for level in range(JSON_LEVELS - 1, 0, -1):
        node = F.array(F.struct(F.lit(level).alias("level"), node.alias(f"l{level + 1}")))
    doc = F.struct(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
                   F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), node.alias("l1"))
    return p.select("p_partkey", F.to_json(doc).alias("product_json"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("brand"), F.col("p_name").alias("model_name"),
        F.col("p_type").alias("category"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"),
        # every eleventh review is of a product that the master doesn't have
        F.concat(F.when(F.col("doc_id") % 11 == 0, "gone-").otherwise(""),
                 (F.col("doc_id") % REVIEWED_PRODUCTS).cast("string")).alias("product_id"),
        F.col("doc_id").alias("order_id"),
        F.col("text").alias("review_text"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("review_date"),
        F.col("o_custkey").alias("customer_id"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("review_id"), F.col("quality").alias("rating"))


def _lon(nation_key: F.Column) -> F.Column:
    return nation_key * 10.0 - 120.0


def _lat(nation_key: F.Column) -> F.Column:
    return nation_key * 3.0 - 36.0


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("nation_key"),
                    _lon(F.col("c_nationkey")).alias("lon"), _lat(F.col("c_nationkey")).alias("lat"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
                    _lon(F.col("s_nationkey")).alias("lon"), _lat(F.col("s_nationkey")).alias("lat"))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"))


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        (F.col("page_id") % MEDIA_PRODUCTS).cast("string").alias("product_id"), "url")


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
            .select(F.col("l_partkey").cast("string").alias("product_id"),
                    F.col("l_quantity").alias("qty")))


RETURNS_PER_FILE = 4000  # order keys


def returns_files(spark: SparkSession, sf_dir: str, corrected: bool) -> DataFrame:
    """The returns domain as named CSV files, one per 4000 order keys: (relative_path, content, last_modified).

    The first drop counts one piece too many in every row; the corrected drop is every third file, right, a day later.
    """
    r = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    number = F.floor(F.col("l_orderkey") / RETURNS_PER_FILE)
    if corrected:
        r = r.where(number % 3 == 0)
    line = F.concat_ws(",", "l_orderkey", "l_partkey", F.col("l_quantity") + (0 if corrected else 1))
    lines = r.groupBy(number.alias("number")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    day = F.date_add(F.lit(MTIME_BASE).cast("date"), F.lit(1 if corrected else 0)).cast("timestamp_ntz")
    return lines.select(F.concat(F.lit("returns-"), F.col("number").cast("string"), F.lit(".csv")).alias("relative_path"),
                        F.concat(F.lit("order_id,product_id,quantity\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("content"),
                        day.alias("last_modified"))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.operators.curate import curated_feedback, customer_locations
    return curated_feedback(
        reviews(spark, sf_dir), products(spark, sf_dir), sales(spark, sf_dir),
        ratings(spark, sf_dir),
        customer_locations(customers(spark, sf_dir), nations(spark, sf_dir)),
        media(spark, sf_dir), returns(spark, sf_dir))
