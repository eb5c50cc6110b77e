"""RAW -> STG -> CURATED for the five retail domains.

RAW holds what COPY INTO loaded (typed, bad rows kept in the corrupt-record
column, every row with its file and load time).  STG keeps the good rows, casts
keys and keeps each key's latest record (load time, then file, then content, so
the choice is fixed); rows without their key go to a quarantine table.  Only the
newest version of every file is read, so a corrected file replaces its rows with
or without a key.  Returns have no key of their own: each row counts.
CURATED is the review-grain table built from STG.  Each layer is written as
Parquet, so later layers read files, not lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.curate import curated_feedback, customer_locations, flatten_json, product_media
from vellum.sources.domains import CORRUPT, loaded


KEYS = {"product_master": "product_id", "sales_transactions": "order_id",
        "customer_reviews": "review_id", "media_metadata": "media_id"}


BROADCAST_KEYS = 100_000


def _good(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def latest(raw: DataFrame, key: str, columns: list[Column]) -> DataFrame:
    """The good rows' ``columns``, one row per key: the one loaded last."""
    names = raw.select(*columns).columns
    rows = _good(raw).where(F.col(key).isNotNull()).select(*columns, "load_time", "load_file")
    rank = F.struct("load_time", "load_file", *names)

    def last_loaded(of: DataFrame) -> DataFrame:
        return of.groupBy(names[0]).agg(F.max(rank).alias("r")).select(*(F.col(f"r.{n}").alias(n) for n in names))

    # a key that one row holds has nothing to choose from: only rows of repeated keys need an exchange
    repeated = rows.groupBy(names[0]).count().where("count > 1").select(names[0])
    n = repeated.limit(BROADCAST_KEYS + 1).count()
    if not n:
        return rows.select(*names)
    if n > BROADCAST_KEYS:
        return last_loaded(rows)
    repeated = F.broadcast(repeated)
    return (rows.join(repeated, names[0], "left_anti").select(*names)
            .unionByName(last_loaded(rows.join(repeated, names[0], "left_semi"))))


def without_key(raw: DataFrame, key: str) -> DataFrame:
    """Good rows that have no key, as JSON text with where they came from."""
    rows = _good(raw).where(F.col(key).isNull())
    return rows.select("load_file", "load_time", F.to_json(F.struct(*(c for c in rows.columns if not c.startswith("load_")))).alias("row"))


def stg_products(raw: DataFrame) -> DataFrame:
    return latest(raw, "product_id", [F.col("product_id").cast("string").alias("product_id"),
                                      F.col("brand"), F.col("name").alias("model_name"), F.col("category")])


def stg_product_hierarchy(raw: DataFrame) -> DataFrame:
    """One row per leaf of a product's 8-level hierarchy, with position and level of every node above it."""
    rows = latest(raw.withColumn("hierarchy", F.to_json(F.struct("l1"))), "product_id",
                  [F.col("product_id").cast("string").alias("product_id"), F.col("hierarchy")])
    flat = flatten_json(rows, "hierarchy", [f"l{i}" for i in range(1, 9)], keep=["product_id"], fields=("level",))
    return flat.withColumn("leaf", F.to_json("node")).drop("node", "level_8")


def stg_sales(raw: DataFrame) -> DataFrame:
    return latest(raw, "order_id", [F.col("order_id"), F.col("order_date").cast("date").alias("review_date"), F.col("customer_id")])


def stg_reviews(raw: DataFrame) -> DataFrame:
    return latest(raw, "review_id", [F.col(c) for c in ("review_id", "product_id", "order_id", "rating", "review_text")])


def stg_media(raw: DataFrame) -> DataFrame:
    return latest(raw, "media_id", [F.col(c) for c in ("media_id", "product_id", "url")]).drop("media_id")


def stg_returns(raw: DataFrame) -> DataFrame:
    return _good(raw).select("product_id", F.col("quantity").alias("qty"))


STG = {
    "product_master": stg_products,
    "product_hierarchy": stg_product_hierarchy,
    "sales_transactions": stg_sales,
    "customer_reviews": stg_reviews,
    "media_metadata": stg_media,
    "returns_issues": stg_returns,
}


def build_stg(spark: SparkSession, raw_tables: dict[str, str], stg_root: str) -> dict[str, str]:
    out = {}
    for name, fn in STG.items():
        out[name] = f"{stg_root}/{name}"
        raw = loaded(spark, raw_tables["product_master" if name == "product_hierarchy" else name])
        fn(raw).write.mode("overwrite").parquet(out[name], compression="zstd")
        if name in KEYS:
            without_key(raw, KEYS[name]).write.mode("overwrite").parquet(f"{stg_root}/{name}_quarantine")
    return out


def build_curated(spark: SparkSession, stg: dict[str, str], customers: DataFrame, nations: DataFrame,
                  path: str) -> str:
    read = lambda n: spark.read.parquet(stg[n])
    reviews = read("customer_reviews")
    curated = curated_feedback(
        reviews.select("review_id", "product_id", "order_id", "review_text"),
        read("product_master"), read("sales_transactions"),
        reviews.select("review_id", "rating"),
        customer_locations(customers, nations),
        read("media_metadata"), read("returns_issues"))
    curated.write.mode("overwrite").parquet(path, compression="zstd")
    product_media(read("media_metadata")).write.mode("overwrite").parquet(f"{path.rsplit('/', 1)[0]}/product_media")
    return path
