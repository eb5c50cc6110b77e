"""Curation: RAW -> STG -> CURATED for the retail domains.

* ``flatten_json``      -- LATERAL FLATTEN down a path of nested arrays (8 levels
                           for the product master); outer, so a parent whose
                           child array is missing or empty is kept with NULLs.
* ``media_summary`` /
  ``returns_summary``   -- child tables pre-aggregated to one row per product
                           before they meet the review grain, so joins never
                           multiply reviews.  Only algebraic aggregates
                           (count, sum, min, max): they combine map-side, so a
                           product holding a third of all rows is one partial
                           row per task, and no value grows with a group.
* ``curated_feedback``  -- one row per review event.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.geo import st_point

# Fixed value: the label for products without media.
NO_MEDIA = "NO MEDIA"


def flatten_json(df: DataFrame, json_col: str, path: list[str], keep: list[str],
                 fields: tuple[str, ...] = ()) -> DataFrame:
    """Explode nested arrays along ``path`` (keys of successive levels).

    Output: ``keep`` columns, for each level ``posN`` (position, NULL when the
    level had no element) and ``NAME_N`` for each of ``fields`` (as text), and
    ``node`` (the innermost element, VARIANT).
    """
    cur = df.select(*keep, F.try_parse_json(json_col).alias("node"))
    found: list[str] = []
    for i, key in enumerate(path, 1):
        child = F.try_variant_get("node", f"$.{key}", "array<variant>")
        cur = cur.select(*keep, *found, F.posexplode_outer(child).alias(f"pos{i}", "node"))
        cur = cur.select("*", *(F.try_variant_get("node", f"$.{f}", "string").alias(f"{f}_{i}") for f in fields))
        found += [f"pos{i}", *(f"{f}_{i}" for f in fields)]
    return cur


def media_summary(media: DataFrame) -> DataFrame:
    """media(product_id, url) -> one row per product."""
    return (media.groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("media_count"),
                 F.min("url").alias("first_media_url"),
                 F.max("url").alias("last_media_url")))


def product_media(media: DataFrame) -> DataFrame:
    """CURATED_PRODUCT_MEDIA: every media URL of every product, one row each.

    The list of a product's URLs is the rows under its key, so no value and no
    group grows with a hot product; equal URLs are combined before the shuffle.
    """
    return media.groupBy("product_id", "url").agg(F.count(F.lit(1)).alias("n_files"))


def returns_summary(returns: DataFrame) -> DataFrame:
    """returns(product_id, qty) -> one row per product."""
    return (returns.groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("return_count"),
                 F.sum("qty").alias("return_qty")))


def customer_locations(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """customers(customer_id, nation_key, lon, lat) + nations(nation_key, nation_name)."""
    return (customers.join(nations, "nation_key", "left")
            .select("customer_id",
                    F.col("nation_name").alias("reviewer_location_name"),
                    st_point(F.col("lon"), F.col("lat")).alias("reviewer_geo_point")))


def curated_feedback(reviews: DataFrame, products: DataFrame, sales: DataFrame,
                     ratings: DataFrame, locations: DataFrame,
                     media: DataFrame, returns: DataFrame) -> DataFrame:
    """CURATED_PRODUCT_FEEDBACK at review grain: every review once, whether or not its product is known.

    reviews(review_id, product_id, order_id, review_text)
    products(product_id, brand, model_name, category)
    sales(order_id, review_date, customer_id)
    ratings(review_id, rating)
    locations(customer_id, reviewer_location_name, reviewer_geo_point)
    media(product_id, url), returns(product_id, qty)   -- raw child rows
    """
    # a review's keys meet the other tables first, each combination once; the text passes one exchange
    of_product = (products.select("product_id", "brand", "model_name", "category")
                  .join(media_summary(media), "product_id", "full").join(returns_summary(returns), "product_id", "full"))
    of_order = sales.join(locations, "customer_id", "left")
    keys = ["review_id", "product_id", "order_id"]
    of_review = (reviews.select(*keys).distinct()
                 .join(of_product, "product_id", "left")
                 .join(of_order, "order_id", "left")
                 .join(ratings, "review_id", "left")
                 .withColumnsRenamed({k: f"__{k}" for k in keys}))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    r = reviews.select(*keys, "review_text").join(of_review, same, "inner")
    return r.select(
        "product_id", "brand", "model_name", "category", "review_id",
        F.col("review_date").cast("date").alias("review_date"),
        "rating", "review_text", "reviewer_location_name", "reviewer_geo_point",
        F.coalesce("media_count", F.lit(0)).cast("bigint").alias("media_count"),
        F.coalesce("first_media_url", F.lit(NO_MEDIA)).alias("first_media_url"),
        F.coalesce("return_count", F.lit(0)).cast("bigint").alias("return_count"),
        F.coalesce("return_qty", F.lit(0.0)).cast("double").alias("return_qty"),
    )
