"""Fact lake: unload to year/quarter/month folders, external-table reads, the
one-quarter statistic and the pre-aggregated monthly table (the materialized
view), with a roll-up that stays exact because it keeps sums and counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.published import current, new_version, publish, read_published
from vellum.session import new_workspace

PARTITION_COLS = ["year", "quarter", "month"]


def unload(facts: DataFrame, root: str, fmt: str = "parquet", partitioned: bool = True,
           replace: str = "partitions") -> None:
    """Write facts under ``root``; partitioned -> year=/quarter=/month= folders.

    REBALANCE (an AQE hint) shuffles rows so that each task writes few, evenly
    sized files: a hot month is split into advisory-size pieces, small months
    are coalesced.  ``replace="partitions"`` overwrites only the months being
    written (a re-run of some months keeps the rest); ``replace="all"`` is the
    cheaper commit for a fresh folder.
    """
    mode = "dynamic" if replace == "partitions" else "static"
    if partitioned:
        out = facts.hint("rebalance", *PARTITION_COLS)
        writer = (out.write.mode("overwrite").option("partitionOverwriteMode", mode)
                  .partitionBy(*PARTITION_COLS))
    else:
        writer = facts.hint("rebalance").write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(root)


def external_table(spark: SparkSession, root: str, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame:
    """Read an unloaded folder.  Partition folders become columns, and filters on
    them prune whole folders before any file is opened (PartitionFilters).
    CSV carries no types, so a schema is required for it.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV external tables need an explicit schema")
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(root)


def quarter_stats(facts: DataFrame, year: int, quarter: int) -> DataFrame:
    """AVG(arr_delay), AVG(cancelled) for one quarter: at most one row, because
    both grouping keys are pinned by the filter."""
    return (facts.where((F.col("year") == year) & (F.col("quarter") == quarter))
            .groupBy("year", "quarter")
            .agg(F.avg("arr_delay").alias("avg_arr_delay"),
                 F.avg(F.col("cancelled").cast("int")).cast("double").alias("cancel_rate")))


def monthly_aggregate(facts: DataFrame) -> DataFrame:
    """Body of the materialized view: additive measures per month."""
    return (facts.groupBy(*PARTITION_COLS)
            .agg(F.count(F.lit(1)).alias("n_flights"),
                 F.count("arr_delay").alias("n_arr_delay"),
                 F.sum("arr_delay").cast("bigint").alias("sum_arr_delay"),
                 F.count("cancelled").alias("n_cancelled"),
                 F.sum(F.col("cancelled").cast("int")).cast("bigint").alias("sum_cancelled")))


def refresh_monthly_aggregate(spark: SparkSession, facts: DataFrame, mv_root: str,
                              months: list[tuple[int, int, int]] | None = None) -> None:
    """Materialize the monthly aggregate, all of it or the ``months`` whose facts changed.

    A month without facts any more loses its row; an empty list changes nothing.
    The new table is written aside first, since it is read from the old one.
    """
    if months is None:
        monthly_aggregate(facts).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(*PARTITION_COLS).parquet(mv_root)
        return
    if not months:
        return
    named = spark.createDataFrame(months, ", ".join(f"{c} int" for c in PARTITION_COLS))
    new = monthly_aggregate(facts.join(F.broadcast(named), list(PARTITION_COLS), "left_semi"))
    old = external_table(spark, mv_root)
    aside = new_workspace(spark, "monthly")
    (old.join(F.broadcast(named), list(PARTITION_COLS), "left_anti").select(*new.columns).unionByName(new)
     .write.parquet(aside))
    (spark.read.schema(new.schema).parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*PARTITION_COLS).parquet(mv_root))


def refresh_published(spark: SparkSession, facts: DataFrame, root: str, load_column: str) -> int:
    """Refresh the monthly aggregate published under ``root`` from what was loaded since; the months computed.

    ``load_column`` grows from load to load.  Months with rows loaded after the published version's mark are
    aggregated again from all their facts, the others are carried over; the new version lies beside the old one
    until it is published.  Without news nothing is written.
    """
    last = current(spark, root)
    kind = facts.schema[load_column].dataType
    news = facts if last is None else facts.where(F.col(load_column) > F.lit(last.mark).cast(kind))
    seen = news.agg(F.max(load_column).cast("string").alias("mark"), F.count(F.lit(1)).alias("n")).first()
    if not seen.n:
        return 0
    months = news.select(*PARTITION_COLS).distinct()  # a row a month
    new = monthly_aggregate(facts.join(F.broadcast(months), PARTITION_COLS, "left_semi")) if last else monthly_aggregate(facts)
    if last:
        kept = read_published(spark, root).join(F.broadcast(months), PARTITION_COLS, "left_anti")
        new = kept.select(*new.columns).unionByName(new)
    folder = new_version()
    new.write.partitionBy(*PARTITION_COLS).parquet(f"{root}/{folder}")
    publish(spark, root, folder, seen.mark)
    return months.count()


def rollup_quarter(mv: DataFrame) -> DataFrame:
    """Quarter averages from monthly sums and counts (never average averages)."""
    return (mv.groupBy("year", "quarter")
            .agg(F.sum("n_flights").alias("n_flights"),
                 (F.sum("sum_arr_delay") / F.sum("n_arr_delay")).alias("avg_arr_delay"),
                 (F.sum("sum_cancelled") / F.sum("n_cancelled")).alias("cancel_rate")))


def quarter_stats_from_mv(mv: DataFrame, year: int, quarter: int) -> DataFrame:
    return (rollup_quarter(mv.where((F.col("year") == year) & (F.col("quarter") == quarter)))
            .select("year", "quarter", "avg_arr_delay", "cancel_rate"))
