"""Tables the modeled views read, each built once per session and data dir, when it is first read.

  ontime_part     Parquet, year=/quarter=/month= folders   (partitioned external table)
  ontime_nopart   Parquet, same rows, no folders          (unpartitioned external table)
  ontime_monthly  monthly aggregate table                 (the materialized view)
  ontime_csv_*    the facts as CSV, partitioned and flat   (the unload procedure's format)
  processed       PROCESSED document catalog              (what T2 produces)
  curated         CURATED_PRODUCT_FEEDBACK, review_year= folders (the curation pipeline's table)

External tables are opened once and registered as temp views: the file listing
is kept with the relation (as a catalog keeps partition metadata), so a query
filtered on partition columns prunes folders in memory instead of listing the
whole table again.  ``refresh`` re-lists after the folders change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.catalog import PROCESSED_SCHEMA, conform, raw_rows, read_table
from vellum.operators.extract import extract_documents
from vellum.operators.lake import external_table, refresh_monthly_aggregate, unload
from vellum.plans.fixtures import curated, ontime, stage_content, stage_listing
from vellum.session import new_workspace, shared_root


class Lake:
    """The fact tables; each is built when it is first read, with what it derives from.

    The join runs once: the flat copy, the aggregate and the CSV copies (the format the
    unload procedure writes) derive from the partitioned copy.
    """

    def __init__(self, spark: SparkSession, root: str, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.part = f"{root}/ontime_part"
        self.nopart = f"{root}/ontime_nopart"
        self.monthly = f"{root}/ontime_monthly"
        self.csv_part = f"{root}/ontime_csv_part"
        self.csv_nopart = f"{root}/ontime_csv_nopart"
        self._built: set[str] = set()
        self._tables: dict[str, DataFrame] = {}

    def _build(self, path: str) -> None:
        if path in self._built:
            return
        if path == self.part:
            unload(ontime(self.spark, self.sf_dir), path, "parquet", partitioned=True, replace="all")
        else:
            self._build(self.part)
            facts = external_table(self.spark, self.part)
            if path == self.monthly:
                refresh_monthly_aggregate(self.spark, facts, path)
            else:
                fmt = "parquet" if path == self.nopart else "csv"
                unload(facts, path, fmt, partitioned=path == self.csv_part, replace="all")
        self._built.add(path)

    def build(self) -> None:
        """Build all that isn't built yet."""
        for path in (self.part, self.nopart, self.monthly, self.csv_part, self.csv_nopart):
            self._build(path)

    def _open(self, path: str, fmt: str = "parquet") -> DataFrame:
        if path not in self._tables:
            self._build(path)
            schema = external_table(self.spark, self.part).schema if fmt == "csv" else None
            df = external_table(self.spark, path, fmt, schema=schema)
            df.createOrReplaceTempView("ext_" + path.rsplit("/", 1)[-1])
            self._tables[path] = df
        return self._tables[path]

    def refresh(self) -> None:
        for path in list(self._tables):
            self.spark.catalog.refreshByPath(path)
        self._tables.clear()

    def facts_part(self, spark: SparkSession | None = None) -> DataFrame:
        return self._open(self.part)

    def facts_nopart(self, spark: SparkSession | None = None) -> DataFrame:
        return self._open(self.nopart)

    def mv(self, spark: SparkSession | None = None) -> DataFrame:
        return self._open(self.monthly)

    def csv_facts_part(self) -> DataFrame:
        return self._open(self.csv_part, "csv")

    def csv_facts_nopart(self) -> DataFrame:
        return self._open(self.csv_nopart, "csv")


def build_lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake(spark, new_workspace(spark, "lake"), sf_dir)


def build_processed(spark: SparkSession, sf_dir: str) -> str:
    """PROCESSED as one batch job (what T2 produces incrementally): RAW rows of
    the listing, bytes joined from the stage, parsed on executors, written once."""
    path = new_workspace(spark, "processed") + "/pdf_processed_file_catalog"
    files = raw_rows(stage_listing(spark, sf_dir)).join(stage_content(spark, sf_dir), "relative_path", "left")
    parsed = extract_documents(files)
    conform(parsed.where(parsed.parse_error.isNull()), PROCESSED_SCHEMA).write.mode("overwrite").parquet(path)
    return path


def build_curated(spark: SparkSession, sf_dir: str) -> str:
    path = new_workspace(spark, "curated") + "/curated_product_feedback"
    by_year = curated(spark, sf_dir).withColumn("review_year", F.year("review_date"))
    by_year.hint("rebalance", "review_year").write.mode("overwrite").partitionBy("review_year").parquet(path, compression="zstd")
    return path


_BUILT: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, build):
    key = (spark.sparkContext.applicationId, shared_root(spark), sf_dir.rstrip("/"), kind)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    return _once(spark, sf_dir, "lake", build_lake)


def processed_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(spark, sf_dir, "processed", build_processed)
    return read_table(spark, path, PROCESSED_SCHEMA).drop("insert_ts")


def curated_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_once(spark, sf_dir, "curated", build_curated))
