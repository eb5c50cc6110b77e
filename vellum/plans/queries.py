"""Registered queries: one per operator of the survey's inventory.

Each takes (spark, sf_dir) and returns a DataFrame over the whole driver
tables.  Queries that exercise a writing step (T1, T2, unload, load) run that
step into a fresh folder under the shared root, then return a read of what it
wrote.  Output columns are aliased to the names of the SQL oracle; VARIANT is
returned as JSON text and geo points as WKT, since neither can be hashed.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.geo import point_wkt
from vellum.functions.numbers import try_to_number
from vellum.functions.paths import is_pdf, pdf_id, product_id
from vellum.functions.semi import json_path_text
from vellum.operators import curate, lake as lake_ops
from vellum.operators.catalog import PROCESSED_SCHEMA, RAW_SCHEMA, VERSION_KEY, raw_rows, read_table
from vellum.operators.extract import decode_files, extract_documents, payload
from vellum.operators.published import read_published
from vellum.plans import fixtures as fx
from vellum.plans.final import final_integrated
from vellum.plans.warehouse import curated_for, lake_for, processed_for
from vellum.session import new_workspace
from vellum.sources import domains, stage, walk
from vellum.sources.tables import table
from vellum.streaming import deployment, steps

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the reference's statistic (a 2019 Q3 filter there; the
# driver's facts span 1995-2001, so the same quarter position is 1999 Q3),
# its review-year filter (2024, 2025 there -> 1998, 1999 here), and the
# fixture cut that splits the stage into an earlier and a later upload.
STATS_YEAR, STATS_QUARTER = 1999, 3
EMPTY_STATS_YEAR = 1899
REVIEW_YEARS = (1998, 1999)
EARLY_UPLOAD_BEFORE = "2024-01-16"


def presentable(df: DataFrame) -> DataFrame:
    """VARIANT -> JSON text, geo struct -> WKT; everything else unchanged."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.VariantType):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.StructType) and {"lon", "lat"} <= set(f.dataType.names):
            cols.append(point_wkt(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


def _content_fixture(spark: SparkSession, sf_dir: str) -> steps.ContentTable:
    return steps.ContentTable(fx.stage_content(spark, sf_dir))


def _processed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PROCESSED as one batch job: RAW rows of the listing, parsed on executors."""
    files = raw_rows(fx.stage_listing(spark, sf_dir))
    out = extract_documents(_content_fixture(spark, sf_dir)(files))
    return out.where(F.col("parse_error").isNull()).drop("parse_error")


def _stats_part(spark, sf_dir, year=STATS_YEAR, quarter=STATS_QUARTER) -> DataFrame:
    return lake_ops.quarter_stats(lake_for(spark, sf_dir).facts_part(), year, quarter)


def _stats_nopart(spark, sf_dir, year=STATS_YEAR, quarter=STATS_QUARTER) -> DataFrame:
    return lake_ops.quarter_stats(lake_for(spark, sf_dir).facts_nopart(), year, quarter)


RAW_OUT = ["file_name", "relative_path", "file_url", "scoped_url", "size", "last_modified", "extracted"]
PROCESSED_OUT = ["pdf_id", "file_name", "relative_path", "file_url", "last_modified",
                 "pdf_metadata", "page_count", "extracted_text"]


def _raw_out(spark, root: steps.PipelineRoot) -> DataFrame:
    return presentable(read_table(spark, root.raw, RAW_SCHEMA).select(*RAW_OUT))


def _processed_out(spark, root: steps.PipelineRoot) -> DataFrame:
    return presentable(read_table(spark, root.processed, PROCESSED_SCHEMA).select(*PROCESSED_OUT))


# ---------------------------------------------------------------- scans / listing

def q_directory_listing(spark, sf_dir):
    return fx.stage_listing(spark, sf_dir).select("relative_path", "file_url", "size", "last_modified")


def q_count_documents(spark, sf_dir):
    return fx.stage_listing(spark, sf_dir).where(is_pdf("relative_path")).agg(F.count(F.lit(1)).alias("pdfs"))


def q_document_ids(spark, sf_dir):
    rows = raw_rows(fx.stage_listing(spark, sf_dir))
    return rows.select(pdf_id("relative_path").alias("pdf_id"),
                       product_id(pdf_id("relative_path")).alias("product_id"),
                       "file_name")


def q_payload_fields(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", json_path_text("props", "$.k").alias("k_text"),
                     F.length("props").alias("props_chars"))


def q_try_page_count(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id",
                     try_to_number(json_path_text("props", "$.k")).alias("k_number"),
                     try_to_number("event_type").alias("type_number"))


# ---------------------------------------------------------------- T1: register

def q_t1_register(spark, sf_dir):
    root = steps.PipelineRoot.fresh(spark, "t1")
    steps.t1_register(spark, fx.stage_listing(spark, sf_dir), root)
    return _raw_out(spark, root)


def q_t1_replay(spark, sf_dir):
    """Run T1 twice, the second time with every listing event delivered twice."""
    root = steps.PipelineRoot.fresh(spark, "t1replay")
    listing = fx.stage_listing(spark, sf_dir)
    steps.t1_register(spark, listing, root)
    steps.t1_register(spark, listing.unionByName(listing), root)
    return _raw_out(spark, root)


def q_t1_indexed(spark, sf_dir):
    """T1 by the bucketed index of RAW's version keys: an early upload, its keys compacted, the whole stage twice."""
    root = steps.PipelineRoot.fresh(spark, "t1indexed")
    listing = fx.stage_listing(spark, sf_dir)
    steps.t1_register(spark, listing.where(F.col("last_modified") < F.lit(EARLY_UPLOAD_BEFORE).cast("timestamp_ntz")), root)
    steps.compact_raw(spark, root)
    for _ in range(2):
        steps.t1_register(spark, listing, root, index=True)
    return _raw_out(spark, root)


def q_t2_retry(spark, sf_dir):
    """T1 + T2 with the content of some files missing, then T2 again with all of it there."""
    root = steps.PipelineRoot.fresh(spark, "t2retry")
    content = _content_fixture(spark, sf_dir)
    late = F.col("relative_path").like("%7%")
    steps.t1_register(spark, fx.stage_listing(spark, sf_dir), root)
    steps.t2_incremental(spark, root, steps.ContentTable(content.rows.withColumn("content", F.when(~late, F.col("content")))))
    steps.t2_incremental(spark, root, content)
    return _processed_out(spark, root)


def _two_uploads(spark, sf_dir) -> tuple[steps.PipelineRoot, str]:
    """Register the early upload, capture the stage's change events, register the rest."""
    root = steps.PipelineRoot.fresh(spark, "uploads")
    listing = fx.stage_listing(spark, sf_dir)
    early = listing.where(F.col("last_modified") < F.lit(EARLY_UPLOAD_BEFORE).cast("timestamp_ntz"))
    steps.t1_register(spark, early, root)
    events_path = f"{root.root}/stage_events"
    raw = read_table(spark, root.raw, RAW_SCHEMA)
    steps.detect_new_files(listing, raw).write.mode("overwrite").parquet(events_path)
    steps.t1_register(spark, listing, root)
    return root, events_path


def q_new_files(spark, sf_dir):
    root = steps.PipelineRoot.fresh(spark, "newfiles")
    listing = fx.stage_listing(spark, sf_dir)
    early = listing.where(F.col("last_modified") < F.lit(EARLY_UPLOAD_BEFORE).cast("timestamp_ntz"))
    steps.t1_register(spark, early, root)
    raw = read_table(spark, root.raw, RAW_SCHEMA)
    return (steps.detect_new_files(listing, raw)
            .select("relative_path", "file_url", "size", "last_modified")
            .orderBy("relative_path"))


def q_t2_join_raw(spark, sf_dir):
    root, events_path = _two_uploads(spark, sf_dir)
    events = spark.read.parquet(events_path).select(*VERSION_KEY)
    raw = read_table(spark, root.raw, RAW_SCHEMA)
    return events.join(raw, VERSION_KEY, "inner").select("file_name", "relative_path", "file_url", "last_modified")


def _real_stage(spark, sf_dir) -> str:
    """The fixture's files written into a real stage folder (with their mtimes)."""
    stage_dir = new_workspace(spark, "stage") + "/docs_stage"
    stage.upload(fx.stage_files(spark, sf_dir), stage_dir)
    return stage_dir


def q_stage_listing_files(spark, sf_dir):
    """DIRECTORY(@stage) over real files: binaryFile listing, content never read."""
    listing = stage.list_stage(spark, _real_stage(spark, sf_dir))
    return listing.select("relative_path", "size", "last_modified")


def q_stage_walk_files(spark, sf_dir):
    """DIRECTORY(@stage) over real files, listed by the executors folder by folder."""
    return walk.walk_stage(spark, _real_stage(spark, sf_dir)).select("relative_path", "size", "last_modified")


def q_stage_walk_t1(spark, sf_dir):
    """T1 over a walked stage twice: the second walk finds the same versions and registers nothing."""
    stage_dir = _real_stage(spark, sf_dir)
    root = steps.PipelineRoot.fresh(spark, "walkrun")
    for _ in range(2):
        steps.t1_register(spark, walk.walk_stage(spark, stage_dir), root)
    return read_table(spark, root.raw, RAW_SCHEMA).select("file_name", "relative_path", "size", "last_modified")


def q_stage_t1_t2(spark, sf_dir):
    """T1 on the real stage listing, T2 reading each new file's bytes by path on executors."""
    stage_dir = _real_stage(spark, sf_dir)
    root = steps.PipelineRoot.fresh(spark, "stagerun")
    steps.t1_register(spark, stage.list_stage(spark, stage_dir), root)
    steps.t2_incremental(spark, root, lambda todo: todo)   # each task opens its files by scoped_url
    out = read_table(spark, root.processed, PROCESSED_SCHEMA)
    return presentable(out.select(*[c for c in PROCESSED_OUT if c != "file_url"]))


# ---------------------------------------------------------------- T2: extract

def q_extract_documents(spark, sf_dir):
    return presentable(_processed_batch(spark, sf_dir).select(*PROCESSED_OUT))


def q_extract_sample(spark, sf_dir):
    """UDF smoke call on two files (ordered, so the two are fixed)."""
    files = (raw_rows(fx.stage_listing(spark, sf_dir))
             .select("relative_path").orderBy("relative_path").limit(2))
    with_content = _content_fixture(spark, sf_dir)(files)
    p = decode_files(with_content, "content").select("relative_path", payload(F.col("decoded")).alias("p"))
    parsed = F.to_json(F.struct(F.try_parse_json("p.metadata").alias("metadata"),
                                F.col("p.page_count").alias("page_count"),
                                F.col("p.chars").alias("chars"),
                                F.col("p.text").alias("text")))
    return p.select("relative_path", parsed.alias("parsed"))


def q_t2_incremental(spark, sf_dir):
    """Two uploads, T1 + T2 after each: the second T2 parses only the new rows."""
    root = steps.PipelineRoot.fresh(spark, "t2")
    listing = fx.stage_listing(spark, sf_dir)
    content = _content_fixture(spark, sf_dir)
    early = listing.where(F.col("last_modified") < F.lit(EARLY_UPLOAD_BEFORE).cast("timestamp_ntz"))
    steps.t1_register(spark, early, root)
    steps.t2_incremental(spark, root, content)
    steps.t1_register(spark, listing, root)
    steps.t2_incremental(spark, root, content)
    return _processed_out(spark, root)


WAVE_FILES = 25


def q_t2_waves(spark, sf_dir):
    """A backlog in one RAW file, extracted in waves of 25 documents: the documents each wave appended."""
    root = steps.PipelineRoot.fresh(spark, "t2waves")
    steps.t1_register(spark, fx.stage_listing(spark, sf_dir).coalesce(1), root)
    steps.t2_incremental(spark, root, _content_fixture(spark, sf_dir), max_files=WAVE_FILES)
    done = read_table(spark, root.processed, PROCESSED_SCHEMA).groupBy("insert_ts").agg(F.count(F.lit(1)).alias("n_files"))
    return done.select((F.row_number().over(W.orderBy("insert_ts")) - 1).cast("bigint").alias("wave"), "n_files")


DOCUMENTS_VIEW = """SELECT r.relative_path, r.size, p.pdf_id, p.page_count
FROM {schema}.pdf_raw_file_catalog r
LEFT JOIN {schema}.pdf_processed_file_catalog p ON r.relative_path = p.relative_path AND r.last_modified = p.last_modified"""
PRODUCTS_VIEW = """SELECT split_part(pdf_id, '_', 1) AS product_id, count(*) AS n_files, sum(size) AS n_bytes,
       CAST(sum(page_count) AS BIGINT) AS n_pages FROM {schema}.documents GROUP BY 1"""


def q_deployment_reset(spark, sf_dir):
    """Views defined over an early upload, reset, the whole run anew; another session reads the stored views."""
    folder = new_workspace(spark, "deployment")
    d = deployment.Deployment(folder, "docs_" + folder.rsplit("-", 1)[1])
    listing, content = fx.stage_listing(spark, sf_dir), _content_fixture(spark, sf_dir)
    root = deployment.open_deployment(spark, d)
    deployment.define_view(spark, d, "documents", DOCUMENTS_VIEW)
    deployment.define_view(spark, d, "products", PRODUCTS_VIEW, needs=("documents",))
    steps.t1_register(spark, listing.where(F.col("last_modified") < F.lit(EARLY_UPLOAD_BEFORE).cast("timestamp_ntz")), root)
    root = deployment.reset(spark, d)
    steps.t1_register(spark, listing, root)
    steps.t2_incremental(spark, root, content)
    other = spark.newSession()
    deployment.open_deployment(other, d)
    return deployment.read_view(other, d, "products")


def q_t2_replay(spark, sf_dir):
    """T2 twice on the same offset, then a full replay from a fresh checkpoint."""
    root = steps.PipelineRoot.fresh(spark, "t2replay")
    content = _content_fixture(spark, sf_dir)
    steps.t1_register(spark, fx.stage_listing(spark, sf_dir), root)
    steps.t2_incremental(spark, root, content)
    steps.t2_incremental(spark, root, content)
    steps.t2_incremental(spark, root, content, checkpoint=f"{root.root}/_checkpoints/t2_replay")
    return _processed_out(spark, root)


def _run_pipeline(spark, sf_dir) -> tuple[steps.PipelineRoot, dict[str, DataFrame]]:
    root = steps.PipelineRoot.fresh(spark, "run")
    views = steps.run_once(
        spark, root, fx.stage_listing(spark, sf_dir), _content_fixture(spark, sf_dir),
        curated_for(spark, sf_dir),
        {"final_integrated_part": _stats_part(spark, sf_dir),
         "final_integrated_nopart": _stats_nopart(spark, sf_dir)})
    return root, views


def q_row_counts(spark, sf_dir):
    root, _ = _run_pipeline(spark, sf_dir)
    raw = read_table(spark, root.raw, RAW_SCHEMA).agg(
        F.lit("raw").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    processed = read_table(spark, root.processed, PROCESSED_SCHEMA).agg(
        F.lit("processed").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    return raw.unionByName(processed)


def q_pipeline_end_to_end(spark, sf_dir):
    _, views = _run_pipeline(spark, sf_dir)
    return presentable(views["final_integrated_part"])


def q_run_history(spark, sf_dir):
    root, _ = _run_pipeline(spark, sf_dir)
    return steps.run_history(spark, root).select("name", "state", "rows_added", "scheduled_time", "completed_time")


# ---------------------------------------------------------------- curation

def q_media_by_product(spark, sf_dir):
    return curate.media_summary(fx.media(spark, sf_dir))


def q_curated_media(spark, sf_dir):
    return curate.product_media(fx.media(spark, sf_dir))


def q_returns_by_product(spark, sf_dir):
    return curate.returns_summary(fx.returns(spark, sf_dir)).select(
        "product_id", "return_count", F.col("return_qty").alias("return_qty"))


def q_curated_feedback(spark, sf_dir):
    return presentable(fx.curated(spark, sf_dir))


def q_geo_points(spark, sf_dir):
    from vellum.functions.geo import st_point
    s = fx.suppliers(spark, sf_dir).select(
        F.lit("supplier").alias("entity_type"), F.col("supplier_id").alias("entity_id"), "name", "lon", "lat")
    c = (table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("entity_type"), F.col("c_custkey").alias("entity_id"),
        F.col("c_name").alias("name"), (F.col("c_nationkey") * 10.0 - 120.0).alias("lon"),
        (F.col("c_nationkey") * 3.0 - 36.0).alias("lat")))
    pts = s.unionByName(c)
    return presentable(pts.withColumn("geo_point", st_point(F.col("lon"), F.col("lat"))))


def q_flatten_product_json(spark, sf_dir):
    levels = [f"l{i}" for i in range(1, fx.JSON_LEVELS + 1)]
    flat = curate.flatten_json(fx.product_json(spark, sf_dir), "product_json", levels, keep=["p_partkey"], fields=("level",))
    inner = range(1, fx.JSON_LEVELS)
    return flat.select("p_partkey", *(f"pos{i}" for i in inner), *(F.col(f"level_{i}").cast("int").alias(f"level_{i}") for i in inner),
                       F.col(f"pos{fx.JSON_LEVELS}").alias("pos"),
                       F.try_variant_get("node", "$.value", "int").alias("value"),
                       F.try_variant_get("node", "$.brand", "string").alias("brand"))


def _layered(spark, sf_dir, loads: int):
    from vellum.operators import layers
    root = new_workspace(spark, "layers")
    domains.stage(spark, sf_dir, f"{root}/stage")
    for _ in range(loads):
        raw = domains.load(spark, root)
    stg = layers.build_stg(spark, raw, f"{root}/stg")
    path = layers.build_curated(spark, stg, fx.customers(spark, sf_dir), fx.nations(spark, sf_dir),
                                f"{root}/curated/product_feedback")
    return presentable(spark.read.parquet(path))


def q_layered_curation(spark, sf_dir):
    """Five domains staged and loaded (RAW), cleaned (STG), joined at review grain (CURATED)."""
    return _layered(spark, sf_dir, 1)


def q_reload_domains(spark, sf_dir):
    """The same with every load run twice: files already loaded add nothing."""
    return _layered(spark, sf_dir, 2)


def q_load_raw_domains(spark, sf_dir):
    root = new_workspace(spark, "domains")
    return domains.load_counts(spark, domains.stage_and_load(spark, sf_dir, root))


def q_corrected_returns(spark, sf_dir):
    """Returns loaded once, a load that dies before its commit, corrected files dropped over the old ones, loaded
    twice: every file counts once, in its newest version."""
    from vellum.operators import layers
    root = new_workspace(spark, "corrected")
    d = next(x for x in domains.DOMAINS if x.name == "returns_issues")
    stage_dir, raw = f"{root}/stage/returns_issues", f"{root}/raw/returns_issues"
    stage.upload(fx.returns_files(spark, sf_dir, corrected=False), stage_dir)
    domains.write_load(spark, d, domains.files_to_load(spark, stage_dir, raw), raw)  # never published
    domains.copy_into(spark, d, stage_dir, raw)
    stage.upload(fx.returns_files(spark, sf_dir, corrected=True), stage_dir)
    for _ in range(2):
        domains.copy_into(spark, d, stage_dir, raw)
    return curate.returns_summary(layers.stg_returns(domains.loaded(spark, raw)))


# ---------------------------------------------------------------- lake / stats

def q_stats_part(spark, sf_dir):
    return _stats_part(spark, sf_dir)


def q_stats_nopart(spark, sf_dir):
    return _stats_nopart(spark, sf_dir)


def q_stats_part_csv(spark, sf_dir):
    return lake_ops.quarter_stats(lake_for(spark, sf_dir).csv_facts_part(), STATS_YEAR, STATS_QUARTER)


def q_stats_nopart_csv(spark, sf_dir):
    return lake_ops.quarter_stats(lake_for(spark, sf_dir).csv_facts_nopart(), STATS_YEAR, STATS_QUARTER)


def q_mv_ontime_monthly(spark, sf_dir):
    return lake_for(spark, sf_dir).mv().select(
        "year", "quarter", "month", "n_flights", "n_arr_delay", "sum_arr_delay", "n_cancelled", "sum_cancelled")


def q_mv_rollup_quarter(spark, sf_dir):
    return lake_ops.rollup_quarter(lake_for(spark, sf_dir).mv())


def q_mv_stats(spark, sf_dir):
    return lake_ops.quarter_stats_from_mv(lake_for(spark, sf_dir).mv(), STATS_YEAR, STATS_QUARTER)


def q_mv_refresh_loads(spark, sf_dir):
    """The monthly aggregate refreshed after each of three loads of facts, the last one without news: each refresh
    computes the months that got rows and publishes a version; this reads the one that counts."""
    root = new_workspace(spark, "mvloads")
    facts = fx.ontime(spark, sf_dir)
    late = (F.col("year") == STATS_YEAR) & (F.col("flight_key") % 2 == 0)
    for number, part in ((1, facts.where(~late)), (2, facts.where(late))):
        part.withColumn("load_number", F.lit(number)).write.mode("append").parquet(f"{root}/facts")
        lake_ops.refresh_published(spark, spark.read.parquet(f"{root}/facts"), f"{root}/monthly", "load_number")
    lake_ops.refresh_published(spark, spark.read.parquet(f"{root}/facts"), f"{root}/monthly", "load_number")
    return read_published(spark, f"{root}/monthly").select(
        "year", "quarter", "month", "n_flights", "n_arr_delay", "sum_arr_delay", "n_cancelled", "sum_cancelled")


def q_unload_partitioned(spark, sf_dir):
    """CSV unload into year/quarter/month folders, read back with an explicit schema."""
    root = new_workspace(spark, "unload") + "/ontime_csv"
    facts = fx.ontime(spark, sf_dir)
    lake_ops.unload(facts, root, "csv", partitioned=True, replace="all")
    back = lake_ops.external_table(spark, root, "csv", schema=facts.schema)
    return (back.groupBy("year", "quarter", "month")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum("arr_delay").cast("bigint").alias("sum_arr_delay"),
                 F.sum("cancelled").cast("bigint").alias("sum_cancelled")))


# ---------------------------------------------------------------- final views

def _final(spark, sf_dir, stats: DataFrame) -> DataFrame:
    """The view over the PROCESSED table (built once per session by the batch
    extraction job; the streaming T2 builds the same table incrementally)."""
    return final_integrated(processed_for(spark, sf_dir), curated_for(spark, sf_dir), stats)


def q_final_integrated(spark, sf_dir):
    return presentable(_final(spark, sf_dir, _stats_part(spark, sf_dir)))


def q_final_nopart(spark, sf_dir):
    return presentable(_final(spark, sf_dir, _stats_nopart(spark, sf_dir)))


def q_final_filtered(spark, sf_dir):
    view = _final(spark, sf_dir, _stats_part(spark, sf_dir))
    # ORDER BY review_date DESC.  Ties may come in any order, so the extra keys
    # change nothing in the required order; they let the range partitioner
    # split a date that holds a large share of the rows over several tasks.
    return presentable(view.where(F.col("review_year").isin(*REVIEW_YEARS))
                       .orderBy(F.col("review_date").desc(), "relative_path",
                                F.xxhash64("review_text")))


def q_final_empty_stats(spark, sf_dir):
    return presentable(_final(spark, sf_dir, _stats_part(spark, sf_dir, EMPTY_STATS_YEAR, STATS_QUARTER)))


def q_final_count(spark, sf_dir):
    view = _final(spark, sf_dir, _stats_part(spark, sf_dir))
    return view.agg(F.count(F.lit(1)).alias("rows_cnt"))


QUERIES: dict[str, Query] = {
    "directory_listing": q_directory_listing,
    "count_documents": q_count_documents,
    "document_ids": q_document_ids,
    "payload_fields": q_payload_fields,
    "try_page_count": q_try_page_count,
    "t1_register": q_t1_register,
    "t1_replay": q_t1_replay,
    "t1_indexed": q_t1_indexed,
    "new_files": q_new_files,
    "t2_join_raw": q_t2_join_raw,
    "stage_listing_files": q_stage_listing_files,
    "stage_walk_files": q_stage_walk_files,
    "stage_walk_t1": q_stage_walk_t1,
    "stage_t1_t2": q_stage_t1_t2,
    "extract_documents": q_extract_documents,
    "extract_sample": q_extract_sample,
    "t2_incremental": q_t2_incremental,
    "t2_retry": q_t2_retry,
    "t2_replay": q_t2_replay,
    "t2_waves": q_t2_waves,
    "deployment_reset": q_deployment_reset,
    "row_counts": q_row_counts,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "run_history": q_run_history,
    "media_by_product": q_media_by_product,
    "curated_media": q_curated_media,
    "returns_by_product": q_returns_by_product,
    "curated_feedback": q_curated_feedback,
    "geo_points": q_geo_points,
    "flatten_product_json": q_flatten_product_json,
    "load_raw_domains": q_load_raw_domains,
    "corrected_returns": q_corrected_returns,
    "layered_curation": q_layered_curation,
    "reload_domains": q_reload_domains,
    "stats_part": q_stats_part,
    "stats_nopart": q_stats_nopart,
    "stats_part_csv": q_stats_part_csv,
    "stats_nopart_csv": q_stats_nopart_csv,
    "mv_ontime_monthly": q_mv_ontime_monthly,
    "mv_rollup_quarter": q_mv_rollup_quarter,
    "mv_stats": q_mv_stats,
    "mv_refresh_loads": q_mv_refresh_loads,
    "unload_partitioned": q_unload_partitioned,
    "final_integrated": q_final_integrated,
    "final_nopart": q_final_nopart,
    "final_filtered": q_final_filtered,
    "final_empty_stats": q_final_empty_stats,
    "final_count": q_final_count,
}
