"""The incremental pipeline: T1 -> T2 -> T3.

T1  register   list the stage afresh, keep PDFs, append versions not yet in RAW
               (snapshot diff: listing LEFT ANTI JOIN RAW on path + mtime).
               Metadata only: file bytes are never read here.
T2  extract    a Structured Streaming query over the append-only RAW folder.
               Its checkpoint is the stream offset: each run sees only RAW rows
               appended since the last run; ``availableNow`` runs no batch when
               nothing is new.  Each micro-batch dedups, anti-joins PROCESSED
               (so a replayed batch appends nothing) and is extracted in waves
               bounded by files and bytes: bytes read, parsed and appended.
T3  model      (re)defines the final views; no data moves.

Why T1 is not the streaming file source: that source misses an overwritten
file whose mtime moved a little and new files older than its ``maxFileAge``;
a listing diff on the version key finds both by construction.
"""

from __future__ import annotations

import collections
import datetime as dt
import re
import threading
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.admission import admitted, size_of
from vellum.operators.catalog import (PROCESSED_SCHEMA, QUARANTINE_SCHEMA, RAW_SCHEMA, VERSION_KEY,
                                      append_new, create_table, new_versions, quarantine,
                                      raw_rows, read_table)
from vellum.operators.extract import RETRY, extraction
from vellum.operators.versions import compact, unseen
from vellum.session import drop_folder, move_files, new_workspace

HISTORY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("scheduled_time", T.TimestampType()),
    T.StructField("completed_time", T.TimestampType()),
    T.StructField("rows_added", T.LongType()),
    T.StructField("error", T.StringType()),
])


@dataclass(frozen=True)
class PipelineRoot:
    """Folders of one pipeline deployment, all under the shared root."""
    root: str

    @classmethod
    def fresh(cls, spark: SparkSession, label: str = "pipeline") -> "PipelineRoot":
        return cls(new_workspace(spark, label))

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/pdf_raw_file_catalog"

    @property
    def raw_versions(self) -> str:
        return f"{self.root}/raw/pdf_raw_versions"

    @property
    def parsed(self) -> str:
        return f"{self.root}/raw/pdf_processed_file_catalog"

    @property
    def processed(self) -> str:
        return f"{self.parsed}/outcome=good"

    @property
    def failed(self) -> str:
        return f"{self.parsed}/outcome=bad"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/raw/pdf_quarantine"

    @property
    def t2_checkpoint(self) -> str:
        return f"{self.root}/_checkpoints/t2"

    @property
    def history(self) -> str:
        return f"{self.root}/raw/task_history"


ContentFn = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ContentTable:
    """Contents that lie in a table (relative_path, content).

    A ``ContentFn`` is applied to each wave; a join there would shuffle the whole table once a wave.  This one is
    joined to a batch once, and its waves read their own rows of what the join gave.
    """
    rows: DataFrame

    def __call__(self, todo: DataFrame) -> DataFrame:
        return todo.join(self.rows, "relative_path", "left")


def detect_new_files(listing: DataFrame, raw: DataFrame) -> DataFrame:
    """Stage listing rows (PDFs) whose version is not in RAW yet."""
    return new_versions(raw_rows(listing), raw, VERSION_KEY)


def t1_register(spark: SparkSession, listing: DataFrame, root: PipelineRoot, index: bool = False) -> int:
    """Returns the number of versions registered.  ``index``: RAW is asked through its index of version keys, as
    ``compact_raw`` left it, so that the run shuffles the listing and not what is stored."""
    known = (lambda rows, raw: unseen(spark, rows, raw, root.raw_versions)) if index else None
    return append_new(spark, raw_rows(listing), root.raw, RAW_SCHEMA, VERSION_KEY, root.quarantine, known)


def compact_raw(spark: SparkSession, root: PipelineRoot) -> int:
    """Bring the index of RAW's version keys up to date; the number of its buckets."""
    return compact(spark, read_table(spark, root.raw, RAW_SCHEMA), root.raw_versions)


PARSED_SCHEMA = T.StructType([*PROCESSED_SCHEMA.fields, T.StructField("parse_error", T.StringType())])

# The bound of one wave of extraction: files, and bytes of them.
MAX_FILES, MAX_BYTES = 1000, 8 << 30
BESIDE = 8  # waves under way at once, at most
KILLED = "killed its task: "
# What Spark says of a task whose worker or executor died, as against one that raised.
DEATHS = r"worker exited unexpectedly|Python worker.*crashed|ExecutorLostFailure|OutOfMemoryError|EOFException|Connection reset"


class _Batch:
    """A batch on its way into PROCESSED: what its waves share."""

    def __init__(self, spark: SparkSession, root: PipelineRoot, content_for: ContentFn, work: str, schema: T.StructType):
        self.spark, self.root, self.content_for, self.work = spark, root, content_for, work
        self.schema = T.StructType([f for f in schema.fields if f.name != "wave"])
        self.failed: list[str] = []  # appended files whose rows belong into the quarantine
        self.turn = threading.Condition()  # re-entrant
        self._last = _now()
        self._parsers: dict[tuple, Callable] = {}

    def stamp(self) -> dt.datetime:
        """The time of an append, later than every one before."""
        with self.turn:
            self._last = max(_now(), self._last + dt.timedelta(microseconds=1))
            return self._last

    def files(self, wave: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.work}/todo/wave={wave}")

    def parsed(self, files: DataFrame, stamp: dt.datetime) -> DataFrame:
        """The files' rows of PARSED_SCHEMA and their ``outcome``; expressions are built once for all waves."""
        kind = tuple(files.dtypes)
        with self.turn:
            if kind not in self._parsers:
                self._parsers[kind] = (extraction(files.dtypes), [
                    *(F.col(f.name).cast(f.dataType).alias(f.name) for f in PARSED_SCHEMA.fields),
                    F.when(F.col("parse_error").isNull(), "good").otherwise("bad").alias("outcome")])
        extract, row = self._parsers[kind]
        return extract(files).withColumn("insert_ts", F.lit(stamp)).select(*row)


def _write_parsed(batch: _Batch, files: DataFrame, stamp: dt.datetime) -> int:
    """Parse once, into a folder of its own, and append its files: the good rows are PROCESSED, the others lie beside
    it; the number of the others.  A job that fails appends nothing."""
    own, seen = f"{batch.work}/parsed/{uuid.uuid4().hex}", Observation()
    parsed = batch.parsed(batch.content_for(files.drop("place")), stamp)
    parsed.observe(seen, F.count("parse_error").alias("bad")).write.partitionBy("outcome").parquet(own)
    move_files(batch.spark, f"{own}/outcome=good", batch.root.processed)
    batch.failed += move_files(batch.spark, f"{own}/outcome=bad", batch.root.failed)
    return seen.get["bad"]


def _parse(batch: _Batch, wave: int, first: int, last: int) -> int:
    """Parse the files of a wave with places from ``first`` to ``last``; the number of those that failed.

    A job whose worker dies leaves nothing; its files are halved until the one that kills is alone, and that one is
    quarantined.  Errors that a task raises stop the step as ever.
    """
    files = batch.files(wave).where(F.col("place").between(first, last))
    try:
        return _write_parsed(batch, files, batch.stamp())
    except Exception as e:
        if not re.search(DEATHS, str(e)):
            raise
        if first == last:
            reason = F.lit(f"{KILLED}{type(e).__name__}")
            quarantine(batch.spark, files.select("relative_path", "last_modified", reason.alias("reason")), batch.root.quarantine)
            return 1
        middle = (first + last) // 2
        return sum(_parse(batch, wave, a, z) for a, z in ((first, middle), (middle + 1, last)))


def _extract_waves(batch: _Batch, waves: list) -> int:
    """Extract and append every wave, each in a job of its own; the number of rows appended.

    Waves begin in their order, and small ones run beside each other: BESIDE at most, and together never more files
    and bytes than MAX_FILES and MAX_BYTES.  A wave whose worker died may have died of its neighbour, so it is tried
    again, and halved, when the others are done.  The first other error lets what is under way end and stops the step.
    """
    left, under_way, faults, again, appended = collections.deque(waves), [], [], [], []

    def room() -> bool:
        held = [*under_way, left[0]]
        return len(held) == 1 or sum(w.files for w in held) <= MAX_FILES and sum(w.bytes for w in held) <= MAX_BYTES

    def extract() -> None:
        while True:
            with batch.turn:
                batch.turn.wait_for(lambda: faults or not left or room())
                if faults or not left:
                    return
                under_way.append(w := left.popleft())
                stamp = batch.stamp()
            try:
                appended.append(w.files - _write_parsed(batch, batch.files(w.wave), stamp))
            except Exception as e:
                if re.search(DEATHS, str(e)):
                    again.append(w)
                else:
                    faults.append(e)
            finally:
                with batch.turn:
                    under_way.remove(w)
                    batch.turn.notify_all()

    # a thread's wrapper has a copy of the local properties (job group) that only this thread changes
    threads = [threading.Thread(target=inheritable_thread_target(batch.spark)(extract)) for _ in waves[:BESIDE]]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if faults:
        raise faults[0]
    return sum(appended) + sum(w.files - _parse(batch, w.wave, w.first, w.last) for w in again)


def _process_batch(spark: SparkSession, root: PipelineRoot, content_for: ContentFn, batch: DataFrame,
                   max_files: int = MAX_FILES, max_bytes: int = MAX_BYTES) -> int:
    """Parse the batch's versions that are neither in PROCESSED nor refused, wave by wave; returns the rows appended.

    A wave is bounded by files and bytes and appended as a whole when its job ends, so a run that dies goes on where
    it stopped.  A file that is opened and undecodable, or absent, is quarantined for good; one that couldn't be
    opened is quarantined with a RETRY reason.  The quarantine is written once, when the batch ends or fails; after
    a driver's death in between, the files of the batch that failed are tried again.
    """
    done = read_table(spark, root.processed, PROCESSED_SCHEMA)
    refused = read_table(spark, root.quarantine, QUARANTINE_SCHEMA).where(~F.col("reason").startswith(RETRY))
    todo = new_versions(batch, done, VERSION_KEY).join(refused.select(*VERSION_KEY), VERSION_KEY, "left_anti")
    # in a table of their own, a folder a wave: what the waves append to PROCESSED must not change the list
    work = f"{root.root}/_work/{uuid.uuid4().hex}"
    listed = admitted(todo, max_files, max_bytes)
    if isinstance(content_for, ContentTable):
        listed, content_for = content_for(listed), lambda files: files
    running = _Batch(spark, root, content_for, work, listed.schema)
    try:
        listed.hint("rebalance", "wave").write.partitionBy("wave").parquet(f"{work}/todo")
        todo = read_table(spark, f"{work}/todo", listed.schema)
        waves = todo.groupBy("wave").agg(
            F.min("place").alias("first"), F.max("place").alias("last"), (F.max("place") - F.min("place") + 1).alias("files"),
            F.sum(size_of()).alias("bytes")).orderBy("wave").collect()
        try:
            return _extract_waves(running, waves)
        finally:
            if running.failed:
                failed = spark.read.schema(PARSED_SCHEMA).parquet(*running.failed)
                quarantine(spark, failed.select("relative_path", "last_modified", F.col("parse_error").alias("reason")), root.quarantine)
    finally:
        drop_folder(spark, work)


def retry_failed(spark: SparkSession, root: PipelineRoot, content_for: ContentFn, **bounds: int) -> int:
    """Try again every RAW version that is quarantined for a retry and not in PROCESSED."""
    failed = (read_table(spark, root.quarantine, QUARANTINE_SCHEMA)
              .where(F.col("reason").startswith(RETRY)).select(*VERSION_KEY).distinct())
    if failed.isEmpty():
        return 0
    raw = read_table(spark, root.raw, RAW_SCHEMA).join(failed, VERSION_KEY, "left_semi")
    return _process_batch(spark, root, content_for, raw, **bounds)


def t2_incremental(spark: SparkSession, root: PipelineRoot, content_for: ContentFn, checkpoint: str | None = None,
                   every: str | None = None, max_files: int = MAX_FILES, max_bytes: int = MAX_BYTES):
    """Retry what failed before, run T2 until RAW is caught up (trigger availableNow), then
    return the number of rows appended.  A micro-batch is what RAW got since the last one (names and sizes); its
    documents are extracted in waves of ``max_files`` and ``max_bytes`` at most, however RAW's files hold them.

    ``every="1 minute"`` instead starts it as a standing query on that
    processing-time schedule and returns the StreamingQuery handle; new files
    still need T1 to register them (``run_every`` does both).
    """
    create_table(spark, root.raw, RAW_SCHEMA)
    create_table(spark, root.processed, PROCESSED_SCHEMA)
    stream = spark.readStream.schema(RAW_SCHEMA).parquet(root.raw)
    bounds = {"max_files": max_files, "max_bytes": max_bytes}
    added = [retry_failed(spark, root, content_for, **bounds)]
    query = (stream.writeStream
             .foreachBatch(lambda df, _epoch: added.append(_process_batch(df.sparkSession, root, content_for, df, **bounds)))
             .option("checkpointLocation", checkpoint or root.t2_checkpoint))
    if every:
        return query.trigger(processingTime=every).start()
    query.trigger(availableNow=True).start().awaitTermination()
    return sum(added)


def run_every(spark: SparkSession, root: PipelineRoot, listing: Callable[[], DataFrame], content_for: ContentFn,
              every: str = "1 minute", **bounds: int):
    """The standing schedule: at each tick T1 lists the stage afresh and registers, then T2 extracts what is new.

    Returns the StreamingQuery whose trigger is the clock.  A tick begins when the one before has ended.
    """
    def tick(_: DataFrame, _epoch: int) -> None:
        t1_register(spark, listing(), root)
        t2_incremental(spark, root, content_for, **bounds)

    clock = spark.readStream.format("rate").option("rowsPerSecond", "1").option("numPartitions", "1").load()
    return (clock.writeStream.foreachBatch(tick).option("checkpointLocation", f"{root.root}/_checkpoints/clock")
            .trigger(processingTime=every).start())


def t3_views(spark: SparkSession, root: PipelineRoot, curated: DataFrame,
             stats_by_view: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """CREATE OR REPLACE VIEW for each stats source (partitioned / flat)."""
    from vellum.plans.final import final_integrated

    processed = read_table(spark, root.processed, PROCESSED_SCHEMA)
    views = {}
    for name, stats in stats_by_view.items():
        view = final_integrated(processed, curated, stats)
        view.createOrReplaceTempView(name)
        views[name] = view
    return views


def _write_history(spark: SparkSession, root: PipelineRoot, rows: list[tuple]) -> None:
    if rows:
        spark.createDataFrame(rows, HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(root.history)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def run_once(spark: SparkSession, root: PipelineRoot, listing: DataFrame, content_for: ContentFn,
             curated: DataFrame, stats_by_view: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """EXECUTE TASK T1: T1, then T2, then T3, each awaited; one history row per step,
    written together when the run ends.  A failed step is logged and stops the
    run (later steps do not start)."""
    steps = [
        ("t1_register", lambda: t1_register(spark, listing, root)),
        ("t2_extract", lambda: t2_incremental(spark, root, content_for)),
    ]
    history: list[tuple] = []
    try:
        for name, fn in steps:
            started = _now()
            try:
                n = fn()
            except Exception as e:
                history.append((name, "FAILED", started, _now(), None, f"{type(e).__name__}: {e}"))
                raise
            history.append((name, "SUCCEEDED", started, _now(), n, None))
        started = _now()
        views = t3_views(spark, root, curated, stats_by_view)
        history.append(("t3_model", "SUCCEEDED", started, _now(), 0, None))
        return views
    finally:
        _write_history(spark, root, history)


def run_history(spark: SparkSession, root: PipelineRoot, name_like: str = "%t%",
                hours: int = 1, limit: int = 50) -> DataFrame:
    """TASK_HISTORY of the last ``hours``, newest ``limit`` runs."""
    h = read_table(spark, root.history, HISTORY_SCHEMA)
    since = F.current_timestamp() - F.make_interval(hours=F.lit(hours))
    return (h.where((F.col("scheduled_time") >= since) & F.col("name").ilike(name_like))
            .orderBy(F.col("completed_time").desc())
            .limit(limit))
