"""Token-id files: documents in ascending id order, ids in Simple-8b segments.

A segment is a self-contained byte string: header, document table (ids and
counts), block offsets, words.  Segments are written through Spark's Parquet
writer as the container (one binary value a row), since that commits whole
files only, survives lost executors and reaches every store Spark does.

Documents are range-partitioned by id, so the parts follow each other in id
order; each part's segments carry the number of ids before them in the part,
and the parts' totals (one small row a part) give the global start.

Defined results: null text is empty and still gets its end id; a null doc_id
comes first; equal ids order by text length, then text hash, and each row is a
document.  An empty table writes no segment.  One document must fit a task.
"""

from __future__ import annotations

import struct
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm import simple8b
from vellum.llm.common import whole_text
from vellum.llm.encode import ChunkEncoder, slices, with_end
from vellum.session import new_workspace

MAGIC = b"S8B1"
SEGMENT_IDS = 1 << 18
SEGMENT_SCHEMA = "part long, segment long, start long, n_ids long, payload binary"
INDEX_SCHEMA = "part long, doc_id long, in_part long, n_tokens long, ids_crc32 long"


def pack_segment(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], np.int64)
    return b"".join([MAGIC, struct.pack("<QQQ", len(doc_ids), len(ids), len(words)), known.tobytes(), numbers.tobytes(),
                     np.asarray(lengths, np.int64).tobytes(), offsets.astype(np.uint32).tobytes(), words.tobytes()])


def unpack_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    if payload[:4] != MAGIC:
        raise ValueError("not a token-id segment")
    docs, n, n_words = struct.unpack_from("<QQQ", payload, 4)
    at = 28

    def column(kind, count):
        nonlocal at
        out = np.frombuffer(payload, kind, count, at)
        at += out.nbytes
        return out

    known, numbers, lengths = column(np.uint8, docs), column(np.int64, docs), column(np.int64, docs)
    offsets = column(np.uint32, -(-n // simple8b.BLOCK) + 1).astype(np.int64)
    ids = simple8b.decode(column(np.uint64, n_words), offsets, n).astype(np.uint32)
    return [int(d) if k else None for d, k in zip(numbers, known)], lengths, ids


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int,
                      segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text and write the segments under ``path``."""
    tie = [F.length("text"), F.xxhash64("text")]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
            .repartitionByRange("doc_id", *tie).sortWithinPartitions("doc_id", *tie))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, start = TaskContext.get().partitionId(), 0, 0
        encoder = ChunkEncoder(vocabulary)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush():
            nonlocal number, start, waiting
            ids = np.concatenate([h[2] for h in held])
            payload = pack_segment([d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), ids)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([number]), pa.array([start]), pa.array([len(ids)]), pa.array([payload], pa.binary())],
                names=["part", "segment", "start", "n_ids", "payload"])
            number, start, waiting = number + 1, start + len(ids), 0
            held.clear()
            return row

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch.column("text")):
                ids, lengths = with_end(*encoder.encode(texts), end_id)
                cut = np.concatenate([[0], np.cumsum(lengths)])
                doc = 0
                while doc < len(lengths):  # whole documents up to the segment's size
                    room = max(segment_ids - waiting, 1)
                    last = max(doc + 1, int(np.searchsorted(cut, cut[doc] + room, side="right")) - 1)
                    held.append((doc_ids[first + doc:first + last], lengths[doc:last], ids[cut[doc]:cut[last]]))
                    waiting += int(cut[last] - cut[doc])
                    doc = last
                    if waiting >= segment_ids:
                        yield flush()
        if held:
            yield flush()

    rows.mapInArrow(segments, SEGMENT_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        for batch in batches:
            for part, start, payload in zip(*(batch.column(c) for c in ("part", "start", "payload"))):
                doc_ids, lengths, ids = unpack_segment(payload.as_py())
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), part.as_py())), pa.array(doc_ids, pa.int64()),
                     pa.array(start.as_py() + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["part", "doc_id", "in_part", "n_tokens", "ids_crc32"])

    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # one row a part, as many as the write had partitions
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("ids")).select(
        "part", F.coalesce(F.sum("ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return (stored.select("part", "start", "payload").mapInArrow(index, INDEX_SCHEMA).join(parts, "part")
            .select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write ``docs`` into a new folder of the shared root and read them back."""
    spark = docs.sparkSession
    path = new_workspace(spark, "token-files")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(spark, path)
