"""Best-fit packing by a grouping genetic algorithm on migrating islands.

Documents become pieces of at most ``capacity`` tokens; full pieces are
sequences of their own, the others are packed.  They are dealt by a hash of
their row number into cells of a bounded number of pieces.  Each cell is packed
by several islands: a population whose members are packings.  Crossover takes
whole well-filled bins of one parent, dissolves the other parent's bins that
hold any of their pieces, and best-fits the displaced pieces, longest first,
into what room is left.  Between epochs each island's elite moves to the next
island of its cell.  The best packing of a cell counts; its poorly filled bins
are emptied and their pieces packed again across cells, until one cell is left
or a level saves fewer bins than it has cells.  Bins without room for the
smallest of those pieces are not emptied.

A cell's state is one row, of bounded size; pieces travel as numbers.  A cell
whose packing meets the lower bound (tokens / capacity, rounded up) stops.

Defined results: null text is empty, one piece holding only the end id; equal
rows are documents of their own (pieces are told apart by row number); an empty
table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.common import whole_text, written
from vellum.llm.encode import ChunkEncoder, slices, with_end

PIECE_SCHEMA = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


class Settings(NamedTuple):
    capacity: int = 2048
    cell_pieces: int = 4096
    islands: int = 2
    epochs: int = 2
    generations: int = 4
    population: int = 5
    repack_below: float = 0.97  # bins filled less than this meet the other cells' again


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of every document, each with a row number of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from pyspark import TaskContext

        encoder = ChunkEncoder(vocabulary)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, texts in slices(batch.column("text")):
                ids, lengths = with_end(*encoder.encode(texts), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                begins = np.cumsum(lengths) - lengths
                per_doc = -(-lengths // capacity)
                doc = np.repeat(np.arange(len(lengths)), per_doc)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = piece * capacity
                size = np.minimum(capacity, lengths[doc] - start)
                at = (begins[doc] + start).tolist()
                sums = [crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at, size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(len(doc))), doc_ids.take(pa.array(first + doc)),
                     pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(sums, pa.int64())],
                    names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])
                uid += len(doc)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(cut, PIECE_SCHEMA)


def best_fit(order: np.ndarray, size: np.ndarray, bin_of: np.ndarray, room: list[int], capacity: int) -> None:
    """Put pieces, in the given order, into the fullest bin that has room; ``bin_of`` and ``room`` change.

    Bins stand by their room; a bit of ``open_rooms`` per room that occurs, so
    the smallest sufficient room is the lowest bit at or above the piece's size.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room[r].append(b)
            open_rooms |= 1 << r
    for i in order.tolist():
        n = int(size[i])
        above = open_rooms >> n
        if above:
            r = n + (above & -above).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                open_rooms &= ~(1 << r)
            r -= n
        else:
            b, r = len(room), capacity - n
            room.append(r)
        room[b] = r
        bin_of[i] = b
        if r > 0:
            by_room[r].append(b)
            open_rooms |= 1 << r


def crossover(giver: np.ndarray, taker: np.ndarray, size: np.ndarray, capacity: int, rng) -> np.ndarray:
    """A child: some of the giver's fullest bins whole, the taker's untouched bins, the rest best-fitted."""
    fill = np.bincount(giver, weights=size)
    # fuller bins are likelier to go over whole; between a tenth and two fifths of all
    n_inject = max(1, int(len(fill) * rng.uniform(0.1, 0.4)))
    key = (fill / capacity) ** 8 * rng.random(len(fill))
    chosen = np.zeros(len(fill), bool)
    chosen[np.argsort(-key)[:n_inject]] = True
    injected = chosen[giver]
    hit = np.zeros(int(taker.max()) + 1, bool)
    hit[taker[injected]] = True
    taker_fill = np.bincount(taker, weights=size, minlength=len(hit))
    untouched = np.flatnonzero(~hit)
    if len(untouched):  # the poorest of the rest are dissolved too, so that a child can save a bin
        poor = untouched[np.argsort(taker_fill[untouched])[:2]]
        hit[poor] = True
    stays = ~injected & ~hit[taker]
    child = np.full(len(size), -1, np.int64)
    new_number = np.cumsum(chosen) - 1
    child[injected] = new_number[giver[injected]]
    kept_number = n_inject + np.cumsum(~hit) - 1
    child[stays] = kept_number[taker[stays]]
    room = (capacity - np.bincount(child[child >= 0], weights=size[child >= 0],
                                   minlength=n_inject + int((~hit).sum()))).astype(np.int64).tolist()
    displaced = np.flatnonzero(child < 0)
    best_fit(displaced[np.argsort(-size[displaced], kind="stable")], size, child, room, capacity)
    return np.unique(child, return_inverse=True)[1]


def fitness(packing: np.ndarray, size: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean squared filling)."""
    fill = np.bincount(packing, weights=size) / capacity
    return (-len(fill), float((fill ** 2).mean()))


def evolve(size: np.ndarray, start: list[np.ndarray], seed: int, s: Settings) -> np.ndarray:
    """The elite of one island after an epoch; ``start`` holds its own and the arrived elite, if any."""
    rng = np.random.default_rng(seed)
    bound = -(-int(size.sum()) // s.capacity)
    people = list(start)
    while len(people) < s.population:
        noise = rng.uniform(0.9, 1.1, len(size)) if people else np.ones(len(size))
        packing, room = np.zeros(len(size), np.int64), []
        best_fit(np.argsort(-size * noise, kind="stable"), size, packing, room, s.capacity)
        people.append(packing)
        if len(room) == bound:
            return packing
    ranked = sorted(((fitness(p, size, s.capacity), i, p) for i, p in enumerate(people)), key=lambda x: (x[0], -x[1]), reverse=True)
    people = [(f, p) for f, _, p in ranked]
    for _ in range(s.generations):
        for _ in range(s.population):
            if -people[0][0][0] == bound:
                return people[0][1]
            a, b = rng.choice(len(people), 2, replace=False)
            child = crossover(people[min(a, b)][1], people[max(a, b)][1], size, s.capacity, rng)
            found = fitness(child, size, s.capacity)
            if found > people[-1][0]:
                people[-1] = (found, child)
                people.sort(key=lambda x: x[0], reverse=True)
    return people[0][1]


def _epoch(islands: DataFrame, s: Settings, epoch: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = np.array(row["sizes"], np.int64)
                start = [np.array(row[k], np.int64) for k in ("elite", "arrived") if row[k] is not None]
                elite = evolve(size, start, hash((row["cell"], row["island"], epoch)) & 0x7FFFFFFF, s)
                n, full = fitness(elite, size, s.capacity)
                yield pa.RecordBatch.from_pylist([{
                    "cell": row["cell"], "island": row["island"], "uids": row["uids"], "sizes": row["sizes"],
                    "elite": elite.tolist(), "bins": -n, "filling": full}], schema=schema)

    schema = pa.schema([("cell", pa.int64()), ("island", pa.int32()), ("uids", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int64())), ("elite", pa.list_(pa.int64())), ("bins", pa.int64()),
                        ("filling", pa.float64())])
    return islands.mapInArrow(run, "cell long, island int, uids array<long>, sizes array<long>, elite array<long>, "
                                   "bins long, filling double")


def _pack_cells(parts: DataFrame, cells: int, level: int, s: Settings) -> DataFrame:
    """uid, length, level, cell, bin, offset, fill for pieces (uid, length) dealt into ``cells`` cells."""
    cell = F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(cells)).alias("cell")
    state = parts.groupBy(cell).agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("p")).select(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(s.islands - 1))).alias("island"),
        F.col("p.uid").alias("uids"), F.col("p.length").alias("sizes"),
        F.lit(None).cast("array<long>").alias("elite"), F.lit(None).cast("array<long>").alias("arrived"))
    ring = W.partitionBy("cell").orderBy("island")
    for epoch in range(s.epochs):
        state = _epoch(state.repartition("cell", "island"), s, epoch)
        if epoch + 1 < s.epochs:
            last = W.partitionBy("cell").orderBy(F.col("island").desc())
            state = (state.withColumn("arrived", F.coalesce(F.lag("elite").over(ring), F.first("elite").over(last)))
                     .drop("bins", "filling"))
    state = written(state, "packing-elites")
    best = state.groupBy("cell").agg(F.min_by(F.struct("uids", "sizes", "elite"), F.struct(
        "bins", -F.col("filling"), "island")).alias("b")).select("cell", "b.*")
    rows = best.select("cell", F.inline(F.arrays_zip(F.col("uids").alias("uid"), F.col("sizes").alias("length"),
                                                     F.col("elite").alias("bin"))))
    within = W.partitionBy("cell", "bin").orderBy("uid")
    return rows.select(
        "uid", "length", F.lit(level).alias("level"), "cell", "bin",
        F.coalesce(F.sum("length").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.sum("length").over(W.partitionBy("cell", "bin")).alias("fill"))


def pack_pieces(pieces: DataFrame, s: Settings = Settings()) -> DataFrame:
    """sequence_id and offset for every piece (columns of ``pieces_of``, which must be stored)."""
    place = ("uid", F.concat_ws("-", "level", "cell", "bin").alias("sequence"), "offset")
    full = pieces.where(F.col("length") >= s.capacity).select(
        "uid", F.concat(F.lit("full-"), F.col("uid").cast("string")).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    todo, level, done = pieces.where(F.col("length") < s.capacity).select("uid", "length"), 0, []
    n, before, held = todo.count(), None, None
    while n:
        cells = -(-n // s.cell_pieces)
        packed = written(_pack_cells(todo, cells, level, s), "packing-level")
        poor = F.col("fill") < F.lit(s.repack_below * s.capacity)
        # every piece is at least one token long, so each bin has one piece at offset 0
        bins, smallest = packed.agg(F.count_if(F.col("offset") == 0), F.min(F.when(poor, F.col("length")))).first()
        if before is not None and bins > before:
            done.append(held)  # the same pieces as the level before had them
            break
        if cells == 1 or smallest is None or before is not None and before - bins < cells:
            done.append(packed.select(*place))
            break
        again = poor & (F.col("fill") + F.lit(smallest) <= F.lit(s.capacity))
        done.append(packed.where(~again).select(*place))
        todo, held, level = packed.where(again).select("uid", "length"), packed.where(again).select(*place), level + 1
        n, before = packed.where(again).agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
    placed = full
    for d in done:
        placed = placed.unionByName(d)
    return pieces.join(placed, "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.xxhash64("sequence").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, s: Settings = Settings()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    return pack_pieces(written(pieces_of(docs, vocabulary, end_id, s.capacity), "packing-pieces"), s)
