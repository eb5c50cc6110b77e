"""Exact top-k by inner product with norm-bucketed retrieval.

Vectors are turned into integers, ranged by length and packed into blocks of
neighbours in length (a bounded number of vectors each, as one binary row), so
that a block is a bucket of almost equal lengths.  Queries are packed into
blocks as well, and a grid deals every (query block, vector block) pair to a
cell of its own: stated queries against all rows, in blocks.

A query's running threshold is its k-th best product so far; it starts from the
longest vectors (a bounded seed).  Per bucket the threshold over the query's
length and the bucket's largest length is a local cosine threshold:

* above 1 nothing in the bucket can reach it, the bucket is skipped;
* if it is high, coordinate pruning: a unit vector within that cosine has to
  lie near the query in each of the query's largest coordinates;
* else length pruning: only vectors long enough for the threshold are left.

What is left is verified by exact integer products.  Products are computed in
float64 while |a| |b| < 2^53 (every partial sum is an exact integer then), in
Python integers beyond.

Defined results: vectors that are null, or hold null, NaN or infinite
components, take no part; only vectors of equal dimension are compared; a query
never finds rows with its own id; repeated rows of an id are candidates each,
repeated queries one query, an id's different vectors a query each; a null id
can be found but not ask; scores saturate at 64 bits before they are ranked.
Ties go to the smaller id (null last).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.common import written

BLOCK = 2048
BUCKET = 256
SEED_ROWS = 1024
COORDINATES = 3
HIGH_COSINE = 0.8
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)
BLOCK_SCHEMA = "block long, dim int, n int, longest double, ids binary, vectors binary"
RESULT_SCHEMA = "q_block long, q_at long, query_id long, vec_id long, score long"


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as double (integers up to 2^53 exactly); null if one is not finite."""
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor of a double gives a long in SQL; x - pmod(x, 1) stays a double
    scaled = F.transform(vector, lambda x: x.cast("double") * float(scale))
    return F.when(sound, F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)))


def pack(rows: DataFrame) -> DataFrame:
    """Blocks of vectors (vec_id, v, length), by falling length."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def flush(dim):
            nonlocal number
            got = held.pop(dim)
            row = {"block": number, "dim": dim, "n": len(got), "longest": max(g[3] for g in got),
                   "ids": np.array([g[0] for g in got], np.int64).tobytes() + np.array([g[1] for g in got], bool).tobytes(),
                   "vectors": np.array([g[2] for g in got], np.float64).reshape(len(got), dim).tobytes()}
            number += 1
            return pd.DataFrame([row])

        for frame in batches:
            for vec_id, unnamed, v, length in zip(frame["vec_id"], frame["unnamed"], frame["v"], frame["length"]):
                own = held.setdefault(len(v), [])
                own.append((vec_id, unnamed, v, length))
                if len(own) >= BLOCK:
                    yield flush(len(v))
        for dim in list(held):
            yield flush(dim)

    ordered = rows.repartitionByRange(F.col("length").desc(), "vec_id").sortWithinPartitions(F.col("length").desc(), "vec_id")
    # pandas would read a batch's ids as floats where one is null, and ids from 2^53 on would be others then
    ordered = ordered.select(F.coalesce("vec_id", F.lit(int(LONG.max))).alias("vec_id"), F.col("vec_id").isNull().alias("unnamed"), "v", "length")
    # few rows in many partitions would give many small blocks
    return ordered.coalesce(max(1, -(-rows.count() // BLOCK))).mapInPandas(blocks, BLOCK_SCHEMA)


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, dim = int(row["n"]), int(row["dim"])
    ids = np.frombuffer(row["ids"], np.int64, n)
    unnamed = np.frombuffer(row["ids"], bool, n, 8 * n)
    return ids, unnamed, np.frombuffer(row["vectors"], np.float64).reshape(n, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the rows of ``b`` (float64 or Python integers), saturated."""
    if np.sqrt((a * a).sum(1).max(initial=0)) * np.sqrt((b * b).sum(1).max(initial=0)) < EXACT:
        return a @ b.T
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.minimum(np.maximum(exact, int(LONG.min)), int(LONG.max))


def _below(x):
    """``x`` where it is exact as a float, else a float that isn't above the integer it came from."""
    return np.where(np.abs(x) < EXACT, x, np.nextafter(x, -np.inf))


def search_block(q_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, ids: np.ndarray, unnamed: np.ndarray,
                 vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of a block per query: positions of queries, positions of vectors, scores.

    ``floor`` is a score that the query's k-th best reaches for sure.
    """
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    q_length = np.sqrt((queries * queries).sum(axis=1))
    floor = _below(floor.astype(float))
    best: list[list[tuple]] = [[] for _ in q_ids]
    unit_q = queries / np.where(q_length > 0, q_length, 1.0)[:, None]
    focus = np.argsort(-np.abs(unit_q), axis=1)[:, :COORDINATES]

    def keep(q: int, at: np.ndarray, scores) -> None:
        if not len(at):
            return
        got = best[q] + [(-s, bool(unnamed[i]), int(ids[i]), int(i)) for s, i in zip(scores, at.tolist())]
        got.sort()
        best[q] = got[:k]
        if len(got) >= k:
            floor[q] = max(floor[q], float(_below(np.float64(-best[q][-1][0]))))

    for first in range(0, len(order), BUCKET):
        bucket = order[first:first + BUCKET]
        longest = lengths[bucket[0]]
        reach = q_length * longest
        # a hair of slack: lengths are rounded, products are not
        live = np.flatnonzero(floor <= reach * (1 + 1e-9) + 1e-9)
        if not len(live):
            continue
        cosine = np.clip(np.where(reach[live] > 0, floor[live] / np.where(reach[live] > 0, reach[live], 1.0), -1.0), -1.0, 1.0)
        high = cosine >= HIGH_COSINE
        members = vectors[bucket]
        # length pruning; what is left of a bucket is a prefix, verified together
        low = live[~high]
        if len(low):
            need = np.where(q_length[low] > 0, floor[low] / np.where(q_length[low] > 0, q_length[low], 1.0), -np.inf)
            upto = int(np.searchsorted(-lengths[bucket], -(need.min() * (1 - 1e-9) - 1e-9), side="right"))
            if upto:
                scores = products(queries[low], members[:upto])
                for row, q in enumerate(low.tolist()):
                    hit = np.flatnonzero((scores[row] >= floor[q]) & ((ids[bucket[:upto]] != q_ids[q]) | unnamed[bucket[:upto]]))
                    if len(hit) > k:  # ties stay in until ids decide
                        cut = np.sort(scores[row][hit])[-k]
                        hit = hit[scores[row][hit] >= cut]
                    keep(q, bucket[hit], [int(s) for s in scores[row][hit]])
        if high.any():
            unit = members / np.where(lengths[bucket] > 0, lengths[bucket], 1.0)[:, None]
            for q, c in zip(live[high].tolist(), cosine[high].tolist()):
                near = np.ones(len(bucket), bool)
                for f in focus[q]:
                    x = unit_q[q, f]
                    spread = np.sqrt(max((1 - c * c) * (1 - x * x), 0.0)) + 1e-9
                    near &= np.abs(unit[:, f] - x * c) <= spread + abs(x) * (1 - c)
                hit = np.flatnonzero(near & ((ids[bucket] != q_ids[q]) | unnamed[bucket]))
                if len(hit):
                    scores = products(queries[q:q + 1], members[hit])[0]
                    good = scores >= floor[q]
                    keep(q, bucket[hit[good]], [int(s) for s in scores[good]])
    rows = [(q, i, -s) for q, found in enumerate(best) for s, _, _, i in found]
    return (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
            np.array([r[2] for r in rows], np.int64))


def top_products(queries: DataFrame, vectors: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score for both tables' (vec_id, embedding)."""
    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding"), scale).alias("v"))
        return rows.where("v is not null").withColumn(
            "length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))

    rows = prepared(vectors)
    asked = prepared(queries).where("vec_id is not null").dropDuplicates(["vec_id", "v"])
    blocks = written(pack(rows), "topk-blocks")
    seed = [(r.vec_id, r.v) for r in rows.orderBy(F.col("length").desc(), "vec_id").limit(SEED_ROWS).collect()]
    result = pa.schema([(c, pa.int64()) for c in ("q_block", "q_at", "query_id", "vec_id", "score")])

    def started(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Query blocks with each query's first threshold, from the seed."""
        for frame in frames:
            floors = []
            for _, q in frame.iterrows():
                q_ids, _, asking = unpack(q)
                floor = np.full(len(q_ids), -np.inf)
                same = [(i, v) for i, v in seed if len(v) == q["dim"]]
                if same:
                    ids = np.array([LONG.max if i is None else i for i, _ in same], np.int64)
                    at, _, score = search_block(q_ids, asking, floor, ids, np.array([i is None for i, _ in same]),
                                                np.array([v for _, v in same], np.float64).reshape(len(same), -1), k)
                    low = np.full(len(q_ids), np.inf)
                    np.minimum.at(low, at, score.astype(float))
                    floor = np.where(np.bincount(at, minlength=len(q_ids)) >= k, low, -np.inf)
                floors.append(floor.tobytes())
            yield frame.assign(floors=floors)

    q_blocks = written(pack(asked).mapInPandas(started, BLOCK_SCHEMA + ", floors binary"), "topk-queries")
    grid_q, grid_v = max(q_blocks.count(), 1), max(blocks.count(), 1)

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, q in left.iterrows():
            q_ids, _, asking = unpack(q)
            floor = np.frombuffer(q["floors"], np.float64)
            for _, b in right.iterrows():
                if b["dim"] != q["dim"]:
                    continue
                ids, unnamed, have = unpack(b)
                at, found, score = search_block(q_ids, asking, floor, ids, unnamed, have, k)
                columns = [pa.array(np.full(len(at), q["block"], np.int64)), pa.array(at), pa.array(q_ids[at]),
                           pa.array(ids[found], mask=unnamed[found]), pa.array(score)]
                out.append(pa.table(columns, schema=result).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get))
        return pd.concat(out) if out else result.empty_table().to_pandas()

    # one cell per pair of blocks: each side is repeated along the other's axis
    axis = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q_blocks.withColumn("x", F.pmod(F.xxhash64("block"), F.lit(grid_q))).withColumn("y", axis(grid_v))
    right = blocks.withColumn("y", F.pmod(F.xxhash64("block"), F.lit(grid_v))).withColumn("x", axis(grid_q))
    found = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInPandas(cell, RESULT_SCHEMA)
    # a query is its place in the blocks: an id may ask with several vectors
    best = W.partitionBy("q_block", "q_at").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
