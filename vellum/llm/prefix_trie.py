"""Conversation prefix trie from sorted, padded turn-id matrices.

A turn's id is 128 bits of digest over role and text; a conversation is the
string of its ids.  All conversations are range-sorted by (id string, conv_id),
so the members of a node -- the conversations that start with its turns -- are
neighbours.  A shard lays its id strings into padded matrices of ``BLOCK`` turns
(a long conversation takes further blocks, alone or with those that still share
its prefix) and orders the rows with numpy's lexsort.  Changes from row to row,
OR-accumulated over the columns, mark where nodes start; the number of columns
before the first change is the prefix that a row shares with the row before it.
With that number every figure of a node is a sum over its rows, taken for all
nodes of a depth by reduceat:

  children   rows that leave the row before at this depth and go on
  leaves     rows that the row after doesn't continue
  saved      characters of the turns that a row shares with the row before

Every shard also gets the last row of the shard before it and the first one of
the shard after, so sums of one node from several shards just add up.  Only nodes
that reach over a shard's edge are grouped again; all others are final.

Scale: texts are read once and reduced to ids before the first shuffle.  Shards
hold about ``SHARD_TURNS`` turns whatever the input, and conv_id is the last sort
key, so a conversation or first turn that a third of all share is cut between
shards.  What crosses edges is two chains of nodes a shard.  The digest of the ids
that end at a node is streamed over sorted pieces.  A single conversation's
turn ids (32 bytes a turn, not its texts) must fit one row.

Defined results: null role or text is empty; null turns come first, equal turns
are ordered by their ids; repeated rows are turns of their own.  A
conversation without turns is a member of the root.  Conversations without an id
can't be named by one and are left out.  No conversations: no nodes.
Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.common import written

BLOCK = 16  # turns a matrix holds side by side
SHARD_TURNS = 200_000  # turns of a shard, about
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, node binary, parent binary, ends string, first_end long")
FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_ids(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), id (32 hex digits), chars of every turn of conversations with an id."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.md5(F.concat(F.length(role), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.length(text).cast("long").alias("chars"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return rows.select("conv_id", (F.row_number().over(order).cast("long") - 1).alias("place"), "id", "chars")


def paths(ids: DataFrame, members: DataFrame) -> DataFrame:
    """conv_id, path (16 bytes a turn), chars (array) of every row of ``members`` (conv_id), in order of place."""
    found = ids.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "chars"))).alias("t"))
    joined = members.join(found, "conv_id", "left")
    none = F.array().cast("array<struct<place:long,id:string,chars:long>>")
    t = F.coalesce("t", none)
    return joined.select("conv_id", F.unhex(F.array_join(F.transform(t, lambda x: x["id"]), "")).alias("path"),
                         F.transform(t, lambda x: x["chars"]).alias("chars"))


def in_order(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows by (path, conv_id), and the turns each shares with the one before (-1 for the first)."""
    n = len(rows)
    length = np.array([len(p) // 16 for p in rows["path"]], np.int64)
    ids = np.frombuffer(b"".join(rows["path"]), ">u8").astype(np.uint64).reshape(-1, 2)
    first = np.cumsum(length) - length
    conv = rows["conv_id"].to_numpy(np.int64)
    order = np.lexsort((conv,))
    shared = np.zeros(n, np.int64)  # per place in the order, with the row before
    group = np.zeros(n, np.int64)  # rows with equal turns so far, by place
    done = 0
    open_ = np.arange(n)  # places that still share all of their turns with a neighbour
    while len(open_):
        row = order[open_]
        left = np.clip(length[row] - done, 0, BLOCK)
        width = max(1, int(left.max()))
        held = np.arange(width)[None, :] < left[:, None]
        at = (first[row] + done)[:, None] + np.arange(width)[None, :]
        matrix = np.zeros((len(open_), width, 2), np.uint64)
        matrix[held] = ids[at[held]]
        goes_on = length[row] > done + BLOCK
        # an absent turn sorts before any present one; rows that end here come before those that go on
        keys = [conv[row], goes_on]
        for k in range(width - 1, -1, -1):
            keys += [matrix[:, k, 1], matrix[:, k, 0], held[:, k]]
        by = np.lexsort((*keys, group[open_]))
        order[open_] = row[by]
        matrix, held, goes_on = matrix[by], held[by], goes_on[by]
        changed = (matrix[1:] != matrix[:-1]).any(axis=2) | ~held[1:] | ~held[:-1]
        starts = np.logical_or.accumulate(changed, axis=1)  # at that depth the row starts a node
        same = group[open_][1:] == group[open_][:-1]
        equal = np.where(same, width - starts.sum(axis=1), -1)
        shared[open_[1:][same]] += equal[same]
        whole = np.concatenate([[False], equal == BLOCK])
        group[open_] = np.cumsum(~whole)
        open_, done = open_[(whole | np.concatenate([whole[1:], [False]])) & goes_on], done + BLOCK
    shared[0] = -1
    return order, shared


def shard_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard; ``edge`` is -1 for the last row of the shard before, 1 for the first one of the shard after."""
    order, shared = in_order(rows)
    edge = rows["edge"].to_numpy()[order]
    after = np.concatenate([shared[1:], [-1]])  # turns shared with the next row
    mine = np.flatnonzero(edge == 0)
    order, shared, after = order[mine], shared[mine], after[mine]
    n = len(mine)
    length = np.array([len(p) // 16 for p in rows["path"]], np.int64)[order]
    conv = rows["conv_id"].to_numpy(np.int64)[order]
    chars = np.concatenate([np.zeros(1, np.int64), *(np.asarray(rows["chars"].iloc[i], np.int64) for i in order)])
    total = np.cumsum(chars)
    begin = np.cumsum(length) - length  # so a row's first j turns have total[begin + j] - total[begin] characters
    leaf = (after < length) & (length > 0)
    deepest = np.maximum(np.maximum(shared, after), 0)  # nodes down to here may have other rows
    deepest = np.minimum(deepest, length)

    def chain(i: int, upto: int) -> list[bytes]:
        """Names of the nodes on a row's path, depth by depth."""
        h, out, path = hashlib.blake2b(digest_size=16), [], rows["path"].iloc[order[i]]
        for d in range(upto + 1):
            out.append(h.copy().digest())
            h.update(path[16 * d:16 * d + 16])
        return out

    low, high = int(shared[0]), int(after[-1])  # depths down to which the outer nodes reach over the edges
    names = chain(0, low), chain(n - 1, high)
    made: list[dict] = []
    conv_at = np.zeros(n, np.int64)  # per row, the smallest member of its node one level up
    name_at = np.full(n, -1, np.int8)  # and whether that node reaches over an edge: before 0, after 1
    for d in range(int(deepest.max()) + 1):
        at = np.flatnonzero(deepest >= d)
        is_start = shared[at] < d
        is_start[0] = True
        s = np.flatnonzero(is_start)
        size = np.diff(np.concatenate([s, [len(at)]]))
        upto = np.minimum(shared[at], length[at])
        saved = total[begin[at] + np.maximum(upto, 0)] - total[begin[at] + np.clip(upto, 0, max(d - 1, 0))]
        smallest = np.minimum.reduceat(conv[at], s)
        over = np.full(len(s), -1, np.int8)
        if d <= high and at[-1] == n - 1:
            over[-1] = 1
        if d <= low and at[0] == 0:
            over[0] = 0
        ending = length[at] == d
        ends: list[str | None] = [None] * len(s)
        first_end = np.zeros(len(s), np.int64)
        n_end = np.add.reduceat(ending.astype(np.int64), s)
        for k in np.flatnonzero(n_end).tolist():  # shorter rows of a run come first, by id
            ids = conv[at[s[k]:s[k] + n_end[k]]]
            ends[k], first_end[k] = ",".join(map(str, ids.tolist())), ids[0]
        node = [None if o < 0 else names[o][d] for o in over]
        up = name_at[at[s]]
        made.append({
            "conv_id": smallest, "depth": np.full(len(s), d), "parent_conv_id": conv_at[at[s]] if d else np.full(len(s), -1),
            "n_convs": size, "n_children": np.add.reduceat(((shared[at] <= d) & (length[at] > d)).astype(np.int64), s),
            "n_leaves": np.add.reduceat(leaf[at].astype(np.int64), s), "saved_tokens": np.add.reduceat(saved, s),
            "ends_sha256": [None if m is not None else EMPTY if e is None else hashlib.sha256(e.encode()).hexdigest()
                            for e, m in zip(ends, node)],
            "node": node, "parent": [None if o < 0 else names[o][d - 1] for o in up],
            "ends": [e if m is not None else None for e, m in zip(ends, node)], "first_end": first_end,
            "rootless": np.full(len(s), d == 0)})
        conv_at[at] = np.repeat(smallest, size)
        name_at[at] = np.repeat(over, size)
    # the rest of every row: nodes with one member, one below the other
    rest = length - deepest
    at = np.repeat(np.arange(n), rest)
    step = np.arange(len(at)) - np.repeat(np.cumsum(rest) - rest, rest)
    depth = deepest[at] + 1 + step
    is_last = depth == length[at]
    own = {i: hashlib.sha256(str(conv[i]).encode()).hexdigest() for i in np.flatnonzero(rest > 0).tolist()}
    up = np.where(step == 0, name_at[at], -1)
    made.append({
        "conv_id": conv[at], "depth": depth, "parent_conv_id": np.where(step == 0, conv_at[at], conv[at]),
        "n_convs": np.ones(len(at), np.int64), "n_children": (~is_last).astype(np.int64), "n_leaves": np.ones(len(at), np.int64),
        "saved_tokens": np.zeros(len(at), np.int64),
        "ends_sha256": [own[i] if z else EMPTY for i, z in zip(at.tolist(), is_last.tolist())],
        "node": [None] * len(at),
        "parent": [None if o < 0 else names[o][d - 1] for o, d in zip(up.tolist(), depth.tolist())],
        "ends": [None] * len(at), "first_end": np.zeros(len(at), np.int64), "rootless": np.zeros(len(at), bool)})
    out = pd.concat([pd.DataFrame(m) for m in made], ignore_index=True)
    out["parent_conv_id"] = out["parent_conv_id"].astype("Int64").mask(out.pop("rootless"))
    return out


def sharded(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with their shard of the global order, and with each shard's neighbours (edge -1 and 1)."""
    cut = written(rows.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id()), "trie-shards")
    row = F.struct("path", "conv_id", "chars")
    ends = cut.groupBy("shard").agg(F.min(row).alias("low"), F.max(row).alias("high"))  # two rows a shard
    by_shard = W.orderBy("shard")
    beside = ends.select("shard", F.lag("high").over(by_shard).alias("before"), F.lead("low").over(by_shard).alias("after"))
    beside = beside.select("shard", F.inline(F.array(F.struct(F.lit(-1).alias("edge"), F.col("before").alias("r")),
                                                     F.struct(F.lit(1).alias("edge"), F.col("after").alias("r")))))
    beside = beside.where(F.col("r").isNotNull()).select("r.conv_id", "r.path", "r.chars", "shard", "edge")
    return cut.select("conv_id", "path", "chars", "shard", F.lit(0).alias("edge")).unionByName(beside)


def ends_digests(pieces: DataFrame) -> DataFrame:
    """node, hash: SHA-256 of each node's pieces of ids, in ascending order, streamed."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out: list[tuple[bytes, str]] = []
            for name, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if name != node:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = name, hashlib.sha256(ends.encode())
                else:
                    digest.update(f",{ends}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "hash"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "hash"])

    ordered = pieces.select("node", "first_end", "ends").repartition("node").sortWithinPartitions("node", "first_end")
    return ordered.select("node", "ends").mapInArrow(hashed, "node binary, hash string")


def trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over ``rows`` (conv_id, path, chars): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = written(rows, "trie-paths")
    size = rows.agg(F.coalesce(F.sum(F.size("chars") + 1), F.lit(0)).alias("n")).first()["n"]
    shards = sharded(rows, max(1, -(-int(size) // shard_turns)))
    parts = written(shards.groupBy("shard").applyInPandas(shard_nodes, NODE), "trie-nodes")

    across = parts.where(F.col("node").isNotNull())
    sums = across.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent", ignorenulls=True).alias("parent"),
        *(F.sum(c).alias(c) for c in FIGURES))
    hashes = ends_digests(across.where(F.col("ends").isNotNull())).withColumnRenamed("node", "ended")
    merged = written(sums.join(hashes, F.col("node") == F.col("ended"), "left").select(
        "node", "parent", "conv_id", "depth", *FIGURES, F.coalesce("hash", F.lit(EMPTY)).alias("ends_sha256")), "trie-across")

    named = merged.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    columns = ("conv_id", "depth", "parent_conv_id", *FIGURES, "ends_sha256")
    inside = parts.where(F.col("node").isNull())
    below = (inside.where(F.col("parent").isNotNull()).select("conv_id", "depth", *FIGURES, "ends_sha256", "parent")
             .unionByName(merged.select("conv_id", "depth", *FIGURES, "ends_sha256", "parent").where(F.col("parent").isNotNull())))
    below = below.join(named, F.col("parent") == F.col("above")).withColumnRenamed("above_conv", "parent_conv_id")
    top = merged.where(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = (inside.where(F.col("parent").isNull()).select(*columns)
           .unionByName(below.select(*columns)).unionByName(top.select(*columns)))
    # the root is a leaf of its own where no conversation has turns
    return out.withColumn("n_leaves", F.when((F.col("depth") == 0) & (F.col("n_children") == 0), F.lit(1).cast("long"))
                          .otherwise(F.col("n_leaves")))


def conversation_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie over the conversations of ``turns`` as they are."""
    ids = turn_ids(turns)
    return trie(paths(ids, ids.select("conv_id").distinct()), shard_turns)
