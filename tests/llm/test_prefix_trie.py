import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from vellum.llm import prefix_trie as pt
from vellum.llm import queries

TURNS = "conv_id long, turn long, role string, text string"


def brute(sequences):
    """conv_id -> [(role, text)] to the set of node rows."""
    nodes = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    out = set()
    for name, members in nodes.items():
        below = [n for n in nodes if n[:len(name)] == name]
        leaves = sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in nodes) for n in below)
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = sorted(c for c in members if len(sequences[c]) == len(name))
        out.add((min(members), len(name), min(nodes[name[:-1]]) if name else None, len(members),
                 sum(len(m) == len(name) + 1 for m in below), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def as_rows(sequences):
    return [(c, i, r, t) for c, s in sequences.items() for i, (r, t) in enumerate(s)]


def nodes(frame):
    got = [tuple(r) for r in frame.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("shard_turns", [4, 25, 10_000])
def test_trie_equals_dictionary(spark, shard_turns):
    rng = random.Random(shard_turns)
    alphabet = [("user", "a"), ("assistant", "bb"), ("user", ""), ("", "é😀")]
    sequences = {c: [rng.choice(alphabet) for _ in range(rng.randint(1, 5))] for c in range(0, 60, 2)}
    # many equal ones, and paths longer than a matrix with a common start of more than one
    sequences |= {c: alphabet[:2] for c in range(100, 125)}
    stem = [rng.choice(alphabet) for _ in range(2 * pt.BLOCK + 3)]
    sequences |= {-1: stem, 200: stem + [alphabet[0]], 201: stem[:pt.BLOCK], 202: stem[:-1] + [alphabet[3]] * 20, 203: stem, 204: stem[:2 * pt.BLOCK]}
    frame = spark.createDataFrame(as_rows(sequences), TURNS).selectExpr("*", "1 AS place", "'x' AS id", "'y' AS chars", "'z' AS node")
    assert nodes(pt.conversation_trie(frame, shard_turns)) == brute(sequences)


@pytest.mark.parametrize("shard_turns", [2, 1000])
def test_members_without_turns(spark, shard_turns):
    ids = pt.turn_ids(spark.createDataFrame([(3, 0, "u", "x")], TURNS))
    members = spark.createDataFrame([(3,), (1,), (2,)], "conv_id long")
    assert nodes(pt.trie(pt.paths(ids, members), shard_turns)) == brute({1: [], 2: [], 3: [("u", "x")]})
    only = pt.paths(ids.where("false"), members)
    assert nodes(pt.trie(only, shard_turns)) == brute({1: [], 2: [], 3: []})


def test_nulls_ties_and_empty_table(spark):
    rows = [(None, 0, "user", "left out"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (2, 5, "user", "first"), (2, 6, "", "")]
    got = nodes(pt.conversation_trie(spark.createDataFrame(rows, TURNS)))
    assert got == brute({1: [("user", "first"), ("", ""), ("", "")], 2: [("user", "first"), ("", "")]})
    assert pt.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(1)
    own = {c: [(rng.choice("ua"), rng.choice("xyz")) for _ in range(rng.randint(1, 7))] for c in [*range(100, 140), 205, 200, 301]}
    spark.createDataFrame(as_rows(own), TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + s[h:]
    assert nodes(queries.op13_prefix_trie(spark, str(tmp_path))) == brute(rebuilt)


def test_a_long_conversation_takes_matrices_of_its_own(spark):
    import numpy as np
    import pandas as pd

    path = np.arange(1, 40_001, dtype=">u8").tobytes()  # 20,000 turns
    rows = pd.DataFrame({"conv_id": [7, 8, 9], "path": [path, path[:16 * 9], b""], "chars": [np.ones(20_000), np.ones(9), np.zeros(0)], "edge": 0})
    got = pt.shard_nodes(rows)
    assert len(got) == 20_001 and got["saved_tokens"].max() == 9 and (got["depth"].value_counts() == 1).all()
