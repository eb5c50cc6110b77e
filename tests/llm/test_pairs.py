import collections
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import WORD, clashing, docs_frame, words
from vellum.llm import jaccard, substring_dedup, topk
from vellum.llm.components import components
from vellum.llm.shingles import INSTANCES, instances_of, set_digest, shingle_sets

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_set(text):
    ws = WORD.findall((text or "").translate(LOWER))
    if len(ws) >= 5:
        return frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    return frozenset([tuple(ws)]) if ws else frozenset()


def brute_components(ids, texts):
    sets = [brute_set(t) for t in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    smallest = {}
    for i, d in enumerate(ids):
        smallest[find(i)] = min(smallest.get(find(i), d), d)
    return [(d, len(sets[i]), smallest[find(i)] if sets[i] else d) for i, d in enumerate(ids)]


def edited(rng, ws, edits):
    ws = list(ws)
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = words(rng, 1)[0] + "q"
    return " ".join(ws)


def fixture(rng):
    texts = [None, "", " \t\n", "one", "One", "one two", "a b c d", "A b\nc  d", "a b c d e", "É b c d e", "é b c d e"]
    base = words(rng, 150)
    texts += [edited(rng, base, rng.randint(0, 6)) for _ in range(60)]       # a group of near copies
    passage = " ".join(words(rng, 60))
    texts += [" ".join(words(rng, rng.randint(20, 120))) + " " + passage + " " + " ".join(words(rng, 30)) for _ in range(80)]
    texts += [passage + " " + " ".join(words(rng, n)) for n in range(0, 16)]
    for n in (6, 9, 14, 20, 33, 64, 65, 260, 1030, 1400):                    # chains around the band edges
        t = words(rng, n)
        for _ in range(4):
            texts.append(" ".join(t))
            t = t[max(1, n // 30):] + words(rng, n // 30)
    texts += [texts[20]] * 40
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = fixture(rng)
    ids = rng.sample(range(10_000), len(texts))
    got = jaccard.jaccard_components(clashing(docs_frame(spark, texts, ids=ids))).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(ids, texts))


@pytest.mark.parametrize("earlier", [1, 2])
def test_components_with_few_earlier_groups(spark, monkeypatch, earlier):
    monkeypatch.setattr(jaccard, "EARLIER", earlier)
    monkeypatch.setattr(jaccard, "CENTRES", 2)
    test_components_equal_brute_force(spark, earlier)


def test_a_pair_is_proposed_once_whatever_groups_it_shares(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    groups = {n: rng.sample(range(30), 20) for n in range(40)}               # near copies: 13 common groups or so
    state = spark.createDataFrame([(g, n, 100, n, [0] * 16) for n in groups for g in groups[n]],
                                  "gid long, node long, size long, root long, parity array<long>").withColumn("earlier", jaccard._earlier("node"))
    chosen = (state.where("node < 3 and gid % 2 = node % 2").select("gid", F.col("node").alias("u"), F.col("size").alias("u_size"),
              F.col("root").alias("u_root"), F.col("parity").alias("u_parity")).withColumn("u_earlier", jaccard._earlier("u")))
    want = {(u, v) for u in range(3) for v in groups if u != v and any(g % 2 == u % 2 for g in set(groups[u]) & set(groups[v]))}
    got = collections.Counter(map(tuple, jaccard._proposed(state, chosen).collect()))
    assert set(got) == {(min(p), max(p)) for p in want}
    assert sum(got.values()) <= len(want)


def test_equal_shingles_of_a_text_count_once():
    texts = pa.array(["a b c d e " * 40, "x" * 70_000 + " a b c d e f", "", "a b c"])
    assert [len(s) for s in shingle_sets(texts)] == [5, 3, 0, 1]
    assert all((np.diff(s.astype(object)) > 0).all() for s in shingle_sets(texts))


def test_hot_signatures_are_counted_without_their_rows(spark):
    rows = [(7, n) for n in range(20)] + [(8, n) for n in range(3)] + [(9, n) for n in range(30)]
    sigs = spark.createDataFrame(rows + rows, "sig long, node long")
    known = np.array([9], np.uint64)
    got = jaccard._shared(sigs, known, counted=True).collect()
    assert [(r.sig, r.n, r.fresh) for r in got] == [(7, 20, True)]
    assert sorted((r.sig or 0, r.fresh) for r in jaccard._shared(sigs, known).collect()) == [(0, False)] * 33 + [(7, True)] * 20


def test_one_row_stays_of_every_group(spark):
    texts = ["a b c d e f"] * 3 + ["A b c d e f", "x y z", None, None, "x y z"]
    ids = [4, 4, 2, 9, 4, 4, 1, None]
    rows = jaccard.one_per_component(docs_frame(spark, texts, ids=ids), ("doc_id", "text")).collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(
        [(2, "a b c d e f"), (4, "x y z"), (4, None), (1, None)])


def test_no_documents(spark):
    assert jaccard.jaccard_components(docs_frame(spark, [])).count() == 0
    assert jaccard.jaccard_components(docs_frame(spark, [None, " "])).count() == 2


def test_shingle_sets_equal_brute_force():
    rng = random.Random(4)
    texts = fixture(rng)
    for t, s in zip(texts, shingle_sets(pa.array([t or "" for t in texts]))):
        assert len(s) == len(brute_set(t))
    named = collections.defaultdict(set)
    for t, s in zip(texts, shingle_sets(pa.array([t or "" for t in texts]).slice(0))):
        named[set_digest(s)].add(brute_set(t))
    assert all(len(v) == 1 for v in named.values())
    part = pa.array([t or "" for t in texts]).slice(30, 20)
    assert [len(s) for s in shingle_sets(part)] == [len(brute_set(t)) for t in texts[30:50]]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 9, 15, 16, 20, 47, 48, 63, 64, 200, 1000])
def test_similar_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for turn in range(30):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for b_size in {size, min(4 * size // 3, size + 1), 4 * size // 3}:
            # the most different set of that size that still links
            common = next(c for c in range(size + 1) if 100 * c >= 75 * (size + b_size - c))
            b = np.unique(np.concatenate([rng.choice(a, common, replace=False), rng.integers(0, 1 << 63, b_size - common, dtype=np.uint64)]))
            shared, hot = False, np.zeros(0, np.uint64)
            if turn % 2:  # any signatures may be put last
                hot = np.sort(np.concatenate([rng.permutation(i.cell_signatures(x))[:size // 2] for x in (a, b) for i in instances_of(len(x))]))
            for i in set(map(INSTANCES.index, instances_of(len(a)))) & set(map(INSTANCES.index, instances_of(len(b)))):
                shared |= bool(np.intersect1d(INSTANCES[i].signatures(a, hot), INSTANCES[i].signatures(b, hot)).size)
            assert shared


def test_components_of_edges(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in root if find(x) != x}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("one_task", [0, 120])
def test_components_by_rounds(spark, monkeypatch, one_task):
    monkeypatch.setattr(sys.modules[components.__module__], "ONE_TASK", one_task)
    test_components_of_edges(spark)


VECTORS = "vec_id long, embedding array<double>"


def brute_top(queries, rows, k):
    def ints(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(256 * x)) if abs(x) < 2**40 else int(256 * x) for x in v]

    have = [(i, ints(v)) for i, v in rows if ints(v) is not None]
    out = []
    for q, v in {(i, tuple(ints(v))) for i, v in queries if i is not None and ints(v) is not None}:
        found = sorted((-max(min(sum(a * b for a, b in zip(v, w)), 2**63 - 1), -2**63), i is None, i or 0, i) for i, w in have if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def test_top_products_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 37)
    monkeypatch.setattr(topk, "BUCKET", 8)
    monkeypatch.setattr(topk, "SEED_ROWS", 5)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(0, 1, 6) * rng.choice([0.1, 1, 30])).tolist()) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(30)] + [(300 + i, (np.array(rows[3][1]) * (1 + i / 50)).tolist()) for i in range(20)]
    rows += [(400, None), (401, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, [0.0] * 6),
             (405, [1.0, 2.0]), (406, [2.0, 1.0]), (407, []), (None, rows[5][1]), (408, [1e14] * 6), (0, rows[0][1])]
    df = spark.createDataFrame(rows, VECTORS)
    asked = [r for r in rows if r[0] is not None and r[0] % 7 == 0 or r[0] in (404, 405, 408)]
    got = topk.top_products(spark.createDataFrame(asked, VECTORS), clashing(df), k=5).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(asked, rows, 5)


def test_top_products_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.5, 0.5])], VECTORS)
    assert sorted(map(tuple, topk.top_products(df, df).collect())) == [(0, 1, 50, 128 * 256), (50, 1, 0, 128 * 256)]
    none = df.limit(0)
    assert topk.top_products(none, none).count() == 0


def test_top_products_of_ids_beyond_floats_beside_a_null_id(spark):
    base, rng = 1 << 60, np.random.default_rng(8)
    rows = [(base + i, rng.normal(0, 1, 4).tolist()) for i in range(40)] + [(None, [3.0] * 4)]
    df = spark.createDataFrame(rows, VECTORS)
    asked = [r for r in rows if r[0] is not None and r[0] % 5 == 0]
    got = topk.top_products(spark.createDataFrame(asked, VECTORS), df).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(asked, rows, 5)


def test_top_products_of_an_id_that_asks_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0])] + [(i, [i / 8, 1 - i / 8]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.top_products(df.where("vec_id = 0"), df).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(rows[:2], rows, 5)


def brute_dedup(rows, min_words):
    units = substring_dedup.Units()
    cut = [(i, t or "", *units.of(t or "")) for i, t in rows]
    keeper = {}
    for i, _, _, _, digests in cut:
        for d in digests:
            keeper[d] = min(keeper.get(d, i), i)
    out = []
    for i, t, bounds, sizes, digests in cut:
        seen, gone = set(), []
        for d in digests:
            gone.append(d is not None and (keeper[d] != i or d in seen))
            seen.add(d)
        spans = substring_dedup.repeated_spans(bounds, sizes, gone, min_words)
        out.append((i, "".join(c for k, c in enumerate(t) if not any(a <= k < b for a, b in spans)), spans))
    return sorted(out)


def sentence(rng, n):
    ws = words(rng, n)
    return " ".join([ws[0].capitalize(), *ws[1:]]) + "."


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    shared = [" ".join(sentence(rng, rng.randint(4, 12)) for _ in range(8)) for _ in range(4)]
    line = sentence(rng, 13)
    rows = []
    for i in range(80):
        parts = [" ".join(sentence(rng, rng.randint(1, 12)) for _ in range(6)) for _ in range(3)]
        text = parts[0] + rng.choice([" and the ", "\n", " "]) + rng.choice(shared + [""]) + " of it " + parts[1]
        rows.append((i, text + ("\n" + line if i % 3 == 0 else "") + "\n" + parts[2] + ("\n" + line if i % 9 == 0 else "")))
    rows += [(100, None), (101, ""), (102, rows[5][1]), (103, "CAPS ONLY TEXT!! " * 30), (104, "\n\n\n"), (105, line.upper())]
    df = clashing(docs_frame(spark, [t for _, t in rows], ids=[i for i, _ in rows]))
    got = sorted((r.doc_id, r.text, [(s.start, s.end) for s in r.spans]) for r in substring_dedup.dedup_substrings(df).collect())
    assert got == brute_dedup(rows, 8)
    for p in shared:
        inner = p[:-1].lower()
        assert sum(inner in t.lower() for _, t, _ in got) <= 1
    assert next(t for i, t, _ in got if i == 102) == ""


def test_substring_dedup_ids_and_empty_table(spark):
    text = "One two three four five six seven eight nine ten."
    rows = substring_dedup.dedup_substrings(docs_frame(spark, [text, text, text, text + " More here."], ids=[3, None, 3, 3])).collect()
    assert sorted((r.doc_id is None, r.text) for r in rows) == [(False, "")] * 2 + [(False, " More here.".strip()), (True, text)]
    assert substring_dedup.dedup_substrings(docs_frame(spark, [])).count() == 0


def test_substring_dedup_rows_without_an_id_or_with_a_shared_one(spark):
    rng = random.Random(21)
    passage = " ".join(sentence(rng, 9) for _ in range(8))
    own = [" ".join(sentence(rng, 9) for _ in range(4)) for _ in range(6)]
    rows = [(None, passage), (None, passage), (7, f"{own[0]} {passage} {own[1]}"), (8, own[2]), (8, f"{own[3]} {own[2]}"), (8, own[2])]
    docs = docs_frame(spark, [t for _, t in rows], ids=[i for i, _ in rows]).coalesce(1)
    got = sorted((r.doc_id or 0, r.text.strip()) for r in substring_dedup.dedup_substrings(docs, min_words=20).collect())
    assert got == sorted([(0, passage), (0, ""), (7, f"{own[0]} {own[1]}"), (8, own[2]), (8, own[3]), (8, "")])
    with pytest.raises(ValueError):
        substring_dedup.dedup_substrings(docs, keep=("spans",))
    kept = substring_dedup.dedup_substrings(docs.selectExpr("*", "lang AS doc", "source AS lost", "n_chars AS row"), keep=("doc", "lost", "row"))
    assert kept.columns == ["doc_id", "doc", "lost", "row", "text", "spans", "n_units", "n_removed"] and kept.count() == 6


def test_substring_dedup_of_sentences_against_a_list_of_sentences(spark):
    """Texts are lists of known sentences: what goes is counted on the lists, without the operator's cutting."""
    rng = random.Random(33)
    pool = [sentence(rng, rng.randint(4, 9)) for _ in range(300)]
    runs = [[rng.choice(pool) for _ in range(8)] for _ in range(5)]
    texts = []
    for i in range(120):
        own = [sentence(rng, rng.randint(4, 9)) for _ in range(rng.randint(2, 9))]
        if i % 3 == 0:
            at = rng.randint(0, len(own))
            own[at:at] = runs[i % 5]
        if i % 4 == 1:
            own.insert(rng.randint(0, len(own)), rng.choice(pool[:5]))  # alone it is too short to go
        texts.append(own)
    got = {r.doc_id: r.text for r in substring_dedup.dedup_substrings(docs_frame(spark, [" ".join(t) for t in texts]), min_words=20).collect()}
    held = {}
    for i, t in enumerate(texts):
        for x in t:
            held.setdefault(x, i)
    for i, t in enumerate(texts):
        left, run = [], []
        for x in [*t, None]:
            if x is not None and (held[x] < i or x in t[:t.index(x)]):
                run.append(x)
                continue
            if sum(len(y.split()) for y in run) < 20:
                left += run
            run = []
            left += [x] if x else []
        assert got[i].split() == " ".join(left).split(), i


def kinds_of_short_units(rng):
    """name, a maker of texts of n words or characters each unlike any other."""
    def fresh(n, alphabet="abcdefghijklmnopqrstuvwxyz"):
        return ["".join(rng.choice(alphabet) for _ in range(7)) for _ in range(n)]

    han = [chr(c) for c in range(0x4E00, 0x9FA0)]
    return {
        "title case": lambda n: " ".join(w.capitalize() for w in fresh(n)),
        "names": lambda n: "\n".join(" ".join(w.capitalize() for w in fresh(2)) for _ in range(n // 2)),
        "prices": lambda n: "\n".join("item {} {}".format(*fresh(2)) for _ in range(-(-n // 3))),
        "menu": lambda n: "\n".join(" ".join(fresh(1 + i % 3)) for i in range(n // 2)),
        "shouted": lambda n: " ".join(w.upper() + "!!" for w in fresh(n)),
        "chinese": lambda n: "\n".join("".join(rng.choice(han) for _ in range(9)) + "，" + "".join(rng.choice(han) for _ in range(6)) + "。" for _ in range(n // 15 + 1)),
        "japanese": lambda n: "".join("".join(rng.choice(han) + "ぁあかさたな"[i % 6] for i in range(5)) + "。" for _ in range(n // 10 + 1)),
    }


def test_passages_of_short_units_go(spark):
    rng = random.Random(11)
    word = re.compile(r"[a-z0-9]+|[぀-鿿]")
    rows, passages = [], []
    for kind, make in kinds_of_short_units(rng).items():
        passage = make(54)
        own = [(make(rng.randint(5, 40)), make(rng.randint(5, 40))) for _ in range(4)]
        sep = "" if kind == "japanese" else "\n" if "\n" in passage else " "
        passages += [(kind, passage, len(rows) + i, a, b) for i, (a, b) in enumerate(own)]
        rows += [a + sep + passage + sep + b for a, b in own]
        rows += [passage, passage]
    got = {r.doc_id: r.text for r in substring_dedup.dedup_substrings(docs_frame(spark, rows)).collect()}
    # eight words in a row that an earlier text holds are a repeat; everything else has to stay
    held = {}
    for i, t in enumerate(rows):
        ws = word.findall(t.lower())
        for k in range(len(ws) - 7):
            held.setdefault(tuple(ws[k:k + 8]), i)
    for i, t in enumerate(rows):
        ws = word.findall(t.lower())
        repeat = {x for k in range(len(ws) - 7) if held[tuple(ws[k:k + 8])] < i for x in range(k, k + 8)}
        want = [w for k, w in enumerate(ws) if k not in repeat]
        left = word.findall(got[i].lower())
        assert len(left) - len(want) <= 2, (i, t, got[i])
        rest = iter(left)
        assert all(w in rest for w in want), (i, t, got[i])
    for kind, passage, i, a, b in passages:
        assert a in got[i] and b in got[i], kind
    assert sum(t == "" for t in got.values()) == 2 * 7


def test_unlike_short_units_between_repeats_stay(spark):
    first, second = "One repeated passage of quite some words here.", "Another repeated passage of as many words there."
    own = " ".join(w.capitalize() for w in words(random.Random(3), 30, "uvwxyz"))
    got = substring_dedup.dedup_substrings(docs_frame(spark, [f"{first} {second}", f"{first} {own} {second}"])).collect()
    assert {r.doc_id: r.text.strip() for r in got} == {0: f"{first} {second}", 1: own}


def test_first_place_of_a_rhythm_stays(spark):
    got = substring_dedup.dedup_substrings(docs_frame(spark, ["FOO!! BAR!! " * 40])).collect()
    assert 8 <= len(got[0].text.split()) <= 10
