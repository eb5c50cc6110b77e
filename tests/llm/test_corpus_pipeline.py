import collections
import os

import pyarrow as pa

import corpus_pipeline as cp
from tests.llm.helpers import DOC_SCHEMA, WORD, clashing
from tests.llm.test_pairs import brute_components, brute_dedup
from vellum.llm import mixing
from vellum.llm import toxicity as tx
from vellum.llm.common import lasting, temporary_tables, written
from vellum.session import shared_root


def through(spark, docs, sf_dir):
    """Every stage's result, each worked on as the driver does it."""
    out = {"": docs}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out[name] = docs
    return out


def test_every_stage_against_brute_force(spark, sf_small):
    source = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = {k: v.collect() for k, v in through(spark, clashing(source), sf_small).items()}
    names = [n for n, _ in cp.STAGES]
    assert all(list(got[n][0].asDict()) == list(cp.COLUMNS) for n in names[:-1])
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    kept = {r.doc_id for r in got["toxicity"]}
    assert all(r.doc_id in kept for r in got[""] if toxic.get(r.doc_id) == 0)
    field = tx.fit(source, spark.read.parquet(f"{sf_small}/labels.parquet"))
    score = {r.doc_id: tx.Scorer(field).texts(pa.array([r.text or ""]))[0][0] for r in got[""]}
    assert kept == {i for i, x in score.items() if x < 0.5} and len(kept) < len(score)
    before = got["toxicity"]
    component = {d: c for d, _, c in brute_components([r.doc_id for r in before], [r.text for r in before])}
    assert {r.doc_id for r in got["ngram_jaccard_join"]} == {d for d, c in component.items() if d == c}
    want = {(i, t) for i, t, _ in brute_dedup([(r.doc_id, r.text) for r in got["ngram_jaccard_join"]], cp.PASSAGE_WORDS)}
    assert {(r.doc_id, r.text) for r in got["substring_dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in got["substring_dedup"])
    words = {r.doc_id: len(WORD.findall(r.text)) for r in got["substring_dedup"]}
    times = collections.Counter(r.doc_id for r in got["mix_sources"])
    assert set(times) <= set(words) and max(times.values()) <= 3
    rows = mixing.mix(spark.createDataFrame(got["substring_dedup"])).collect()
    assert times == collections.Counter({r.doc_id: len(r.mix_positions) for r in rows if r.mix_positions})
    due = sorted((p, r.doc_id) for r in rows for p in r.mix_positions)
    assert [r.doc_id for r in got["mix_sources"]] == [i for _, i in due]
    total = sum(words.values())
    assert abs(sum(words[d] * n for d, n in times.items()) - total) <= 0.1 * total
    assert {r.doc_id for r in got["best_fit_packing"]} == set(times)
    bins = {}
    for r in got["best_fit_packing"]:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 2048


def test_toxic_documents_go_and_clean_ones_stay(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in cp.drop_toxic(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).select("doc_id").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    toxic, clean = ([i for i, t in labels.items() if bool(t) == c] for c in (True, False))
    assert sum(i not in kept for i in toxic) >= 0.8 * len(toxic) and sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_pipeline_of_nulls_and_repeats(spark, sf_small):
    rows = [(1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (None, None, None, None, None),
            (None, "", "en", None, 0), (2, "A b c d e f g", "en", None, 13), (3, "x" * 50_000, "de", "t", 50_000)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = through(spark, docs, sf_small)
    assert collections.Counter(r.doc_id for r in got["ngram_jaccard_join"].collect()) == {1: 1, None: 2, 3: 1}
    assert got["best_fit_packing"].count() >= 1
    assert through(spark, docs.limit(0), sf_small)["best_fit_packing"].count() == 0


def test_the_near_copy_stage_leaves_only_its_choice(spark, sf_small):
    root = shared_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    kept = cp.drop_near_copies(spark, spark.read.parquet(f"{sf_small}/documents.parquet"), sf_small)
    left = set(os.listdir(root)) - before
    assert len(left) == 1 and "jaccard-kept" in left.pop()
    assert kept.count() > 0


def test_temporary_tables_go_also_by_an_error(spark):
    rows = spark.range(3)
    try:
        with temporary_tables(spark):
            with temporary_tables(spark):
                inner = written(rows, "inner")
                outer = lasting(inner, "outer")
            lasts = lasting(outer, "lasts")
            assert outer.count() == 3 and not any("inner" in n for n in os.listdir(shared_root(spark).removeprefix("file:")))
            raise KeyError
    except KeyError:
        pass
    names = os.listdir(shared_root(spark).removeprefix("file:"))
    assert lasts.count() == 3 and not any("vellum-outer" in n for n in names)


def test_entry_lists_the_operators():
    import __spark_entry__ as e

    keys = list(e.queries())
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in keys) == 1
    assert "pipeline" in keys and len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
