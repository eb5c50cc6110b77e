import itertools
import os
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.helpers import clashing, docs_frame
from vellum.llm import toxicity as tx


def test_marginals_equal_enumeration():
    r = np.random.default_rng(0)
    per, emit, moves = np.array([3, 0, 5, 1, 2]), r.normal(0, 2, 11), r.normal(0, 1, (2, 2))
    p, pairs, log_z = tx.marginals(emit, per, moves)
    want, want_pairs, total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in per:
        z, first, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(emit[at + i] * t for i, t in enumerate(tags)) + sum(moves[a, b] for a, b in zip(tags, tags[1:])))
            z, first = z + w, first + w * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                both[a, b] += w
        if n:
            want += list(first / z)
            want_pairs, total = want_pairs + both / z, total + np.log(z)
        at += n
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, total)


import pytest


@pytest.mark.parametrize("limit", [2500, 4000])
def test_held_out_accuracy_and_spans(spark, limit):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    field = tx.fit(docs, labels, limit=limit)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "lang").collect()
    held = [(r.doc_id, r.text) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    scored = tx.score_documents(clashing(docs_frame(spark, [t for _, t in held], ids=[i for i, _ in held])), field).collect()
    hits = [(r.score >= 0.5) == bool(toxic[r.doc_id]) for r in scored]
    assert np.mean(hits) > 0.98
    found = [r.score >= 0.5 for r in scored if toxic[r.doc_id]]
    assert np.mean(found) >= 0.92
    lang = {r.doc_id: r.lang for r in rows}
    for each in ("en", "de", "fr", "es"):
        assert np.mean([r.score >= 0.5 for r in scored if toxic[r.doc_id] and lang[r.doc_id] == each]) > 0.8, each
    text = dict(held)
    bad = {text[r.doc_id][s.start:s.end].lower().strip(tx.EDGE) for r in scored for s in r.spans}
    assert {"idiot", "scum", "moron"} <= bad


def test_score_edges(spark):
    field = tx.train(["you idiot there", "you there", "such an idiot", "an act such as", "idiot", "g h"] * 30, [1, 0, 1, 0, 1, 0] * 30)
    texts = [None, "", " \n", "idiot", "an\nIDIOT, here", "plain words", "plain " * 30000 + "idiot", "plain words"]
    rows = {r.doc_id: r for r in tx.score_documents(clashing(docs_frame(spark, texts)), field).collect()}
    assert [i for i in sorted(rows) if rows[i].score >= 0.5] == [3, 4, 6]
    assert [(s.start, s.end) for s in rows[4].spans] == [(3, 9)]
    assert rows[5].score == rows[7].score and all(0 <= r.score <= 1 for r in rows.values())
    assert tx.score_documents(docs_frame(spark, []), field).count() == 0
    with pytest.raises(ValueError):
        tx.score_documents(clashing(docs_frame(spark, [])), field, keep=("doc_id", "spans"))
    kept = tx.score_documents(docs_frame(spark, texts), field, keep=("text", "doc_id")).collect()
    assert {(r.doc_id, r.text, r.score) for r in kept} == {(i, texts[i], r.score) for i, r in rows.items()}


def test_score_equals_sums_over_all_taggings():
    """The score of a text from its definition: every tagging of every line weighed by hand."""
    field = tx.train(["you idiot there", "you there", "such an idiot", "an act such as"] * 10, [1, 0, 1, 0] * 10)
    texts = ["you idiot\nsuch an IDIOT there", "an act", "idiots, you there such"]
    got, _, _ = tx.Scorer(field).texts(pa.array(texts))
    for text, score in zip(texts, got):
        p = []
        for line in text.split("\n"):
            words = [w.lower().strip(tx.EDGE) for w in line.split()]
            emit = [field.bias + sum(field.weight.get(f, 0) for f in ["=" + w] + [w[:n] for n in range(3, 8) if len(w) >= n]) for w in words]
            each, z = np.zeros(len(words)), 0.0
            for tags in itertools.product((0, 1), repeat=len(words)):
                w = np.exp(sum(e * t for e, t in zip(emit, tags)) + sum(field.moves[a, b] for a, b in zip(tags, tags[1:])))
                each, z = each + w * np.array(tags), z + w
            p += list(each / z)
        top = min(max(max(p), 1e-4), 1 - 1e-4)
        x = [1, np.log(top / (1 - top)), np.log1p(sum(q for q in p if q > 0.1))]
        assert np.isclose(score, 1 / (1 + np.exp(-np.dot(x, field.calibration))))


def test_sample_is_bounded_in_rows_and_bytes_and_moved_back_to_the_rate(spark):
    texts = [("mean words here" if i % 10 == 0 else "kind words here") + f" {i}" for i in range(400)]
    docs = docs_frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got, toxic, rate = tx.training_sample(docs, labels, limit=40)
    assert len(got) == 40 and sum(toxic) == 20 and abs(rate - 0.1) < 0.03
    few, _, _ = tx.training_sample(docs, labels, limit=40, limit_bytes=200)
    assert few == got[:len(few)] and sum(map(len, few)) <= 200 < sum(map(len, got[:len(few) + 1]))


def test_labels_without_both_classes(spark):
    docs = docs_frame(spark, ["a", "b", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in tx.score_documents(docs, tx.fit(docs, none)).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (0, 1, 1), (0, 1, 1), (2, 0, 1)], none.schema)
    assert {r.score for r in tx.score_documents(docs, tx.fit(docs, odd)).collect()} <= {0.0, 1.0}


def test_reader_keeps_every_word():
    texts = ["a b\n\nc", "", " x  y ", "\n", "é\tz"]
    lines = tx.read_lines(pa.array(texts))
    assert [lines.words[c] for c in lines.code] == ["a", "b", "c", "x", "y", "é", "z"]
    assert lines.per_text.tolist() == [3, 1, 1, 2, 1] and lines.per_line.tolist() == [2, 0, 1, 0, 2, 0, 0, 2]


def test_training_runs_in_a_task(spark, monkeypatch):
    texts = [("mean words here" if i % 10 == 0 else "kind words here") + f" {i}" for i in range(400)]
    docs = docs_frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got, toxic, rate = tx.training_sample(docs, labels, limit=40)
    here, there = tx.train(got, toxic, rate=rate), tx.fit(docs, labels, limit=40)
    assert here.weight == there.weight and here.base_rate == there.base_rate and (here.calibration == there.calibration).all()
    monkeypatch.setattr(tx, "train", lambda texts, toxic, rate=None: ({}, 0.0, None, None, float(os.getpid())))
    assert tx.fit(docs, labels, limit=40).base_rate != os.getpid()
