import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import WORD, clashing, docs_frame, words
from vellum.llm import chat_format as cf
from vellum.llm import mixing, quality

TURNS = "conv_id long, turn long, role string, text string"


def formatted(spark, rows):
    segments = cf.format_segments(spark.createDataFrame(rows, TURNS))
    return cf.read_back(cf.render(segments))


def test_chat_round_trip_with_control_strings_nulls_and_unknown_roles(spark):
    tricky = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\/s> <s>", "a\nb \\", "", None, "<|user|> <|/x|> <|", "<<SYS>>[[INST]", "é😀 [/INST]"]
    rows = [(7, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant", "tool call", None, "", "%", "assistant"], tricky))]
    got = formatted(spark, rows).collect()[0]
    assert [(t.role, t.text) for t in got.turns] == [(r or "", t or "") for _, _, r, t in rows]
    assert got.loss_text == "".join(t or "" for _, _, r, t in rows if r == "assistant")
    assert not got.valid
    plain = formatted(spark, [(1, 0, "user", "no control"), (1, 1, "assistant", "none")]).collect()[0]
    assert plain.formatted == "[INST] no control [/INST]\n<s> none </s>\n" and plain.valid


@pytest.mark.parametrize("roles,valid,bad", [
    (["user", "assistant"], True, None), (["system", "user", "assistant", "user", "assistant"], True, None),
    (["user", "assistant", "user"], False, None), (["assistant"], False, 0), (["user", "user", "assistant"], False, 1),
    (["user", "system", "assistant"], False, 1)])
def test_chat_machine(spark, roles, valid, bad):
    got = formatted(spark, [(1, i, r, "x") for i, r in enumerate(roles)]).collect()[0]
    assert (got.valid, got.first_bad_turn) == (valid, bad)


def test_chat_of_many_turns(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"é turn {i} </s>" + " more" * (i % 7)) for i in range(2000)]
    rendered = cf.render(cf.format_segments(spark.createDataFrame(rows, TURNS)))
    got = cf.read_back(rendered).collect()[0]
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in rows] and got.valid
    assert got.loss_text == "".join(t for _, _, r, t in rows if r == "assistant")
    r = rendered.collect()[0]
    assert len(r.loss_spans) == 1000 and len(r.masks) == 2000 and [m is None for m in r.masks[:2]] == [True, False]
    texts = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
    assert texts[0].startswith("é turn 1 <\\/s>") and texts[-1].startswith("é turn 1999 ")


def test_chat_order_ties_null_ids_and_empty_table(spark):
    rows = [(None, 1, "user", "b"), (None, 1, "user", "a"), (None, None, "user", "first"), (2, 0, "user", "x"), (2, 0, "user", "x")]
    got = {r.conv_id: [t.text for t in r.turns] for r in formatted(spark, rows).collect()}
    assert got == {None: ["first", "a", "b"], 2: ["x", "x"]}
    assert formatted(spark, []).count() == 0


def test_chat_digest_of_segments(spark):
    rows = [(3, 1, "assistant", "</s>é"), (3, 0, "user", "q"), (3, 2, "assistant", "z")]
    r = cf.digests(formatted(spark, rows)).collect()[0]
    flat = "user\nq\nassistant\n</s>é\nassistant\nz\n"
    assert r.turns_sha256 == hashlib.sha256(flat.encode()).hexdigest() and r.n_turns == 3
    assert r.loss_chars == 6 and r.loss_sha256 == hashlib.sha256("</s>éz".encode()).hexdigest()


def brute_quality(text):
    ws = WORD.findall(text)
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    covered = {p for i, g in enumerate(grams) if g in twice for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(ws) < 50 or 100 * len(covered) > 50 * len(ws))


def test_quality_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "the", "a b", "a a a a", "#*$ %&|<>\n#*$ %&|<>\n\n", "é\x85ß x\x0bq\x0cz\r\n", "the of and " * 40]
    for _ in range(60):
        ws = [rng.choice(["the", "of", "x", "yy", "zz#", "|"]) for _ in range(rng.randint(0, 120))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t", "  ", "\n\n"]) for w in ws))
    texts.append(" ".join(words(rng, 20000)))
    got = quality.apply_quality_rules(clashing(docs_frame(spark, texts))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_quality(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.kept and r.base_failed)


def test_quality_is_one_projection(spark):
    plan = quality.apply_quality_rules(docs_frame(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Generate"))


def test_quality_empty_table_and_labels(spark, sf_small):
    assert quality.apply_quality_rules(docs_frame(spark, [])).count() == 0
    d = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    judged = quality.apply_quality_rules(d).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert judged.where("not kept").count() == 0


def brute_targets(sizes, weights, epochs):
    """Share out, freeze what is above its ceiling, share the rest again."""
    target = {s: 0.0 for s in sizes}
    left, open_ = float(sum(sizes.values())), set(sizes)
    while open_:
        level = left / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > epochs * sizes[s]}
        if not above:
            for s in open_:
                target[s] = level * weights[s]
            break
        for s in above:
            target[s] = epochs * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_mix_targets_and_takings(spark):
    rng = random.Random(3)
    texts, sources = [], []
    for s, n in (("a", 200), ("b", 3), ("c", 1), (None, 60), ("Z", 25)):
        for _ in range(n):
            texts.append(" ".join(words(rng, rng.randint(1, 30))))
            sources.append(s)
    texts += [None, "", " "]
    sources += ["a", "empty", None]
    df = clashing(docs_frame(spark, texts, sources))
    rows = mixing.mix(df).collect()
    again = {(r.doc_id, r.taken) for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows} and len(rows) == len(texts)
    sizes = {}
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r.doc_id] or "")) and r.taken <= 3 * r["size"]
        assert r.taken == r["size"] * len(r.mix_positions) and all(0 <= p <= 1 for p in r.mix_positions)
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1.0 + i % 3 for i, s in enumerate(order)}
    want = brute_targets(sizes, weights, 3)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert math.isclose(mine[0].target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r["size"] for r in mine) / 2 + 1e-6
    assert math.isclose(sum(want.values()), sum(sizes.values()))


def test_mix_empty_and_wordless_tables(spark):
    assert mixing.mix(docs_frame(spark, [])).count() == 0
    rows = mixing.mix(docs_frame(spark, [None, ""], ["a", None])).collect()
    assert [(r.taken, r.target) for r in rows] == [(0, 0.0), (0, 0.0)]


def test_schedule_inverts_its_integral(spark):
    for s in mixing.SCHEDULES:
        got = spark.range(101).select((F.col("id") / 100).alias("u")).select("u", s.time_at(F.col("u")).alias("t")).collect()
        for r in got:
            done = 0.0
            for (t0, w0), (t1, w1) in zip(s.knots, s.knots[1:]):
                x = min(max(r.t - t0, 0.0), t1 - t0)
                done += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            assert math.isclose(done / s.weight(), r.u, abs_tol=1e-9)
    assert [s.weight() for s in mixing.SCHEDULES] == pytest.approx([1, 2, 3])


def test_query_result_lies_in_training_order(spark, sf_small):
    from vellum.llm.queries import op6_mix_sources
    frame = op6_mix_sources(spark, sf_small)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "SQRT" in plan.upper() and "RepartitionByExpression" in plan
    rows = frame.collect()
    first = [r.first_position for r in rows]
    assert first == sorted(first, key=lambda p: (p is None, p)) and [p is None for p in first] == [r.taken == 0 for r in rows]
    assert all(r.first_position <= r.last_position <= 1 for r in rows if r.taken)
    assert all((r.taken > r["size"]) == (r.first_position < r.last_position) for r in rows if r.taken)


def test_training_order_is_range_sorted(spark, sf_small):
    mixed = mixing.mix(spark.read.parquet(f"{sf_small}/documents.parquet"))
    rows = mixing.training_order(mixed).withColumn("part", F.spark_partition_id()).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert len(rows) == mixed.select(F.sum(F.size("mix_positions"))).first()[0]


def test_a_task_gives_its_memory_back():
    from vellum.llm.common import lean

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 >> 20

    held = []

    def task(batches):
        block = [bytes(2000) for _ in range(100_000)]  # 200 MB of small pieces below one that stays
        held.append(bytes(2000))
        assert block
        yield from batches

    before = resident()
    assert list(lean(task)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 100


def test_batches_are_small_where_spark_says_nothing(spark):
    from tests.llm.helpers import docs_frame
    from vellum.llm import jaccard
    from vellum.llm.common import BATCH_BOUND, BATCH_BYTES, small_batches

    was = spark.conf.get(BATCH_BOUND)
    try:
        spark.conf.unset(BATCH_BOUND)  # as in a session that isn't ours
        jaccard.jaccard_components(docs_frame(spark, ["a b c d e f", "a b c d e f"])).collect()
        assert int(spark.conf.get(BATCH_BOUND)) == BATCH_BYTES
        spark.conf.set(BATCH_BOUND, "1000000")
        small_batches(spark)
        assert spark.conf.get(BATCH_BOUND) == "1000000"
    finally:
        spark.conf.set(BATCH_BOUND, was)
