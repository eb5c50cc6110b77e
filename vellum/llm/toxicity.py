"""Toxic spans by a linear-chain conditional random field.

A text is a chain of tags per line, one tag a word: toxic or not.  Features of
a word are itself and its first three to seven letters, folded to lower case.
Only documents have labels, so the words' labels are found: a word of a toxic
document is labelled toxic if one of its features lies in toxic documents more
often than chance allows (Chernoff bound, corrected for the number of
features); a toxic document without such a word takes its most telling words, so
that every toxic document explains itself.  The field is trained by gradient
steps on its exact likelihood, the labels are read off its marginals again (a
toxic document keeps at least its likeliest word), and training goes on.
Forward-backward runs over many lines side by side (numpy lanes).

A document's score comes from its marginals: the largest one's logit and the
expected number of toxic words, weighted by a logistic fit on marginals of texts
the field was not trained on (two folds).  Words whose marginal reaches one half
are the offending spans.

Labels are learned from a bounded sample, trained on in one task: at most ``SAMPLE``
rows, half of them toxic, and ``SAMPLE_BYTES`` of text, chosen by a hash of doc_id;
whole rows are left out, no text is cut.  Only the weights meet the driver.  The fit is moved back to the share of toxic rows among all training labels.  Scoring reads whole
texts and nothing but the text, a slice of ``SCORE_BYTES`` at a time.

Defined results: null and empty texts have no words and get the score of "no
toxic word".  Texts of any length are scored whole, one slice each if they are
longer than a slice.  Repeated rows are scored one by one.  Rows of ``labels``
with a null id or label don't train; without both classes every score is the
share of toxic ones among the training labels (0 if there are none).  Columns
named in ``keep`` pass through; ``score`` and ``spans`` are the result's and are
refused there.
"""

from __future__ import annotations

import pickle
from itertools import chain
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.common import lean, small_batches, whole_text
from vellum.llm.encode import ragged, slices

SAMPLE = 4000
SAMPLE_BYTES = 12 << 20
SCORE_BYTES = 2 << 20
LANE_WORDS = 50_000  # words a training step holds arrays for
STEPS = 25
ROUNDS = 1  # of labels read off the marginals
LIFT = 5.0  # times the odds of a toxic text that a telling feature has at least
HELD_OUT_FOLD, FOLDS = 0, 5
EDGE = "\"'`.,;:!?()[]{}<>|*#$%&-_~/\\“”‘’«»¡¿…"




def fold_of(doc_id: Column) -> Column:
    """The remainder that decides whether a row may train."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def features(word: str) -> list[str]:
    """Names of a folded word's features."""
    return ["=" + word, *(word[:n] for n in range(3, 8) if len(word) >= n)] if word else []


def fold(chunk: str) -> str:
    return chunk.lower().strip(EDGE)


class Lines(NamedTuple):
    """Words of many lines as codes into ``words``; lines from long to short, word by word across lines."""

    words: list[str]
    code: np.ndarray
    per_line: np.ndarray
    per_text: np.ndarray


def read_lines(texts: pa.Array) -> Lines:
    lines = pc.split_pattern(texts, "\n")
    chunks = pc.ascii_split_whitespace(lines.flatten())
    per_text = lines.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = chunks.flatten()
    lengths = chunks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    if blank.any():
        line = np.repeat(np.arange(len(lengths)), lengths)
        lengths = np.bincount(line[~blank], minlength=len(lengths))
        flat = flat.filter(pa.array(~blank))
    coded = flat.dictionary_encode()
    return Lines(coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False), lengths, per_text)


class Field(NamedTuple):
    """Weights: per feature for "toxic", and per pair of neighbouring tags; the score's calibration."""

    weight: dict[str, float]
    bias: float
    moves: np.ndarray  # 2 x 2, from tag to tag
    calibration: np.ndarray
    base_rate: float


class Passes(NamedTuple):
    """Odds of toxic along every line: up to and with a word, of what follows it; log normaliser; first words."""

    alpha: np.ndarray
    beta: np.ndarray
    log_z: float
    first: np.ndarray


def forward_backward(odds: np.ndarray, per_line: np.ndarray, moves: np.ndarray) -> Passes:
    """Odds of toxic over other are carried along each line, all lines at once: lines are ordered by
    length, so step t works on a prefix of them.  ``odds`` and ``moves`` are not logarithms here."""
    n = len(odds)
    order = np.argsort(-per_line, kind="stable")
    length = per_line[order]
    begin = (np.cumsum(per_line) - per_line)[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # lines longer than t
    alpha, beta = np.empty(n), np.ones(n)
    log_z = 0.0
    if not steps:
        return Passes(alpha, beta, log_z, begin[:0])
    a = odds[begin[:active[0]]]
    alpha[begin[:active[0]]] = a
    for t in range(1, steps):
        k = active[t]
        if k < len(a):
            log_z += float(np.log1p(a[k:]).sum())
            a = a[:k]
        at = begin[:k] + t
        stay = moves[0, 0] + a * moves[1, 0]
        log_z += float(np.log(stay).sum())
        a = odds[at] * (moves[0, 1] + a * moves[1, 1]) / stay
        alpha[at] = a
    log_z += float(np.log1p(a).sum())
    for t in range(steps - 2, -1, -1):
        at = begin[:active[t + 1]] + t + 1
        follow = odds[at] * beta[at]
        beta[at - 1] = (moves[1, 0] + moves[1, 1] * follow) / (moves[0, 0] + moves[0, 1] * follow)
    return Passes(alpha, beta, log_z, begin[:active[0]])


def toxic_odds(emit: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(emit, -30, 30))


def word_marginals(emit: np.ndarray, per_line: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(toxic) per word; ``emit`` is toxic minus other."""
    run = forward_backward(toxic_odds(emit), per_line, np.exp(moves))
    odds = run.alpha * run.beta
    return odds / (1 + odds)


def marginals(emit: np.ndarray, per_line: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(toxic) per word, expected number of each move, log normaliser."""
    e, m = toxic_odds(emit), np.exp(moves)
    run = forward_backward(e, per_line, m)
    odds = run.alpha * run.beta
    starts = np.zeros(len(emit), bool)
    starts[run.first] = True
    right = np.flatnonzero(~starts)
    follow = e[right] * run.beta[right]
    before = run.alpha[right - 1]
    w = np.stack([np.full(len(right), m[0, 0]), m[0, 1] * follow, before * m[1, 0], before * m[1, 1] * follow])
    w /= w.sum(axis=0)
    return odds / (1 + odds), w.sum(axis=1).reshape(2, 2), run.log_z


def _folded(lines: Lines) -> Lines:
    """The same with words that fold alike as one."""
    number: dict[str, int] = {}
    to = np.array([number.setdefault(fold(w), len(number)) for w in lines.words], np.int32)
    return lines._replace(words=list(number), code=to[lines.code] if len(to) else lines.code)


def _distinct_pairs(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(a.astype(np.int64) * max(n, 1) + b)
    return (both // max(n, 1)).astype(np.int32), (both % max(n, 1)).astype(np.int32)


def _most(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The largest value of every text."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, text, values)
    return top


def _explained(word_is: np.ndarray, evidence: np.ndarray, text: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Labels: words in toxic texts that are called toxic; where a text has none, the ones with the most evidence."""
    label = word_is & (toxic[text] > 0)
    has = np.bincount(text, weights=label, minlength=len(toxic)) > 0
    alone = (toxic[text] > 0) & ~has[text]
    return label | (alone & (evidence >= _most(evidence, text, len(toxic))[text]))


class Sample(NamedTuple):
    """Labelled texts ready to train on: folded words, their features, first labels."""

    lines: Lines
    text: np.ndarray      # of every word in place
    toxic: np.ndarray     # of every text
    names: dict[str, int]
    word_of: np.ndarray   # (word, feature) pairs
    feature: np.ndarray
    label: np.ndarray     # of every word in place


def _label_words(lines: Lines, toxic: np.ndarray) -> Sample:
    """Features that three or more texts have, and the words' first labels; ``lines`` are folded."""
    text = np.repeat(np.repeat(np.arange(len(lines.per_text), dtype=np.int32), lines.per_text), lines.per_line)
    number: dict[str, int] = {}
    of_word = [[number.setdefault(f, len(number)) for f in features(w)] for w in lines.words]
    sizes = np.fromiter(map(len, of_word), np.int64, len(of_word))
    word = np.repeat(np.arange(len(of_word), dtype=np.int32), sizes)
    feature = np.fromiter(chain.from_iterable(of_word), np.int32, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    del of_word
    doc, in_doc = _distinct_pairs(text, lines.code, len(lines.words))
    hits, seen = np.zeros(len(number)), np.zeros(len(number))
    for t in np.array_split(np.arange(len(lines.per_text)), max(1, len(doc) // 100_000)):
        if not len(t):
            continue
        some = slice(*np.searchsorted(doc, [t[0], t[-1] + 1]))
        at = ragged(first[in_doc[some]], sizes[in_doc[some]])
        d, f = _distinct_pairs(np.repeat(doc[some], sizes[in_doc[some]]), feature[at], len(number))
        hits += np.bincount(f, weights=toxic[d], minlength=len(number))
        seen += np.bincount(f, minlength=len(number))
    base = float(np.clip(toxic.mean(), 1e-6, 1 - 1e-6))
    share = np.clip(hits / np.maximum(seen, 1), 1e-9, 1 - 1e-9)
    divergence = seen * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
    lift = share / (1 - share) >= LIFT * base / (1 - base)
    telling = lift & (divergence > np.log(100.0 * max(len(number), 1)))
    telling_word = np.bincount(word, weights=telling[feature], minlength=len(sizes)) > 0
    # a word's evidence is that of its best feature: stems pool the rare forms of a word
    signed = np.where(share > base, divergence, -divergence)
    evidence = np.full(len(sizes), -np.inf)
    np.maximum.at(evidence, word, signed[feature])
    label = _explained(telling_word[lines.code], evidence[lines.code], text, toxic)
    used = seen >= 3
    renumber = np.cumsum(used) - 1
    kept = used[feature]
    return Sample(lines, text, toxic, {n: int(renumber[i]) for n, i in number.items() if used[i]}, word[kept],
                  renumber[feature[kept]].astype(np.int32), label)


def _lanes(per_line: np.ndarray) -> list[tuple[slice, slice]]:
    """Runs of whole lines of about ``LANE_WORDS`` words: (words in place, lines)."""
    ends = np.cumsum(per_line)
    out, line, word = [], 0, 0
    while line < len(ends):
        last = max(line + 1, int(np.searchsorted(ends, word + LANE_WORDS, side="right")))
        out.append((slice(word, int(ends[last - 1])), slice(line, last)))
        line, word = last, int(ends[last - 1])
    return out


def _descend(sample: Sample, steps: int) -> np.ndarray:
    """Weights of features, bias and moves after all rounds."""
    n_names, n_words = len(sample.names), len(sample.lines.words)
    # lines of like length side by side
    lengths = sample.lines.per_line
    order = np.argsort(-lengths, kind="stable")
    per_line = lengths[order]
    place = ragged((np.cumsum(lengths) - lengths)[order], per_line).astype(np.int32)
    code, text, label = sample.lines.code[place], sample.text[place], sample.label[place]
    del place
    starts = np.zeros(len(code) + 1, bool)
    starts[np.cumsum(per_line) - per_line] = True
    follows = np.flatnonzero(~starts[:-1]).astype(np.int32)
    lanes = _lanes(per_line)
    theta = np.zeros(n_names + 1 + 4)
    theta[n_names] = np.log((label.sum() + 1) / (len(label) + 2))
    p = np.zeros(len(code))
    for round_ in range(ROUNDS + 1):
        if round_:
            label = _explained(p >= 0.5, p, text, sample.toxic)
        seen_moves = np.bincount(label[follows - 1] * np.int8(2) + label[follows], minlength=4).reshape(2, 2)
        m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, (steps if not round_ else steps // 2) + 1):
            per_word = theta[n_names] + np.bincount(sample.word_of, weights=theta[sample.feature], minlength=n_words)
            moves = theta[n_names + 1:].reshape(2, 2)
            expected, error = np.zeros((2, 2)), np.zeros(n_words)
            for words, rows in lanes:
                p[words], pairs, _ = marginals(per_word[code[words]], per_line[rows], moves)
                expected += pairs
                error += np.bincount(code[words], weights=p[words] - label[words], minlength=n_words)
            grad = np.concatenate([np.bincount(sample.feature, weights=error[sample.word_of], minlength=n_names), [error.sum()],
                                   (expected - seen_moves).ravel()]) + 0.01 * theta
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad ** 2
            theta = theta - 0.3 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return theta


def _uncalibrated(texts: list[str], y: np.ndarray, steps: int) -> Field:
    sample = _label_words(_folded(read_lines(pa.array(texts, pa.string()))), y)
    theta = _descend(sample, steps)
    weight = {n: float(theta[i]) for n, i in sample.names.items() if abs(theta[i]) > 1e-3}
    n = len(sample.names)
    return Field(weight, float(theta[n]), theta[n + 1:].reshape(2, 2), np.zeros(3), float(y.mean()))


def train(texts: list[str], toxic: list[int], steps: int = STEPS, rate: float | None = None) -> Field:
    """Fit the field and its calibration on labelled texts (in memory, a bounded sample).

    ``rate`` is the share of toxic texts that scores stand for, if it isn't that of the sample.
    """
    y = np.array(toxic, float)
    base = float(y.mean()) if len(y) else 0.0
    if not 0 < base < 1:
        return Field({}, 0.0, np.zeros((2, 2)), np.zeros(0), base if rate is None else rate)
    # marginals of texts that the field hasn't seen, in two folds with the classes dealt in turn
    order = np.argsort(y, kind="stable")
    half = np.zeros(len(y), bool)
    half[order[::2]] = True
    x = np.zeros((len(y), 3))
    for fold in (half, ~half):
        rest = ~fold
        if 0 < y[rest].mean() < 1:
            field = _uncalibrated([texts[i] for i in np.flatnonzero(rest)], y[rest], steps)
        else:
            field = _uncalibrated(texts, y, steps)
        scorer = Scorer(field)
        for first, part in slices(pa.array([texts[i] for i in np.flatnonzero(fold)], pa.string()), SCORE_BYTES):
            lines = read_lines(part)
            x[np.flatnonzero(fold)[first:first + len(part)]] = summary(scorer.words(lines), lines)
    beta = np.zeros(3)
    for _ in range(25):  # Newton steps of a ridge logistic fit
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.01 * np.eye(3)
        beta = beta - np.linalg.solve(h, x.T @ (q - y) + 0.01 * beta)
    if rate is not None and 0 < rate < 1:
        beta[0] += np.log(rate / (1 - rate)) - np.log(base / (1 - base))
    return _uncalibrated(texts, y, steps)._replace(calibration=beta, base_rate=base if rate is None else rate)


def summary(p: np.ndarray, lines: Lines) -> np.ndarray:
    """Per text: 1, logit of the largest marginal, log of 1 + the expected number of toxic words."""
    text = np.repeat(np.repeat(np.arange(len(lines.per_text)), lines.per_text), lines.per_line)
    top = np.full(len(lines.per_text), 1e-4)
    np.maximum.at(top, text, p)
    top = np.clip(top, 1e-4, 1 - 1e-4)
    # words far from toxic don't add up over a long text
    amount = np.bincount(text, weights=np.where(p > 0.1, p, 0.0), minlength=len(lines.per_text))
    return np.stack([np.ones(len(top)), np.log(top / (1 - top)), np.log1p(amount)], axis=1)


class Scorer:
    def __init__(self, field: Field):
        self.field = field
        self.known: dict[str, float] = {}

    def words(self, lines: Lines) -> np.ndarray:
        if len(self.known) > 100_000:
            self.known = {}
        known, weight = self.known, self.field.weight
        emit = np.empty(len(lines.words))
        for i, w in enumerate(lines.words):
            e = known.get(w)
            if e is None:
                e = known[w] = self.field.bias + sum(weight.get(f, 0.0) for f in features(fold(w)))
            emit[i] = e
        return word_marginals(emit[lines.code], lines.per_line, self.field.moves)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Lines]:
        lines = read_lines(texts)
        if not len(self.field.calibration):
            return np.full(len(texts), self.field.base_rate), np.zeros(len(lines.code)), lines
        p = self.words(lines)
        return 1 / (1 + np.exp(-np.clip(summary(p, lines) @ self.field.calibration, -30, 30))), p, lines


def _sampled(docs: DataFrame, labels: DataFrame, limit: int, limit_bytes: int) -> tuple[DataFrame | None, float | None]:
    """The sample as one ordered partition (text, toxic), and the share of toxic rows; None without labels."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .where(fold_of(F.col("doc_id")) != HELD_OUT_FOLD)
             .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
             .withColumn("turn", F.xxhash64("doc_id")))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None, None
    few = min(counts.get(True, 0), max(limit // 2, limit - counts.get(False, 0)))
    share = {True: few, False: limit - few}
    halves = [known.where(F.col("toxic") == c).orderBy("turn", "doc_id").limit(share[c]) for c in (True, False)]
    chosen = halves[0].unionByName(halves[1])  # at most ``limit`` rows
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id").orderBy("turn", "doc_id", "text").limit(limit)
    so_far = F.sum(F.octet_length("text").cast("long")).over(W.orderBy("turn", "doc_id", "text"))
    chosen_rows = rows.withColumn("so_far", so_far).where(F.col("so_far") <= limit_bytes).select("text", "toxic")
    return chosen_rows, counts.get(True, 0) / sum(counts.values())


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE,
                    limit_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[int], float | None]:
    """Labelled texts of the training folds (bounded, see above), and the share of toxic rows among all their labels."""
    rows, rate = _sampled(docs, labels, limit, limit_bytes)
    got = rows.collect() if rows is not None else []
    return [r.text for r in got], [int(r.toxic) for r in got], rate


SCORE_SCHEMA = "score double, spans array<struct<start:long,end:long>>"


def score_documents(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, score, and spans (code points) of offending words, merged where they touch."""
    if {"score", "spans"} & set(keep):
        raise ValueError("columns named score or spans can't be kept: the result has them")
    kept_text = "text" in keep  # then the text travels once
    rest = [c for c in keep if c != "text"]
    rows = docs.select(F.struct(*rest).alias("kept") if rest else F.struct(F.lit(0)).alias("kept"),
                       F.col("text").alias("text"))
    kept_type = rows.schema["kept"].dataType.simpleString()
    schema = f"kept {kept_type}, {'text string, ' if kept_text else ''}{SCORE_SCHEMA}"
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+").finditer
        scorer = Scorer(field)
        for batch in batches:
            for first, given in slices(batch.column("text"), SCORE_BYTES):
                texts = pc.fill_null(given, "")
                score, p, lines = scorer.texts(texts)
                per_text = np.bincount(np.repeat(np.arange(len(texts)), lines.per_text), weights=lines.per_line,
                                       minlength=len(texts)).astype(np.int64)
                begin = np.cumsum(per_text) - per_text
                spans: list[list[dict]] = [[] for _ in range(len(texts))]
                bad = np.flatnonzero(p >= 0.5)
                for t in np.unique(np.searchsorted(begin, bad, side="right") - 1).tolist():
                    offending = set((bad[(bad >= begin[t]) & (bad < begin[t] + per_text[t])] - begin[t]).tolist())
                    last = -2
                    for i, m in enumerate(word(texts[t].as_py())):
                        if i in offending:
                            if last == i - 1:
                                spans[t][-1]["end"] = m.end()
                            else:
                                spans[t].append({"start": m.start(), "end": m.end()})
                            last = i
                out = [batch.column("kept").slice(first, len(texts)), *([given] if kept_text else []), pa.array(score), pa.array(spans, span_type)]
                yield pa.RecordBatch.from_arrays(out, names=["kept", *(["text"] if kept_text else []), "score", "spans"])

    small_batches(docs.sparkSession)
    found = rows.mapInArrow(lean(scored), schema)
    return found.select(*(F.col("text") if c == "text" else F.col("kept")[c].alias(c) for c in keep), "score", "spans")


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Field:
    """The field trained on ``training_sample``, in a task: the driver gets the weights and no text."""
    rows, rate = _sampled(docs, labels, limit, SAMPLE_BYTES)
    if rows is None:
        return train([], [])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            toxic += map(int, batch.column("toxic").to_pylist())
        field = pickle.dumps(tuple(train(texts, toxic, rate=rate)))
        yield pa.RecordBatch.from_arrays([pa.array([field], pa.binary())], names=["field"])

    found = rows.coalesce(1).mapInArrow(lean(trained), "field binary").collect()
    return Field(*pickle.loads(found[0].field)) if found else train([], [], rate=rate)
