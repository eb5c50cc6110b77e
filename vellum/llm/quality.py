"""Quality rules: a threshold table compiled into one projection.

Every figure is a built-in expression over the row's own text, so the operator
has no shuffle and no user function.  Rules compare integers (``1000 * part``
against ``limit * whole``), so no verdict hangs on floating-point rounding.

Null text counts as empty; a text without words fails the base rules.
Repeated rows are judged one by one.  Extra columns are left out of the result
and never clash, since only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import SPACES, WORD, whole_text

SYMBOLS = "#*$%&|<>"

# The most frequent function words of English, German, French
# and Spanish.
STOP_WORDS = (
    "the of and to in is for on that with as at by be are this from or an a was it "
    "der die das und zu den von mit ist für auf im dem nicht ein eine des sich auch "
    "le la les de et que un une est pour dans du en qui par sur au il elle "
    "el los las y una por con para del se no su"
).split()


class Rule(NamedTuple):
    """Keep while ``least * whole <= 1000 * part <= most * whole`` (None: no bound)."""

    name: str
    part: str
    whole: str
    least: int | None
    most: int | None


RULES = (
    Rule("length", "n_words", "one", None, 1_000_000_000),
    Rule("mean word length", "word_chars", "n_words", 1500, 25_000),
    Rule("symbols to words", "n_symbols", "n_words", None, 150),
    Rule("stop words to words", "n_stop_words", "n_words", 30, None),
    Rule("repeated lines to lines", "n_dup_lines", "n_lines", None, 350),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The verdict of the whole table as one boolean expression."""
    verdict = F.lit(True)
    for r in rules:
        part, whole = F.lit(1000) * F.col(r.part), F.col(r.whole)
        if r.least is not None:
            verdict &= part >= F.lit(r.least) * whole
        if r.most is not None:
            verdict &= part <= F.lit(r.most) * whole
    return verdict


def repeated_window_words(words: Column, grams: Column) -> Column:
    """Words lying in a 3-word window that the text holds twice or more.

    Equal windows become neighbours in a sorted array; texts without any
    (most of them) stop at the distinct count.
    """
    ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    twice = F.transform(F.array(ordered), lambda s: F.filter(
        s, lambda x, i: (F.get(s, i + 1)["g"] == x["g"]) | ((i > 0) & (F.get(s, i - 1)["g"] == x["g"]))))
    covered = F.flatten(F.transform(twice[0], lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.size(F.array_distinct(covered))).otherwise(0)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules refer to."""
    base = docs.select("doc_id", whole_text().alias("text"))
    lists = base.select(
        "doc_id", "text",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    windows = lists.withColumn("grams", F.when(F.size("words") >= 3, F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)),
    )).otherwise(F.array().cast("array<string>")))
    return windows.select(
        "doc_id",
        F.lit(1).cast("long").alias("one"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words"), F.col("grams")).cast("long").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def apply_quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measure(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
        failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"))
