"""Corpus pipeline: toxicity, near duplicates, repeated passages, mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  Stages work on everything their predecessor kept; all but
the last return the columns of ``documents``.  ``run`` writes each stage's
result as Parquet in the shared folder and reads it back as the next one's docs.

SQL can't express the tokenizer, the trained field or the genetic packing, so
there is no ORACLE_SQL; tests compare every stage with a brute-force version.

Columns beyond those of ``documents`` are left out.  Null text counts as empty;
rows are documents of their own even where they share an id or have none; empty
tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import jaccard, mixing, packing, substring_dedup, toxicity
from vellum.llm.common import documents, lasting, temporary_tables, written
from vellum.llm.queries import PASSAGE_WORDS, vocabulary_text
from vellum.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay."""
    field = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, field, keep=COLUMNS).where(F.col("score") < 0.5).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays; of equal rows one."""
    return jaccard.one_per_component(docs, COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document already holds; no document goes.

    The result is written and the tables of units and digests that led to it are dropped.
    """
    with temporary_tables(spark):
        out = substring_dedup.dedup_substrings(docs, min_words=PASSAGE_WORDS, keep=COLUMNS)
        cut = out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)
        return lasting(cut, "passages", compression="zstd")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a document once per time it is taken."""
    mixed = mixing.mix(docs, keep=COLUMNS)
    return mixing.training_order(mixed).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix's documents and their places in sequences."""
    return packing.pack_documents(docs, vocabulary_text("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
