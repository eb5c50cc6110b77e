"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import (chat_format, chat_repair, jaccard, mixing, packing, prefix_trie, quality, secrets, substring_dedup,
                        token_counts, token_files, topk, toxicity)
from vellum.llm.common import documents, written
from vellum.llm.encode import vocabulary
from vellum.sources.tables import table


# Repeats below this many words are left: they are lines and sentences that many clean texts share.
PASSAGE_WORDS = 20


def vocabulary_text(name: str) -> str:
    import public_tokenizers

    return vocabulary(public_tokenizers.path(name))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_format.digests(chat_format.read_back(chat_format.render(chat_format.format_segments(turns))))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_products(vectors.where("vec_id % 50 = 0"), vectors, k=5, scale=256)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf_dir), vocabulary_text("word_bpe_49k.json"), end_id=2)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary_text("word_bpe_49k.json"), end_id=0)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.by_first_position(mixing.mix(documents(spark, sf_dir))).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken",
        *(F.round(c, 6).alias(c) for c in ("first_position", "last_position")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary_text("byte_bpe_50k.json"), limit=1024)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    field = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), field)
    return scored.select(
        "doc_id", (toxicity.fold_of(F.col("doc_id")) == toxicity.HELD_OUT_FOLD).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_quality_rules(documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(documents(spark, sf_dir), min_words=PASSAGE_WORDS)


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage to conversations: rows dropped, emptied, cut, repeated or given to the user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = chat_repair.digests(chat_repair.repair(damaged(turns))).withColumnRenamed("conv_id", "found_id")
    every = turns.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(documents(spark, sf_dir)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = written(prefix_trie.turn_ids(table(spark, sf_dir, "conversations")), "trie-ids")
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    every = ids.select("conv_id").distinct()
    lenders = ids.where("place < 5").withColumnRenamed("conv_id", "lender")
    lent = (every.join(lenders, F.col("conv_id") - F.col("conv_id") % 100 == F.col("lender"))
            .where(F.col("place") < borrowed).select("conv_id", "place", "id", "chars"))
    own = ids.where(F.col("place") >= borrowed).withColumn("place", F.col("place") + 5)
    return prefix_trie.trie(prefix_trie.paths(lent.unionByName(own), every))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_exact_topk": op2_exact_topk,
    "op3_token_files": op3_token_files,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_pack_sequences": op5_pack_sequences,
    "op6_mix_sources": op6_mix_sources,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_secret_scan": op12_secret_scan,
    "op13_prefix_trie": op13_prefix_trie,
}
