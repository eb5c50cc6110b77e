"""Small fixtures and brute-force versions for the training-data operators."""

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_frame(spark, texts, sources=None, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def words(rng, n, alphabet="abcdefgh"):
    return [("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 6)))) for _ in range(n)]


def clashing(df):
    """The same with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    for c in ("n_words", "size", "node", "uid", "start", "mix_order", "score", "spans", "row_hash", "words"):
        df = df.withColumn(c, F.lit("x"))
    return df


def random_text(rng):
    return " ".join(words(rng, rng.randint(0, 40)))
