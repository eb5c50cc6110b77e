"""Token counts by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens, equal pre-tokens are counted once.  A batch of
distinct pre-tokens is one flat numpy array of symbols with row bounds; each
round looks up the rank of every neighbouring pair, takes each row's lowest,
merges all its non-overlapping occurrences from the left in all rows at once,
and rows without a known pair leave.  What counts is the symbols left over.

A text splits before every run of white space without changing its
pre-tokens.  Where each break is a single space between two other characters
(almost every text) the pieces come from Arrow's splitter; other texts are
pre-tokenised whole.  Special strings are one token each, cut out first, as
the library does by default.

Defined results: null text is empty: 0 bytes, 0 tokens.  Repeated rows are
counted one by one; only doc_id and text are read; no truncation.
"""

from __future__ import annotations

import json
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import whole_text
from vellum.llm.encode import byte_letters, slices

KEPT = 300_000
COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class ByteBpe:
    """Merge ranks of a byte-level vocabulary file as sorted arrays."""

    def __init__(self, vocabulary_text: str):
        import regex

        spec = json.loads(vocabulary_text)
        vocab = spec["model"]["vocab"]
        self.symbol = np.array([vocab[c] for c in byte_letters()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.base = np.int64(len(vocab) + 1)
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        # Fixed pattern of byte-level pre-tokenisation.
        self.find = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall

    def _pairs(self, symbols: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or a value above all) and table place of the pair that starts at each symbol."""
        key = symbols[:-1] * self.base + symbols[1:]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[place] == key) & (row[:-1] == row[1:])
        return np.where(known, self.rank[place], len(self.keys)), place

    def surviving(self, pretokens: list[str]) -> np.ndarray:
        """Symbols of each pre-token once no pair is left to merge."""
        raw = [p.encode("utf-8") for p in pretokens]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.symbol[np.frombuffer(b"".join(raw), np.uint8)]
        row = np.repeat(np.arange(len(raw)), sizes)
        done = np.zeros(len(raw), np.int64)
        none = len(self.keys)
        while len(symbols) > 1:
            rank, place = self._pairs(symbols, row)
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            best = np.minimum.reduceat(np.append(rank, none), first)
            alive = best < none
            counts = np.diff(np.append(first, len(symbols)))
            done[row[first[~alive]]] = counts[~alive]
            per_symbol = np.repeat(np.where(alive, best, -1), counts)
            hit = np.append(rank, none) == per_symbol
            # of touching hits (a pair of equal symbols in a run) every other one counts, from the left
            run_start = hit & ~np.concatenate([[False], hit[:-1]])
            since = np.arange(len(hit)) - np.maximum.accumulate(np.where(run_start, np.arange(len(hit)), 0))
            hit &= since % 2 == 0
            symbols = symbols.copy()
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[place[at]]
            stay = np.repeat(alive, counts)
            stay[at + 1] = False
            symbols, row = symbols[stay], row[stay]
        if len(symbols):
            done[row] = 1
        return done


class Counter:
    """Counts of texts and of pieces of them, remembered up to a bound."""

    def __init__(self, vocabulary_text: str):
        self.bpe = ByteBpe(vocabulary_text)
        self.pieces: dict[str, int] = {}
        self.pretokens: dict[str, int] = {}

    def count(self, strings: list[str]) -> np.ndarray:
        """Tokens of each string by itself."""
        specials = np.zeros(len(strings), np.int64)
        found = []
        for i, s in enumerate(strings):
            if self.bpe.cut is not None and "<" in s and (n := len(self.bpe.cut.findall(s))):
                specials[i] = n
                found.append([p for part in self.bpe.cut.split(s) for p in self.bpe.find(part)])
            else:
                found.append(self.bpe.find(s))
        new = list({p for f in found for p in f if p not in self.pretokens})
        if len(self.pretokens) + len(new) > KEPT:
            self.pretokens = {}
            new = list({p for f in found for p in f})
        if new:
            self.pretokens.update(zip(new, self.bpe.surviving(new).tolist()))
        known = self.pretokens
        return specials + np.fromiter((sum([known[p] for p in f]) for f in found), np.int64, len(found))

    def texts(self, texts: pa.Array) -> np.ndarray:
        parts = pc.split_pattern(texts, " ")
        per_text = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(per_text)
        coded = parts.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False)
        # a piece that is empty or has white space at an end may belong to a longer run of white space
        odd = np.fromiter((not s or s[0].isspace() or s[-1].isspace() for s in distinct), bool, len(distinct))
        whole = np.add.reduceat(odd[code].astype(np.int64), ends - per_text) > 0
        leads = np.zeros(len(code), bool)
        leads[ends - per_text] = True
        used = np.zeros(len(distinct), bool)
        used[code[~leads & ~np.repeat(whole, per_text)]] = True
        at = np.flatnonzero(used)
        amount = np.zeros(len(distinct), np.int64)
        amount[at] = self._inner([distinct[i] for i in at])
        each = np.where(leads, 0, amount[code])
        out = np.add.reduceat(each, ends - per_text)
        out[~whole] += self.count([distinct[i] for i in code[(ends - per_text)[~whole]]])
        if whole.any():
            out[whole] = self.count(texts.take(pa.array(np.flatnonzero(whole))).to_pylist())
        return out

    def _inner(self, pieces: list[str]) -> np.ndarray:
        """Tokens of pieces that follow a space."""
        new = [p for p in pieces if p not in self.pieces]
        if len(self.pieces) + len(new) > KEPT:
            self.pieces, new = {}, pieces
        if new:
            self.pieces.update(zip(new, self.count([" " + p for p in new]).tolist()))
        return np.fromiter((self.pieces[p] for p in pieces), np.int64, len(pieces))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) per document."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), pc.cast(pc.binary_length(texts), pa.int64()),
                     pa.array(counter.texts(texts))], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(counted, COUNT_SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
