"""Whole texts to token ids with the tokenizers library, inside Arrow batches.

The vocabulary drops white space, so the ids of a text are the ids of its
ASCII-white-space chunks in a row.  Equal chunks of a batch are looked up once,
and the documents' ids are then gathered with numpy.

A chunk that is one word of Latin letters between plain marks is cut into the
three (by Arrow, all chunks at once) and these go straight to the library's BPE
model: normalising and pre-tokenising do nothing to such a word but lower it,
and cut it off its marks.  Every other chunk takes the library's whole way.
Words, marks and other chunks are encoded once and kept for the task's next
batches; the table starts anew once it has more than ``KEPT_PIECES``.
"""

from __future__ import annotations

import gc
from contextlib import contextmanager
from itertools import chain
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
KEPT_PIECES = 400_000


def vocabulary(path: str) -> str:
    """The tokenizer file's text (under 2 MB); tasks get it with their code, so
    executors need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive runs of rows of about ``limit`` bytes, one row at least, with their first row's number."""
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


@contextmanager
def no_cycles():
    """Work that makes many small objects and no cycles, without the collector walking them over and over."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


# Letters whose lower case and composed form are plain; no apostrophe before a
# word (it could begin a contraction) and nothing that could hold a special string.
_MARKS, _LETTERS = r"[!-&(-/:;=?@\[-`{}~]*", "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_PLAIN = f"^(?P<before>{_MARKS})(?P<word>{_LETTERS})(?P<after>{_MARKS})$"


def byte_letters() -> list[str]:
    """The public byte alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class ChunkEncoder:
    def __init__(self, vocabulary_text: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self._forget()

    def _forget(self) -> None:
        """An empty table of pieces; its row 0 has no ids."""
        self.words: dict[str, int] = {"": 0}
        self.others: dict[str, int] = {}
        self.starts, self.lengths, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _word_ids(self, pieces: list[str]) -> list[list[int]]:
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(self.letters))]
                for p in pieces]

    def _other_ids(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _rows(self, pieces: pa.Array, known: dict[str, int], ids_of: Callable[[list[str]], list[list[int]]]) -> np.ndarray:
        """The table's row of every piece; those not known yet are added."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        with no_cycles():
            new = [p for p in distinct if p not in known]
            if new:
                found = ids_of(new)
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
                known.update(zip(new, range(len(self.starts), len(self.starts) + len(new))))
                self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
                self.lengths = np.concatenate([self.lengths, lengths])
                self.ids = np.concatenate([self.ids, ids])
            rows = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        return rows[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in a row, and the number of ids of each."""
        found = pc.extract_regex(chunks, pattern=_PLAIN)
        plain = found.is_valid()
        parts = found.filter(plain)
        before, word, after = (pc.struct_field(parts, c) for c in ("before", "word", "after"))
        three = np.zeros((len(chunks), 3), np.int64)  # rows of the pieces; other chunks are one piece
        at = plain.to_numpy(zero_copy_only=False)
        three[at] = self._rows(pa.concat_arrays([before, pc.utf8_lower(word), after]), self.words, self._word_ids).reshape(3, -1).T
        three[~at, 0] = self._rows(chunks.filter(pc.invert(plain)), self.others, self._other_ids)
        counts = self.lengths[three]
        return self.ids[ragged(self.starts[three].ravel(), counts.ravel())], counts.sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a row, and the number of ids of each (null: none)."""
        if len(self.words) + len(self.others) > KEPT_PIECES:
            self._forget()
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        per_text = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        ids, lengths = self._chunks(coded.dictionary)
        chunk = coded.indices.to_numpy(zero_copy_only=False) if len(coded) else np.zeros(0, np.int64)
        counts = lengths[chunk]
        ids = ids[ragged((np.cumsum(lengths) - lengths)[chunk], counts)]
        sums = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(per_text)
        return ids, sums[ends] - sums[ends - per_text]


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after every row's ids."""
    return np.insert(ids, np.cumsum(lengths), np.uint32(end_id)), lengths + 1
