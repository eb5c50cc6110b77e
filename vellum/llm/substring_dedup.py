"""Substring dedup by hashing lines and the sentences inside them.

A text is cut into units that together are the text: at line ends, after a
sentence end, and before a capitalised word, so that a passage set into the
middle of a line still starts a unit.  A unit is normalised (lower case,
letters and digits only, single spaces) and hashed to 128 bits; letters of
scripts without spaces count as a word each.  A unit below the floor of
``MIN_UNIT_WORDS`` says little by itself, so it is hashed together with the units
after it, across lines, until they have ``WINDOW_WORDS`` words or a unit above
the floor is among them: lists, tables and title case are compared wherever in a
text they begin.  Digests are grouped over all documents; the smallest doc_id
that holds one keeps it, every other document loses it, and so does a later
place in the same document (one that doesn't overlap the first).

A unit goes only as part of a run of such units (fewer than ``MIN_UNIT_WORDS``
words in between go along) that has ``min_words`` words, so chance repeats of
short sentences stay.  What is left of a repeat: short units after its last
sentence, up to two words in text of short units alone, none at a text's end.
The result names what was cut as code-point spans of the original text.

Scale: texts are cut and hashed once, into a table; the rest works on it.
Digests are combined before the shuffle (smallest holders per digest), so a line
in every document costs one row per task; the units whose digest is shared meet it
on the digest, where a hot one can be split (no aggregate sits on the raw rows), and
text is shuffled once.  A text is cut in one piece: the longest one bounds a task.

Defined results: null and empty texts come back empty with no spans; every row
is a document of its own: rows rank by doc_id, a null one first, and rows that
share an id or have none by their place in the table as read.  A document may end
up empty; no row is dropped.  Columns other than doc_id and text pass through if
named in ``keep``; ``spans``, ``n_units`` and ``n_removed`` are refused there.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import chain
from typing import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import lean, small_batches, whole_text, written
from vellum.llm.encode import slices

NO_ID = -(1 << 63)
MIN_UNIT_WORDS = 4
WINDOW_WORDS = 8  # of short units hashed together
CUT_BYTES = 2 << 20  # of text cut at a time
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"


def window_ends(sizes: list[int]) -> list[int | None]:
    """For each unit, the last one hashed with it (itself if above the floor); none where nothing is hashed.

    Where the text ends before a window is full, one digest covers the rest.
    """
    out: list[int | None] = []
    ended = False
    for i, size in enumerate(sizes):
        if size >= MIN_UNIT_WORDS:
            out.append(i)
        elif not size or ended:
            out.append(None)
        else:
            words, end = size, i
            while words < WINDOW_WORDS and end + 1 < len(sizes):
                end += 1
                words += sizes[end]
                if sizes[end] >= MIN_UNIT_WORDS:
                    break
            ended = words < WINDOW_WORDS and sizes[end] < MIN_UNIT_WORDS
            out.append(end)
    return out


class Units:
    """Cuts and hashes texts; one per task."""

    def __init__(self):
        import re

        import regex
        import xxhash

        self.cuts = regex.compile(r"\n+|(?<=[.!?…])\s+|(?<=[。！？])(?![。！？])|\s+(?=\p{Lu}(?:\p{Ll}|\s))").finditer
        self.words = regex.compile(rf"(?V1)[{UNSPACED}]\p{{M}}*|[[\p{{L}}\p{{N}}\p{{M}}]--[{UNSPACED}]]+").findall
        # the same rules where there is nothing but ASCII
        self.ascii_cuts = re.compile(r"\n+|(?<=[.!?])[\t-\r ]+|[\t-\r ]+(?=[A-Z][a-z\t-\r ])").finditer
        self.ascii_words = re.compile(r"[a-z0-9]+").findall
        self.digest = xxhash.xxh3_128_intdigest

    def of(self, text: str) -> tuple[list[int], list[int], list[tuple[int, int] | None]]:
        """Bounds of the units, their numbers of words, and the digests that begin at them."""
        cuts, words = (self.ascii_cuts, self.ascii_words) if text.isascii() else (self.cuts, self.words)
        bounds = [0, *(m.end() for m in cuts(text))]
        if bounds[-1] < len(text):
            bounds.append(len(text))
        found = [words(text[a:b].lower()) for a, b in zip(bounds, bounds[1:])]
        sizes = [len(ws) for ws in found]
        digests: list[tuple[int, int] | None] = []
        first_end: dict[int, int] = {}
        for i, end in enumerate(window_ends(sizes)):
            if end is None:
                digests.append(None)
                continue
            h = self.digest(" ".join(found[i] if end == i else chain.from_iterable(found[i:end + 1])).encode("utf-8"))
            if i > first_end.setdefault(h, end) or first_end[h] == end:
                digests.append(((h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)))
            else:  # overlaps its first place, which stays whole
                digests.append(None)
        return bounds, sizes, digests


def repeated_spans(bounds: list[int], sizes: list[int], gone: list[bool], min_words: int) -> list[tuple[int, int]]:
    """Spans of runs of units to cut, given whose digest is gone: they begin and end with a unit under a
    gone digest, and fewer than ``MIN_UNIT_WORDS`` words in a row between are not."""
    if not any(gone):
        return []
    out, first, last, words, between, reach = [], None, None, 0, 0, -1
    for i, (n, g, end) in enumerate(zip([*sizes, MIN_UNIT_WORDS], [*gone, False], [*window_ends(sizes), None])):
        if g:
            reach = max(reach, end)
        if i <= reach:
            first = i if first is None else first
            last, words, between = i, words + n, 0
        elif first is not None:
            between += n
            if between >= MIN_UNIT_WORDS:
                if words >= min_words:
                    out.append((bounds[first], bounds[last + 1]))
                first, words, between = None, 0, 0
    return out


RESULT = ("spans", "n_units", "n_removed")


def cut_units(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row cut and hashed once, written: row (its number), doc (doc_id, NO_ID for null), kept, text, bounds,
    sizes, h1 and h2 (digest that begins at each unit, null for none or one that stands earlier in the text), again (the units
    of the latter kind)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.struct("doc_id", *(F.col(c) for c in keep if c not in ("doc_id", "text"))).alias("kept"), whole_text().alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema += ", bounds array<int>, sizes array<int>, h1 array<long>, h2 array<long>, again array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        for batch in batches:
            for first, texts in slices(batch.column("text"), CUT_BYTES):
                found = [units.of(t) for t in texts.to_pylist()]
                again, first_places = [], []
                for _, _, digests in found:
                    place = {d: i for i, d in reversed(list(enumerate(digests)))}
                    again.append([i for i, d in enumerate(digests) if d is not None and place[d] < i])
                    first_places.append([d if d is None or place[d] == i else None for i, d in enumerate(digests)])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(texts)) for c in ("row", "doc", "kept")), texts,
                     pa.array([b for b, _, _ in found], ints), pa.array([z for _, z, _ in found], ints),
                     *(pa.array([[None if d is None else d[k] for d in ds] for ds in first_places], longs) for k in (0, 1)),
                     pa.array(again, ints)],
                    names=["row", "doc", "kept", "text", "bounds", "sizes", "h1", "h2", "again"])

    small_batches(docs.sparkSession)
    return written(rows.mapInArrow(lean(cut), schema), "units", compression="zstd")


def lost_units(units: DataFrame) -> DataFrame:
    """row, lost: the units of every row that begin a digest which an earlier row holds.

    Rows rank by doc_id (null first), rows with one id by their place in the table.
    """
    digests = (units.select("row", "doc", F.posexplode(F.arrays_zip("h1", "h2")).alias("unit", "h"))
               .where(F.col("h.h1").isNotNull()).select("row", "doc", "unit", "h.h1", "h.h2"))
    shared = (digests.groupBy("h1", "h2")
              .agg(F.min("doc").alias("keeper"), F.min("row").alias("a"), F.max("row").alias("z"))
              .where(F.col("a") < F.col("z")).select("h1", "h2", "keeper"))
    # a table, so that the join has plain exchanges on both sides and a hot digest can be split
    hits = digests.join(written(shared, "shared-digests"), ["h1", "h2"])
    gone = hits.where(F.col("doc") > F.col("keeper")).select("row", "unit")
    twins = units.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(F.col("doc").alias("twin"))
    if not twins.isEmpty():  # ids that several rows share, or none: the first of those rows keeps
        same = hits.where(F.col("doc") == F.col("keeper")).join(twins, F.col("doc") == F.col("twin"), "left_semi")
        first = same.groupBy("h1", "h2").agg(F.min("row").alias("first"))
        gone = gone.unionByName(same.join(first, ["h1", "h2"]).where(F.col("row") > F.col("first")).select("row", "unit"))
    return gone.groupBy("row").agg(F.collect_set("unit").alias("lost"))


def dedup_substrings(docs: DataFrame, min_words: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, text (what stays), spans (start, end of what went), n_units, n_removed."""
    if set(RESULT) & set(keep):
        raise ValueError(f"columns named {', '.join(RESULT)} can't be kept: the result has them")
    extra = tuple(c for c in keep if c not in ("doc_id", "text"))
    units = cut_units(docs, extra)
    lost = lost_units(units).withColumnRenamed("row", "lost_row")
    rows = units.join(lost, F.col("row") == F.col("lost_row"), "left").select("kept", "text", "bounds", "sizes", "again", "lost")
    kept_type = rows.schema["kept"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, n_removed = batch.column("text").to_pylist(), [], []
            for i, (again, lost) in enumerate(zip(batch.column("again").to_pylist(), batch.column("lost").to_pylist())):
                out: list[tuple[int, int]] = []
                if again or lost:
                    bounds, sizes = batch.column("bounds")[i].as_py(), batch.column("sizes")[i].as_py()
                    gone = [False] * len(sizes)
                    for u in chain(again, lost or ()):
                        gone[u] = True
                    out = repeated_spans(bounds, sizes, gone, min_words)
                if out:
                    starts, text = [*(s for s, _ in out), len(texts[i])], texts[i]
                    texts[i] = "".join(text[a:b] for a, b in zip([0, *(e for _, e in out)], starts))
                spans.append([{"start": a, "end": b} for a, b in out])
                n_removed.append(sum(bisect_left(bounds, e) - bisect_left(bounds, s) for s, e in out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(texts, pa.string()), pa.array(spans, span_type),
                 pc.list_value_length(batch.column("sizes")).cast(pa.int64()), pa.array(n_removed, pa.int64())],
                names=["kept", "text", "spans", "n_units", "n_removed"])

    found = rows.mapInArrow(lean(cut), f"kept {kept_type}, text string, spans array<struct<start:long,end:long>>, n_units long, n_removed long")
    return found.select(*(F.col("kept")[c].alias(c) for c in ("doc_id", *extra)), "text", *RESULT)
