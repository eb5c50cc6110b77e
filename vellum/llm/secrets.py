"""Secret scans: keyword automaton, anchored patterns near its hits, embedded checksums.

An Aho-Corasick automaton over the lower-cased bytes finds the keywords that
every match must begin with.  Hexadecimal runs have no keyword; their
automaton runs over an image of the text in which every such digit is one mark,
and its word is as many marks as the shortest run.  The whole slice of a batch is
scanned at once; only at a hit is the kind's pattern tried, anchored there, on
the document's bytes.  All patterns are ASCII, so bytes match where characters
do; spans are counted in code points.

Base kinds (leftmost, non-overlapping; matches that are too short are dropped
after they have matched):
  assign  a credential's name, = or :, and its value of 6+ characters
  access  AKIA and upper-case letters or digits, 20+ characters
  hex     a run of lower-case hexadecimal digits, 24+ characters
Added kinds carry a checksum that must be right:
  github  gh[pousr]_ and 36 characters: the last six are the CRC-32 of the thirty before, in base 62
  npm     npm_ and 36 characters, with the same checksum
  age     AGE-SECRET-KEY-1 and 58 characters of a Bech32 string whose checksum holds

Scale: a map over rows, no shuffle; slices of a few MB bound a task's memory.

Defined results: null and empty texts have no secrets; repeated rows are scanned
one by one; a text of any length is scanned whole; rows of an empty table are
none.  Only the text is read; columns named in ``keep`` pass through, and the
result's ``secrets`` column would clash only with one of that name in ``keep``,
which is refused.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import whole_text
from vellum.llm.encode import slices

# Fixed values of the contract: kinds in the order of equal starts, patterns, least lengths.
BASE = ("assign", "access", "hex")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
TOKEN_LENGTH, AGE_LENGTH = 40, 74
# Fixed values of public token formats.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
KINDS = (*BASE, "github", "npm", "age")

KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "age": ("age-secret-key-1",),
}
PATTERNS = {
    "assign": rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": rb"AKIA[A-Z0-9]+",
    "hex": rb"[0-9a-f]+",
    "github": rb"gh[pousr]_[A-Za-z0-9]+",
    "npm": rb"npm_[A-Za-z0-9]+",
    "age": rb"AGE-SECRET-KEY-1[A-Z0-9]+",
}


def base62_crc(body: bytes) -> str:
    """CRC-32 as six digits of base 62."""
    n, out = zlib.crc32(body), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def bech32_holds(human: str, data: str) -> bool:
    """Whether the data part of a Bech32 string (lower case) ends with the right checksum."""
    if any(c not in BECH32 for c in data):
        return False
    check = 1
    values = [ord(c) >> 5 for c in human] + [0] + [ord(c) & 31 for c in human] + [BECH32.index(c) for c in data]
    for v in values:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(BECH32_GENERATOR):
            if top >> i & 1:
                check ^= g
    return check == 1


def valid(kind: str, m) -> bool:
    """The tests that a match must pass."""
    token = m.group()
    if kind == "assign":
        return len(m.group(1)) >= ASSIGN_VALUE
    if kind == "access":
        return len(token) >= ACCESS_LENGTH
    if kind == "hex":
        return len(token) >= HEX_LENGTH
    if kind == "age":
        return len(token) == AGE_LENGTH and bech32_holds("age-secret-key-", token.decode("ascii").lower()[16:])
    return len(token) == TOKEN_LENGTH and base62_crc(token[4:34]).encode("ascii") == token[34:]


class Scanner:
    """Both automata and the patterns; one per task."""

    def __init__(self):
        import re

        import ahocorasick

        self.words, self.marks = ahocorasick.Automaton(), ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for w in words:
                self.words.add_word(w, (kind, len(w)))
        self.marks.add_word("x" * HEX_LENGTH, ("hex", HEX_LENGTH))
        self.words.make_automaton()
        self.marks.make_automaton()
        self.image = bytes(ord("x") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))
        self.patterns = {kind: re.compile(p) for kind, p in PATTERNS.items()}

    def scan(self, texts: pa.Array) -> list[list[tuple[str, int, int]]]:
        """Per text, (kind, start, end) in code points, by start and then kind."""
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        blob = b"".join(t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts)
        out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(lengths))]
        hits: dict[str, list[int]] = {kind: [] for kind in PATTERNS}
        for automaton, image in ((self.words, blob.lower()), (self.marks, blob.translate(self.image))):
            for last, (kind, size) in automaton.iter(image.decode("latin-1")):
                hits[kind].append(last + 1 - size)
        for kind in KINDS:
            match, over = self.patterns[kind].match, 0
            starts = np.sort(np.array(hits[kind], np.int64))
            for at, doc in zip(starts.tolist(), np.searchsorted(ends, starts, side="right").tolist()):
                if at < over:
                    continue  # inside the match before
                m = match(blob, at, int(ends[doc]))
                if m is None:
                    continue
                over = m.end()
                if valid(kind, m):
                    out[doc].append((kind, at, over))
        for doc, found in enumerate(out):
            if found:
                begin = int(ends[doc] - lengths[doc])
                text = blob[begin:int(ends[doc])]
                if text.isascii():
                    place = None
                else:  # code points before each byte
                    place = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                moved = [(k, a - begin, b - begin) if place is None else (k, int(place[a - begin]), int(place[b - begin]))
                         for k, a, b in found]
                out[doc] = sorted(moved, key=lambda s: (s[1], KINDS.index(s[0])))
        return out


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``secrets``: kind, start and end (exclusive) in code points, in order."""
    if "secrets" in keep:
        raise ValueError("a column named secrets can't be kept: the result has one")
    rows = docs.select(whole_text().alias("text"), F.struct(*keep).alias("kept"))
    kept_type = rows.schema["kept"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in scanner.scan(texts)]
                yield pa.RecordBatch.from_arrays([batch.column("kept").slice(first, len(texts)), pa.array(found, span_type)],
                                                 names=["kept", "secrets"])

    return rows.mapInArrow(scanned, f"kept {kept_type}, secrets {SPANS}").select("kept.*", "secrets")


def written_out(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of what was found."""
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
                        F.sha2(written_out(base), 256).alias("base_sha256"), written_out(F.col("secrets")).alias("spans"))


def redact(text: Column, spans: Column, mask: str = "*") -> Column:
    """The text with every character of its spans masked."""
    hidden = F.aggregate(spans, F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")), lambda acc, s: F.struct(
        F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                 F.repeat(F.lit(mask), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)).cast("int"))).alias("done"),
        F.greatest(acc["at"], s["end"]).alias("at")))
    return F.concat(hidden["done"], F.substring(text, hidden["at"] + 1, F.length(text)))
