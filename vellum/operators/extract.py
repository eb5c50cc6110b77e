"""Distributed document text extraction.

A file becomes a payload {metadata, page_count, chars, text}.  A decoder gives
what it alone can know: the kind of file, its raw metadata (a map) and its
pages (an array, null where a page failed).  The rest is built-in expressions:
keys and values as strings, pages joined by newlines with failed ones empty,
lengths, and for HTML the title and the text with every tag replaced by a space.

Bytes or text that are already a column need a Python decoder for PDF only;
HTML and plain text stay in the JVM.  Without a content column each task opens
the files itself, one at a time, and yields batches bounded by their bytes.

A file that is absent or can't be decoded carries ``parse_error`` for good.  A
file that is there but couldn't be opened, or has no content yet, gets an error
that starts with RETRY: it stays on the work list.
"""

from __future__ import annotations

import io
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.numbers import try_to_number
from vellum.functions.paths import pdf_id
from vellum.operators.admission import dealt_by_size
from vellum.sources.stage import _open_bytes

# Tag and title patterns of the HTML decoder, the PDF header and
# the bytes within which the format allows it, the page separator.
TAG = r"<[^>]+>"
TITLE = r"(?is)<title(?:\s[^>]*)?>([^<]*)</title>"
PDF_MAGIC = b"%PDF-"
PDF_HEADER_WITHIN = 1024
PAGE_JOIN = "\n"

RETRY = "retry: "
DECODED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("pages", T.ArrayType(T.StringType())), T.StructField("parse_error", T.StringType())])
OUTPUT_BYTES = 32 << 20
FILES_BYTES_PER_TASK = 64 << 20


def decode_pdf(raw: bytes) -> tuple[dict, list[str | None]]:
    """Metadata and pages by whichever PDF library is installed; ValueError if it can't be opened."""
    try:
        from pypdf import PdfReader  # type: ignore
    except ImportError:
        try:
            from PyPDF2 import PdfReader  # type: ignore
        except ImportError as e:
            raise ValueError("no PDF decoder installed") from e
    try:
        reader = PdfReader(io.BytesIO(raw))
        count = len(reader.pages)
    except Exception as e:
        raise ValueError(f"cannot open PDF: {type(e).__name__}") from e

    def attempt(read, otherwise):
        try:
            return read()
        except Exception:
            return otherwise

    found = attempt(lambda: {k: None if v is None else f"{v}" for k, v in (reader.metadata or {}).items()}, {})
    return found, [attempt(reader.pages[i].extract_text, None) for i in range(count)]


def is_pdf_content(raw: bytes) -> bool:
    return PDF_MAGIC in raw[:PDF_HEADER_WITHIN + len(PDF_MAGIC) - 1]


def decode(raw: bytes | None) -> tuple:
    """(kind, metadata, pages, parse_error) of one file's bytes."""
    if raw is None:
        return None, None, None, "no such file"
    if is_pdf_content(raw):
        try:
            return ("pdf", *decode_pdf(raw), None)
        except ValueError as e:
            return None, None, None, str(e)
    return "text", {}, [raw.decode("utf-8", errors="replace")], None


def _decode_content(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([decode(None if c is None else bytes(c)) for c in content],
                        columns=["kind", "metadata", "pages", "parse_error"])


decoded_content = F.pandas_udf(_decode_content, DECODED).asNondeterministic()


def _decoded_at(files: DataFrame, url_col: str) -> DataFrame:
    """``files`` with a ``decoded`` column, each file opened in its task."""
    inner = DECODED
    schema = T.StructType([*files.schema.fields, *inner.fields])

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows, held, first = [], 0, 0
            for i, url in enumerate(frame[url_col]):
                try:
                    found = decode(_open_bytes(url))
                except OSError as e:
                    found = None, None, None, f"{RETRY}cannot open file: {type(e).__name__}"
                rows.append(found)
                held += sum(len(p) for p in found[2] or () if p)
                if held >= OUTPUT_BYTES or i + 1 == len(frame):
                    part = frame.iloc[first:i + 1].reset_index(drop=True)
                    yield pd.concat([part, pd.DataFrame(rows, columns=inner.names)], axis=1)
                    rows, held, first = [], 0, i + 1

    out = files.mapInPandas(opened, schema)
    return out.select(*files.columns, F.struct(*inner.names).alias("decoded"))


def text_as_decoded(text: Column) -> Column:
    """What ``decode`` gives for a text that isn't a PDF, as an expression."""
    return F.struct(F.lit("text").alias("kind"), F.create_map().cast("map<string,string>").alias("metadata"),
                    F.array(text).alias("pages"), F.lit(None).cast("string").alias("parse_error"))


def payload(decoded: Column) -> Column:
    """{metadata, page_count, chars, text, parse_error} of a decoded file."""
    joined = F.array_join(F.transform(decoded["pages"], lambda p: F.coalesce(p, F.lit(""))), PAGE_JOIN)
    is_html = (decoded["kind"] == "text") & F.lower(joined).rlike(r"<html|<!doctype html")
    title = F.regexp_extract(joined, TITLE, 1)
    has_title = is_html & joined.rlike(TITLE)
    text = F.when(is_html, F.regexp_replace(joined, TAG, " ")).otherwise(joined)
    metadata = F.when(has_title, F.create_map(F.lit("title"), title)).otherwise(decoded["metadata"])
    good = decoded["parse_error"].isNull()
    return F.struct(
        # null values stay in the object: the contract tells a null value from a missing key
        F.when(good, F.to_json(metadata, {"ignoreNullFields": "false"})).alias("metadata"),
        F.when(good, F.size(decoded["pages"]).cast("long")).alias("page_count"),
        F.when(good, F.length(text).cast("long")).alias("chars"),
        F.when(good, text).alias("text"),
        decoded["parse_error"].alias("parse_error"))


def _decoded_column(types: dict[str, str], content_col: str) -> Column:
    """``decoded`` of a content column, read once; Python gets the bytes of PDFs and nothing of the rest."""
    content = F.col(content_col)
    head = F.substring(content, 1, PDF_HEADER_WITHIN + len(PDF_MAGIC) - 1)
    if types[content_col] == "binary":
        head, text = F.decode(head, "ISO-8859-1"), F.make_valid_utf8(content.cast("string"))
    else:
        text = content
    is_pdf = F.coalesce(F.instr(head, PDF_MAGIC.decode()) > 0, F.lit(False))
    missing = F.struct(F.lit(None).cast("string").alias("kind"), F.lit(None).cast("map<string,string>").alias("metadata"),
                       F.lit(None).cast("array<string>").alias("pages"), F.lit(f"{RETRY}no content").alias("parse_error"))
    pdf = decoded_content(F.when(is_pdf, content.cast("binary")))
    return F.when(content.isNull(), missing).when(is_pdf, pdf).otherwise(text_as_decoded(text)).alias("decoded")


def decode_files(files: DataFrame, content_col: str) -> DataFrame:
    """``files`` with ``decoded`` in place of their content column."""
    return files.select(*(c for c in files.columns if c != content_col), _decoded_column(dict(files.dtypes), content_col))


def extraction(types: list[tuple[str, str]], content_col: str = "content", url_col: str = "scoped_url") -> Callable[[DataFrame], DataFrame]:
    """``extract_documents`` for files whose columns have these names and types.

    Its expressions are built once, which takes longer than planning them: what extracts many frames of one kind
    keeps the function.
    """
    rest = [F.col(c) for c, _ in types if c != content_col]
    decoded = _decoded_column(dict(types), content_col) if content_col in dict(types) else None
    parsed = payload(F.col("decoded"))
    out = (pdf_id("relative_path").alias("pdf_id"),
           *map(F.col, ("file_name", "relative_path", "file_url", "last_modified")),
           F.try_parse_json("payload.metadata").alias("pdf_metadata"),
           try_to_number("payload.page_count").alias("page_count"),
           F.col("payload.text").alias("extracted_text"),
           F.col("payload.parse_error").alias("parse_error"))

    def extract(files: DataFrame) -> DataFrame:
        if decoded is None:
            opened = _decoded_at(dealt_by_size(files, FILES_BYTES_PER_TASK), url_col)
        else:
            opened = files.select(*rest, decoded)
        return opened.withColumn("payload", parsed).select(*out)

    return extract


def extract_documents(files: DataFrame, content_col: str = "content", url_col: str = "scoped_url") -> DataFrame:
    """Parse every file; returns PROCESSED columns plus ``parse_error``.

    ``files`` carries RAW columns (file_name, relative_path, file_url, size,
    last_modified).  With a ``content_col`` column the bytes (or text) come
    from it; without one, each task opens the files at ``url_col`` itself,
    about FILES_BYTES_PER_TASK of them (see ``dealt_by_size``).
    """
    return extraction(files.dtypes, content_col, url_col)(files)
