"""Path and id expressions; all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source semantics: the document suffix matched
# case-insensitively, and the delimiters of path and id parts.
PDF_LIKE = "%.pdf"
PDF_SUFFIX_RE = r"(?i)\.pdf$"
PATH_DELIM = "/"
ID_DELIM = "_"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: Column | str) -> Column:
    """Last path part; a path without '/' is returned whole."""
    return F.split_part(_c(path), F.lit(PATH_DELIM), F.lit(-1))


def is_pdf(path: Column | str) -> Column:
    """Case-insensitive '%.pdf' match; NULL path -> NULL (filtered out)."""
    return _c(path).ilike(PDF_LIKE)


def pdf_id(path: Column | str) -> Column:
    """File name without a trailing .pdf (any case): 'E-TV002_Manual-1.pdf' -> 'E-TV002_Manual-1'."""
    return F.regexp_replace(file_name(path), PDF_SUFFIX_RE, "")


def product_id(doc_id: Column | str) -> Column:
    """Product key of a document id: the part before the first '_'."""
    return F.split_part(_c(doc_id), F.lit(ID_DELIM), F.lit(1))
