"""Semi-structured access: JSON text and VARIANT paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path_text(json_text: Column | str, path: str) -> Column:
    """``payload:key::STRING`` on JSON text: parse to VARIANT, read the path as string.

    Missing key, wrong type or malformed JSON -> NULL.
    """
    c = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.try_variant_get(F.try_parse_json(c), path, "string")
