import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators import extract
from vellum.operators.extract import RETRY, decode, decode_files, payload


def parse(spark, content, kind="string"):
    files = spark.createDataFrame([("a.pdf", content)], f"relative_path string, content {kind}")
    return decode_files(files, "content").select(payload(F.col("decoded")).alias("p")).collect()[0].p


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_html_payload(spark, kind):
    html = "<!DOCTYPE html><html><head><title>Hi &amp; bye</title></head><body><p>a</p></body></html>"
    p = parse(spark, html if kind == "string" else html.encode(), kind)
    assert json.loads(p.metadata) == {"title": "Hi &amp; bye"}
    assert p.page_count == 1 and p.parse_error is None
    assert p.text == "    Hi &amp; bye    a   "
    assert p.chars == len(p.text)


def test_html_is_found_behind_a_long_comment_and_titles_in_any_spelling(spark):
    p = parse(spark, "<!--" + "x" * 5000 + "--><HTML><TITLE lang=en>T</TITLE><p>a</p></HTML>")
    assert json.loads(p.metadata) == {"title": "T"} and "<" not in p.text


def test_html_without_title_has_empty_metadata(spark):
    assert parse(spark, b"<html><body>x</body></html>", "binary").metadata == "{}"


def test_failing_page_contributes_empty_part_and_null_metadata_stays(spark):
    row = spark.createDataFrame([(("pdf", {"a": None}, ["page one", None], None),)], T.StructType([T.StructField("decoded", extract.DECODED)]))
    p = row.select(payload(F.col("decoded")).alias("p")).collect()[0].p
    assert p.text == "page one\n" and p.page_count == 2 and p.chars == 9
    assert json.loads(p.metadata) == {"a": None}


def test_undecodable_and_missing_files_are_reported_not_raised(spark):
    p = parse(spark, b"\n%PDF-1.7 garbage that no decoder can open", "binary")
    assert p.parse_error is not None and p.text is None and not p.parse_error.startswith(RETRY)
    assert parse(spark, None).parse_error.startswith(RETRY)
    assert decode(None)[3] == "no such file"


def test_plain_text_is_one_page(spark):
    p = parse(spark, b"just words \xff", "binary")
    assert p.text == "just words \ufffd" and p.page_count == 1


def test_only_pdf_bytes_meet_python(spark):
    files = spark.createDataFrame([("a.pdf", "<html></html>")], "relative_path string, content string")
    text_only = decode_files(files, "content").where("decoded.kind = 'text'")
    plan = text_only._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 1 and "BatchEvalPython" not in plan
