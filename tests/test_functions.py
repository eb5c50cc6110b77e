from decimal import Decimal

from pyspark.sql import functions as F

from vellum.functions import file_name, is_pdf, json_path_text, pdf_id, point_wkt, product_id, st_point, try_to_number


def test_path_parts(spark):
    df = spark.createDataFrame([("a/b/c.PDF",), ("noslash.pdf",), ("x.txt",), (None,)], "p string")
    got = df.select(file_name("p").alias("f"), is_pdf("p").alias("pdf")).collect()
    assert [(r.f, r.pdf) for r in got] == [("c.PDF", True), ("noslash.pdf", True), ("x.txt", False), (None, None)]


def test_ids(spark):
    df = spark.createDataFrame([("E-TV002_Manual-1.pdf",), ("E-TV002_Manual-2.PDF",), ("nounderscore.pdf",)], "p string")
    got = df.select(pdf_id("p").alias("i"), product_id(pdf_id("p")).alias("prod")).collect()
    assert [(r.i, r.prod) for r in got] == [
        ("E-TV002_Manual-1", "E-TV002"), ("E-TV002_Manual-2", "E-TV002"), ("nounderscore", "nounderscore")]


def test_try_to_number(spark):
    df = spark.createDataFrame([("3",), ("3.6",), ("abc",), (None,)], "s string")
    got = [r.n for r in df.select(try_to_number("s").alias("n")).collect()]
    assert got == [Decimal(3), Decimal(4), None, None]


def test_json_path_text(spark):
    df = spark.createDataFrame([('{"k": 69}',), ('{"j": 1}',), ("not json",), (None,)], "s string")
    assert [r.v for r in df.select(json_path_text("s", "$.k").alias("v")).collect()] == ["69", None, None, None]


def test_point(spark):
    df = spark.createDataFrame([(-120.0, 0.5), (None, 1.0)], "lon double, lat double")
    got = [r.w for r in df.select(point_wkt(st_point(F.col("lon"), F.col("lat"))).alias("w")).collect()]
    assert got == ["POINT(-120.0 0.5)", None]
