"""Geo points.  Spark's ST_* functions are disabled by default, so a point is
a plain struct<lon double, lat double>, printed as WKT where text is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def st_point(lon: Column, lat: Column) -> Column:
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat")))


def point_wkt(point: Column | str) -> Column:
    p = F.col(point) if isinstance(point, str) else point
    return F.concat(F.lit("POINT("), p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string"), F.lit(")"))
