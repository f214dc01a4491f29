"""Record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

VENUE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("capacity", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("reviews", T.LongType()),
        T.StructField("description", T.StringType()),
    ]
)
VENUE_KEYS = tuple(VENUE.fieldNames())

PRODUCT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("photo", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("units_sold", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("location", T.StringType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("depth", T.IntegerType()),
    ]
)
