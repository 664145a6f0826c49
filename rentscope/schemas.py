"""Explicit schemas: nothing is ever inferred."""

from pyspark.sql import types as T

RAW_LISTINGS = T.StructType([
    T.StructField("listing_seq", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("price", T.LongType(), True),
    T.StructField("price_raw", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("link", T.StringType(), True),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
    T.StructField("source", T.StringType(), True),
])

CLEAN_EXTRA = [
    T.StructField("bedrooms", T.IntegerType(), True),
    T.StructField("bathrooms", T.IntegerType(), True),
    T.StructField("clean_location", T.StringType(), False),
    T.StructField("price_category", T.StringType(), False),
    T.StructField("price_per_bedroom", T.DoubleType(), True),
]
CLEAN_LISTINGS = T.StructType(RAW_LISTINGS.fields + CLEAN_EXTRA)

PAGES = T.StructType([
    T.StructField("page_id", T.LongType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
])

PAGE_RECORDS = T.StructType([
    T.StructField("page_id", T.LongType(), True),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("price", T.LongType(), True),
    T.StructField("price_raw", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("link", T.StringType(), True),
])

# Columns the quality gate requires on clean data.
REQUIRED_CLEAN_COLUMNS = ["title", "price", "location", "link", "bedrooms",
                          "bathrooms", "clean_location", "price_category", "source"]
