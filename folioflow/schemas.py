"""Table schemas shared by all operators."""

from pyspark.sql import types as T

IMAGE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("alt", T.StringType()),
        T.StructField("caption", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("site", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

# Field names and their order are the fixed record layout of a content item.
ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("date_published", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("canonical_url", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("images", T.ArrayType(IMAGE)),
        T.StructField("publisher", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("_content_hash", T.StringType()),
        T.StructField("_scraped_at", T.TimestampType()),
        T.StructField("_missing_fields", T.ArrayType(T.StringType())),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

SEEN = T.StructType(
    [
        T.StructField("brand", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("seen_at", T.TimestampType()),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("from_url", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("listing_category", T.StringType()),
        T.StructField("pos", T.IntegerType()),
    ]
)

SITEMAP_ENTRIES = "url array<struct<loc: string, lastmod: string, priority: double>>"

ENTRY_POINTS = "site string, ord int, url string, category string"
URL_RULES = "site string, kind string, pattern string"
FIELD_MAP = "site string, field string, json_path string"
SELECTORS = "site string, field string, selector string, mode string"
