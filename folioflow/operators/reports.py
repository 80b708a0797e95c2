"""Reports and checks over content items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import broadcast_if_small

# Names of the content-library schema and of the content model.
LIBRARY_NAMES = {
    "title": "library_title",
    "body": "library_body_html",
    "date_published": "library_published",
}
MODEL_NAMES = {
    "description": "summary",
    "date_published": "publish_date",
    "source_url": "url",
}

# Expected number of pages per brand.
EXPECTED_PAGES = {"itl": 300, "iii": 1000, "iasa": 250, "iaum": 250}

# Words allowed in categories and tags.
CATEGORY_WORDS = ("insurance", "risk", "finance", "technology")
TAG_WORDS = (
    "insurance",
    "risk",
    "finance",
    "compliance",
    "policy",
    "claim",
    "technology",
    "insuretech",
    "personal",
    "commercial",
)

SAMPLE_SIZE = 5


def to_library(items: DataFrame, mapping: Mapping[str, str] = LIBRARY_NAMES) -> DataFrame:
    """Items under the field names of another schema."""
    return items.withColumnsRenamed(dict(mapping))


def volume_check(items: DataFrame, expected: Mapping[str, int] = EXPECTED_PAGES, brand: str = "brand") -> DataFrame:
    """Items per brand next to the expected number; brands on either side are kept."""
    plan = items.sparkSession.createDataFrame(list(expected.items()), "brand string, expected bigint")
    found = items.groupBy(F.col(brand).alias("brand")).agg(F.count(F.lit(1)).alias("found"))
    both = found.join(plan, "brand", "full")
    got = F.coalesce("found", F.lit(0))
    return both.select(
        "brand", got.alias("found"), "expected", F.round(got / F.col("expected"), 4).alias("ratio")
    )


def sample_pages(
    items: DataFrame, n: int = SAMPLE_SIZE, seed: str = "0", brand: str = "brand", key: str = "source_url"
) -> DataFrame:
    """``n`` items per brand in the order of a seeded hash: random, but the same every time.

    The rank filter lets Spark keep n rows per brand in every task before the
    shuffle, so a brand with most of the items costs no more than a small one. Only
    the brand and the key are ranked; items are then fetched by key.
    """
    rank = Window.partitionBy(brand).orderBy("_h", key)
    keys = items.select(brand, key).distinct()
    picked = (
        keys.withColumn("_h", F.sha2(F.concat(F.col(key), F.lit(seed)), 256))
        .withColumn("sample_no", F.row_number().over(rank))
        .filter(F.col("sample_no") <= n)
        .drop("_h")
    )
    return items.join(picked, [brand, key])


def missing_profile(items: DataFrame, fields: Sequence[str] = ("title", "body", "source_url"), brand: str = "brand") -> DataFrame:
    """How often each required field is missing, per brand."""
    counts = [
        F.count_if(F.array_contains("_missing_fields", f)).alias(f"missing_{f}") for f in fields
    ]
    complete = F.count_if(F.col("_missing_fields").isNull()).alias("complete")
    return items.groupBy(brand).agg(F.count(F.lit(1)).alias("items"), complete, *counts)


def shared_content(
    items: DataFrame, brand: str = "brand", url: str = "source_url", hash_col: str = "_content_hash"
) -> DataFrame:
    """Bodies that occur under several URLs of a brand: one row per body, counts only.

    URLs are made distinct first, then counted, so a body shared by most URLs is
    combined map-side and never gathered in one place.
    """
    copies = (
        items.filter(F.col(hash_col) != "")
        .groupBy(F.col(brand).alias("brand"), F.col(hash_col).alias("content_hash"), F.col(url).alias("url"))
        .agg(F.count(F.lit(1)).alias("_items"))
    )
    return (
        copies.groupBy("brand", "content_hash")
        .agg(
            F.count(F.lit(1)).alias("n_urls"),
            F.sum("_items").alias("n_items"),
            F.min("url").alias("first_url"),
            F.max("url").alias("last_url"),
        )
        .filter(F.col("n_urls") > 1)
    )


def shared_content_members(items: DataFrame, **names: str) -> DataFrame:
    """The URLs behind ``shared_content``, one row each."""
    brand, url = names.get("brand", "brand"), names.get("url", "source_url")
    hash_col = names.get("hash_col", "_content_hash")
    shared = shared_content(items, **names).select("brand", "content_hash", "n_urls")
    members = items.select(
        F.col(brand).alias("brand"), F.col(hash_col).alias("content_hash"), F.col(url).alias("url")
    ).distinct()
    return members.join(shared, ["brand", "content_hash"])


def classify_terms(
    items: DataFrame, words: Sequence[str] = CATEGORY_WORDS, terms: str = "categories"
) -> DataFrame:
    """Split a term list into words of the vocabulary and others (row-local, no join)."""
    known = F.array(*[F.lit(w) for w in words])
    lowered = F.array_distinct(F.transform(terms, lambda t: F.lower(F.trim(t))))
    return items.withColumn("known_terms", F.array_sort(F.array_intersect(lowered, known))).withColumn(
        "other_terms", F.array_sort(F.array_except(lowered, known))
    )


def vocabulary_report(items: DataFrame, vocabulary: DataFrame, terms: str = "categories") -> DataFrame:
    """Use of each term, marked as in or out of a vocabulary table (column ``term``)."""
    used = items.select(F.explode(F.transform(terms, lambda t: F.lower(F.trim(t)))).alias("term"))
    counted = used.groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
    known = vocabulary.select("term").distinct().withColumn("_known", F.lit(True))
    return counted.join(broadcast_if_small(known), "term", "left").select(
        "term", "uses", F.coalesce("_known", F.lit(False)).alias("in_vocabulary")
    )
