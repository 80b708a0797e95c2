"""From stored pages to content items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.normalize import item_hash, non_empty, non_empty_array, normalize_date, strip
from folioflow.operators.extraction import (
    article_fields,
    breadcrumb_categories,
    dom_select,
    extract_jsonld,
    merge_fields,
)
from folioflow.operators.quality import missing_fields
from folioflow.rules import Rules, by_site, category_from_prefix

CONTENT_TYPE = "article"


def extract_pages(pages: DataFrame, rules: Rules) -> DataFrame:
    """``pages`` (site, url, html, ...) with ``dom``, ``jsonld`` and ``merged``; ``html`` is dropped."""
    parsed = extract_jsonld(dom_select(pages, article_fields(rules)), rules).drop("html")
    return merge_fields(parsed)


def _listing_list(listing: Column) -> Column:
    return F.when(F.coalesce(listing, F.lit("")) != "", F.array(listing))


def resolve_categories(
    rules: Rules,
    *,
    category: Column,
    categories: Column,
    tags: Column,
    listing: Column,
    prefix: Column,
    site: str = "site",
) -> tuple[Column, Column]:
    """(category, categories) after the category rule of each site."""
    categories = non_empty_array(categories)
    merged = F.coalesce(non_empty(category), listing)
    tags = F.filter(F.transform(tags, strip), lambda t: t != "")
    topics = F.coalesce(categories, F.array().cast("array<string>"))
    new_tags = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: ~F.array_contains(topics, t))
    both = non_empty_array(F.concat(topics, new_tags))
    first = F.get(categories, F.lit(0))

    # rule -> (category, categories)
    outcome = {
        "merged_or_listing": (merged, categories),
        "list_or_listing": (merged, F.coalesce(categories, _listing_list(listing))),
        "first": (first, categories),
        "first_or_listing": (F.coalesce(first, listing), F.coalesce(categories, _listing_list(listing))),
        "topics_and_tags": (F.coalesce(F.get(both, F.lit(0)), listing), both),
        "listing": (listing, _listing_list(listing)),
        "prefix": (prefix, F.lit(None).cast("array<string>")),
    }
    return tuple(by_site(site, rules, lambda r, i=i: outcome[r.category_rule][i]) for i in (0, 1))


def assemble_items(
    extracted: DataFrame, rules: Rules, scraped_at: Column | str = "fetched_at", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Content items from extracted pages (``merged``, ``dom``, ``url``, ``site``).

    ``listing_category`` is used where the frame has it, columns in ``keep`` are
    carried along. Absent values are null.
    """
    cols = extracted.columns
    dom = extracted.schema["dom"].dataType.names if "dom" in cols else []
    none = F.lit(None).cast("string")
    listing = non_empty("listing_category") if "listing_category" in cols else none
    category, categories = resolve_categories(
        rules,
        category=F.col("merged.category"),
        categories=F.col("merged.categories"),
        tags=F.col("dom.tags") if "tags" in dom else F.lit(None).cast("array<string>"),
        listing=listing,
        prefix=non_empty(category_from_prefix("site", "url", rules)),
    )
    constant = by_site("site", rules, lambda r: F.lit(r.publisher) if r.publisher else None).cast("string")
    images = F.col("dom.images") if "images" in dom else F.lit(None).cast(schemas.ITEM["images"].dataType)

    def text(name: str) -> Column:
        return non_empty(strip(F.col(f"merged.{name}")))

    item = {
        "title": text("title"),
        "author": text("author"),
        "date_published": normalize_date("merged.date_published"),
        "description": text("description"),
        "body": non_empty("merged.body"),
        "canonical_url": F.coalesce(non_empty("merged.canonical_url"), F.col("url")),
        "brand": by_site("site", rules, lambda r: F.lit(r.brand)),
        "content_type": F.lit(CONTENT_TYPE),
        "category": non_empty(strip(category)),
        "categories": non_empty_array(categories),
        "images": non_empty_array(images),
        "publisher": F.coalesce(constant, text("publisher")),
        "source_url": F.col("url"),
        "_content_hash": none,
        "_scraped_at": F.col(scraped_at) if isinstance(scraped_at, str) else scraped_at,
        "_missing_fields": F.lit(None).cast("array<string>"),
        "metadata": F.lit(None).cast(schemas.ITEM["metadata"].dataType),
    }
    items = extracted.select(*[item[f.name].alias(f.name) for f in schemas.ITEM.fields], *keep)
    return items.withColumn("_content_hash", item_hash("body")).withColumn("_missing_fields", missing_fields())


def image_table(items: DataFrame) -> DataFrame:
    """One row per image of each item."""
    return items.select("brand", "source_url", F.posexplode("images").alias("pos", "image")).select(
        "brand", "source_url", "pos", "image.*"
    )


__all__ = [
    "assemble_items",
    "breadcrumb_categories",
    "extract_pages",
    "image_table",
    "resolve_categories",
]
