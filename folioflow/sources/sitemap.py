"""Sitemaps, from a column of XML texts or straight from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.schemas import SITEMAP_ENTRIES

_OPTIONS = {"rowTag": "urlset", "ignoreNamespace": "true", "mode": "PERMISSIVE"}


def _clean(entries: DataFrame) -> DataFrame:
    return entries.withColumn("loc", F.regexp_replace("loc", r"(?U)^\s+|\s+$", "")).filter(F.col("loc") != "")


def sitemap_urls(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per non-blank ``loc`` with its position ``pos``; a text that is no XML gives no row."""
    keep = [c for c in df.columns if c != xml_col]
    parsed = df.select(*keep, F.from_xml(F.col(xml_col), SITEMAP_ENTRIES, _OPTIONS).alias("_map"))
    entries = parsed.select(*keep, F.posexplode("_map.url").alias("pos", "_entry"))
    return _clean(entries.select(*keep, "pos", "_entry.loc", "_entry.lastmod", "_entry.priority"))


def read_sitemap_files(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap files read in splits, for maps too big for one row."""
    raw = (
        spark.read.format("xml")
        .schema("loc string, lastmod string, priority double")
        .option("rowTag", "url")
        .option("ignoreNamespace", "true")
        .load(path)
    )
    return _clean(raw)
