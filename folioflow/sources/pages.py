"""Stored pages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.rules import Rules
from folioflow.session import join_path

_RULE_HOST = re.compile(r"\^?https?\??:(?://|\\/\\/)((?:[A-Za-z0-9-]|\\?\.)+?)(?=\\?[/:$]|$)")


def read_pages(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Pages table (page_id, url, html and whatever else is stored), pruned to ``columns``."""
    pages = spark.read.format(fmt).load(path)
    return pages.select(*columns) if columns else pages


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(root, f"{name}.parquet"))


def with_site(pages: DataFrame, rules: Rules, url: str = "url") -> DataFrame:
    """Add ``site`` from the host of the page URL; pages of unknown hosts get null.

    A site's hosts are those of its entry points, its sitemap and its include rules.
    """
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    site = None
    for name, r in rules.items():
        starts = [u for u, _ in r.entry_points] + ([r.sitemap_url] if r.sitemap_url else [])
        hosts = {u.split("/")[2].lower() for u in starts}
        # An include rule names a host when it begins with a scheme and a literal one.
        named = (_RULE_HOST.match(p) for p in r.include)
        hosts = sorted(hosts | {m.group(1).replace("\\", "").lower() for m in named if m})
        if hosts:
            hit = host.isin(hosts)
            site = F.when(hit, F.lit(name)) if site is None else site.when(hit, F.lit(name))
    return pages.withColumn("site", F.lit(None).cast("string") if site is None else site)
