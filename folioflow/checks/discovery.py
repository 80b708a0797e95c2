"""Discovery operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.checks.registry import check, joined, table, text
from folioflow.operators.discovery import (
    changed_since,
    dedup_links,
    discovery_report,
    expand_pages,
    explode_links,
    extract_links,
    filter_urls,
    filter_urls_by_table,
    first_seen,
    follow_next,
    prefer_links,
    reachable,
    scan_listings,
    seed_by_table,
    two_hop,
)
from folioflow.operators.rule_index import filter_urls_by_index, index_rules, prefix_category_by_table
from folioflow.rules import SiteRules
from folioflow.session import spread_small
from folioflow.sources.sitemap import sitemap_urls

# Test rules: the top-level domain of a page plays the site.
_NAV = "nav ul > li a[href]"
_DOMAINS = {
    "com": SiteRules("com", link_selector=_NAV, include=("/en/", "/fr/"), exclude=(r"\?.*utm_", "/category/")),
    "net": SiteRules("net", link_selector=_NAV, exclude=("#top$",), dedup_scope="page"),
    "org": SiteRules("org", link_selector=_NAV, include=("^https://",), dedup_scope="none"),
}
_SITE = r"regexp_extract(url, 'example\.([a-z]+)', 1)"
_LANG = r"regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1)"


def _domain_pages(spark: SparkSession, d: str) -> DataFrame:
    site = F.regexp_extract("url", r"example\.([a-z]+)", 1)
    lang = F.regexp_extract("url", "^[a-z]+://[^/]*/([a-z]+)", 1)
    return table(spark, d, "pages").withColumns({"site": site, "listing_category": lang, "ord": F.col("page_id")})


def _nav_links(spark: SparkSession, d: str) -> DataFrame:
    return explode_links(scan_listings(spread_small(_domain_pages(spark, d)), _DOMAINS))


_NAV_SQL = rf"""
    hrefs AS (SELECT page_id, url AS from_url, {_SITE} AS site, {_LANG} AS listing_category,
                     regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS host,
                     regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages),
    nav AS (SELECT page_id, from_url, site, listing_category, pos - 1 AS pos, host || hrefs[pos] AS url
            FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS pos FROM hrefs))
"""

_ALLOWED_SQL = r"""
    CASE {site} WHEN 'com' THEN (regexp_matches({url}, '/en/') OR regexp_matches({url}, '/fr/'))
                      AND NOT (regexp_matches({url}, '\?.*utm_') OR regexp_matches({url}, '/category/'))
                WHEN 'net' THEN NOT regexp_matches({url}, '#top$')
                WHEN 'org' THEN regexp_matches({url}, '^https://') END
"""


@check(f"SELECT page_id, {_SITE} AS site, url FROM pages WHERE {_ALLOWED_SQL.format(site=_SITE, url='url')}")
def q_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return filter_urls(_domain_pages(spark, d).select("page_id", "site", "url"), _DOMAINS)


@check(f"SELECT page_id, {_SITE} AS site, url FROM pages WHERE {_ALLOWED_SQL.format(site=_SITE, url='url')}")
def q_url_filter_table(spark: SparkSession, d: str) -> DataFrame:
    rows = [(r.site, k, p) for r in _DOMAINS.values() for k in ("include", "exclude") for p in getattr(r, k)]
    rules = spark.createDataFrame(rows, "site string, kind string, pattern string")
    return filter_urls_by_table(_domain_pages(spark, d).select("page_id", "site", "url"), rules).select(
        "page_id", "site", "url"
    )


@check(
    f"""
    WITH p AS (SELECT page_id, {_SITE} AS site, url, regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) AS rest FROM pages)
    SELECT page_id, site, url FROM p WHERE (site <> 'net' OR contains(url, '/en/'))
        AND NOT EXISTS (SELECT 1 FROM p r WHERE r.page_id % 3 = 0 AND r.site = p.site AND r.rest = p.rest)
    """
)
def q_url_filter_many(spark: SparkSession, d: str) -> DataFrame:
    """A pattern for every third page, each of which excludes one address, and one that is tried everywhere."""
    pages = _domain_pages(spark, d).select("page_id", "site", "url")
    rest = F.regexp_extract("url", "^[a-z]+://[^/]*(.*)$", 1)
    quoted = F.regexp_replace(rest, "([^A-Za-z0-9/])", r"\\$1")
    rules = pages.filter(F.col("page_id") % 3 == 0).select(
        "site", F.lit("exclude").alias("kind"), F.concat(F.lit("^[a-z]+://[^/]*"), quoted, F.lit("$")).alias("pattern")
    )
    rules = rules.unionByName(spark.createDataFrame([("net", "include", "/en/")], rules.schema))
    return filter_urls_by_index(pages, index_rules(rules)).select("page_id", "site", "url")


@check(
    r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    r AS (SELECT DISTINCT regexp_extract(path, '^(.*/)', 1) AS prefix FROM p UNION SELECT DISTINCT regexp_extract(path, '^(/[^/]*/)', 1) FROM p)
    SELECT page_id, url, coalesce((SELECT arg_max(prefix, length(prefix)) FROM r WHERE starts_with(p.path, prefix)), '') AS category FROM p
    """
)
def q_prefix_table(spark: SparkSession, d: str) -> DataFrame:
    """Categories from a table of all folders of all pages: the longest one of a page is its category."""
    pages = table(spark, d, "pages").select(F.lit("s").alias("site"), "page_id", "url")
    path = F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1)
    folders = F.explode(F.array(F.regexp_extract(path, "^(.*/)", 1), F.regexp_extract(path, "^(/[^/]*/)", 1)))
    rules = pages.select("site", folders.alias("prefix")).distinct()
    rules = rules.select("site", (-F.length("prefix")).alias("ord"), "prefix", F.col("prefix").alias("label"))
    return prefix_category_by_table(pages, rules).select("page_id", "url", "category")


@check(f"WITH {_NAV_SQL} SELECT page_id, site, from_url, pos, url FROM nav")
def q_links(spark: SparkSession, d: str) -> DataFrame:
    return _nav_links(spark, d).select("page_id", "site", "from_url", "pos", "url")


@check(
    f"""
    WITH {_NAV_SQL}
    SELECT site, url, arg_min(from_url, (page_id, pos)) AS from_url, arg_min(listing_category, (page_id, pos)) AS listing_category
    FROM nav GROUP BY site, url
    """
)
def q_first_seen(spark: SparkSession, d: str) -> DataFrame:
    first = first_seen(_nav_links(spark, d), order=["page_id", "pos"])
    return first.select("site", "url", "from_url", "listing_category")


@check(
    f"""
    WITH {_NAV_SQL}
    SELECT site, url, arg_min(from_url, (page_id, from_url, pos)) AS from_url, arg_min(pos, (page_id, from_url, pos)) AS pos,
           arg_min(listing_category, (page_id, from_url, pos)) AS listing_category
    FROM (SELECT *, CASE WHEN site = 'com' THEN '' ELSE from_url END AS page, CASE WHEN site = 'org' THEN pos ELSE -1 END AS place FROM nav)
    GROUP BY site, url, page, place
    """
)
def q_dedup_scope(spark: SparkSession, d: str) -> DataFrame:
    once = dedup_links(_nav_links(spark, d).drop("page_id"), _DOMAINS)
    return once.select("site", "url", "from_url", "pos", "listing_category")


@check(
    f"""
    WITH {_NAV_SQL}
    SELECT site, from_url, listing_category, count(*) AS n_links, min(pos) AS first_pos, max(pos) AS last_pos
    FROM nav GROUP BY site, from_url, listing_category
    """
)
def q_discovery_report(spark: SparkSession, d: str) -> DataFrame:
    return discovery_report(_nav_links(spark, d))


@check(
    rf"""
    SELECT page_id, url, page_id AS ord, {_LANG} AS listing_category,
           CASE WHEN contains(url, '/fr/') THEN 'archive' ELSE 'listing' END AS route
    FROM pages WHERE NOT regexp_matches(url, '[?#]')
    """
)
def q_seed(spark: SparkSession, d: str) -> DataFrame:
    pages = _domain_pages(spark, d)
    plain = pages.filter(~F.col("url").rlike("[?#]"))
    entry = plain.select("site", "ord", "url", F.col("listing_category").alias("category"))
    entry = entry.groupBy("url").agg(F.min_by(F.struct("site", "ord", "category"), "ord").alias("e")).select("url", "e.*")
    seeds = seed_by_table(pages.select("page_id", "url"), entry, archive_mark="/fr/")
    return seeds.select("page_id", "url", "ord", "listing_category", "route")


@check(
    """
    SELECT o_orderkey, 'https://shop.example.org/order/' || o_orderkey AS url,
           'https://shop.example.org/customer/' || c_custkey AS from_url, 'nation ' || c_nationkey AS listing_category
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def q_two_hop(spark: SparkSession, d: str) -> DataFrame:
    host = "=https://shop.example.org/"
    customer = table(spark, d, "customer").select(
        F.lit("shop").alias("site"),
        text(host, "=nation/", "c_nationkey").alias("from_url"),
        text(host, "=customer/", "c_custkey").alias("url"),
        text("=nation ", "c_nationkey").alias("listing_category"),
        F.col("c_custkey").alias("pos"),
    )
    order = table(spark, d, "orders").select(
        "o_orderkey",
        F.lit("shop").alias("site"),
        text(host, "=customer/", "o_custkey").alias("from_url"),
        text(host, "=order/", "o_orderkey").alias("url"),
        F.lit("").alias("listing_category"),
    )
    return two_hop(customer, order).select("o_orderkey", "url", "from_url", "listing_category")


_LINK_SITES = {
    "found": SiteRules("found", link_selector="h2 a[href]", link_mode="read_more_or_css"),
    "cards": SiteRules("cards", link_mode="headline"),
}


@check(
    """
    SELECT event_id, CASE
        WHEN event_type = 'signup' THEN '/card/' || event_id
        WHEN event_type = 'click' THEN '/more/' || event_id || '|/more/' || user_id
        ELSE '/title/' || event_id || '|/title/' || user_id END AS links,
        CASE WHEN event_type = 'click' THEN '/more/' || event_id ELSE '/title/' || user_id END AS preferred
    FROM events
    """
)
def q_link_fallback(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    titles = text('=<h2><a href="/title/', "event_id", '=">A</a></h2><h2><a href="/title/', "user_id", '=">B</a></h2>')
    more = text(
        '=<p><a href="/more/', "event_id", '=">READ More</a><a>read more</a><a href="/more/', "user_id", '=">Please read more ...</a></p>'
    )
    cards = text(
        '=<a href="/card/', "event_id", '="><h3 class="splash">x</h3></a><a href="/x"><h3 class="splash big">y</h3></a>',
        '=<a href="/y"><div><h3 class="splash">z</h3></div></a>',
    )
    kind = F.col("event_type")
    html = F.concat(titles, F.when(kind == "click", more).otherwise(""), cards)
    pages = events.select(
        "event_id",
        F.when(kind == "signup", F.lit("cards")).otherwise(F.lit("found")).alias("site"),
        F.lit("https://x.example.org/list").alias("url"),
        html.alias("html"),
        F.when(kind == "click", F.array(text("=/more/", "event_id"))).otherwise(F.array().cast("array<string>")).alias("a"),
        F.array(text("=/title/", "user_id")).alias("b"),
    )
    scanned = scan_listings(spread_small(pages), _LINK_SITES)
    return scanned.select(
        "event_id", joined("links").alias("links"), joined(prefer_links("a", "b")).alias("preferred")
    )


@check(
    """
    WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(props::JSON->>'k' AS INT) END AS n FROM events)
    SELECT 'https://shop.example.org/list?tag=x&page=0&item=' || event_id AS from_url, page_no,
           'https://shop.example.org/list?tag=x&page=' || page_no || '&item=' || event_id AS url
    FROM (SELECT event_id, unnest(range(1, n + 1)) AS page_no FROM e)
    """
)
def q_page_range(spark: SparkSession, d: str) -> DataFrame:
    rules = {"shop": SiteRules("shop", last_page_selector="li.pager__item--last a")}
    last = F.when(F.col("event_type") == "error", F.lit("?page=none")).otherwise(
        text("=/list?tag=x&page=", F.get_json_object("props", "$.k"), "=#bottom")
    )
    listings = spread_small(table(spark, d, "events")).select(
        F.lit("shop").alias("site"),
        text("=https://shop.example.org/list?tag=x&page=0&item=", "event_id").alias("url"),
        last.alias("last"),
    )
    return expand_pages(listings, rules).select("from_url", "page_no", "url")


@check(
    """
    SELECT 'https://shop.example.org/order/' || o_orderkey AS url, c_mktsegment AS listing_category,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS depth
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def q_next_chain(spark: SparkSession, d: str) -> DataFrame:
    """The orders of a customer as a chain of listing pages."""
    order = table(spark, d, "orders").join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey"))
    turn = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    chain = order.select(
        F.lit("shop").alias("site"),
        text("=https://shop.example.org/order/", "o_orderkey").alias("from_url"),
        text("=https://shop.example.org/order/", F.lead("o_orderkey").over(turn)).alias("url"),
        F.row_number().over(turn).alias("n"),
        F.col("o_custkey").alias("ord"),
        F.col("c_mktsegment").alias("listing_category"),
    )
    seeds = chain.filter("n = 1").select("site", F.col("from_url").alias("url"), "ord", "listing_category")
    edges = chain.filter(F.col("url").isNotNull()).select("site", "from_url", "url")
    return follow_next(seeds, edges).select("url", "listing_category", "depth")


@check(
    """
    WITH RECURSIVE e AS (SELECT DISTINCT user_id AS a, user_id + CAST(props::JSON->>'k' AS INT) % 7 - 2 AS b FROM events WHERE event_type <> 'error'),
    s AS (SELECT DISTINCT user_id AS u FROM events WHERE value > 300),
    r AS (SELECT u, 0 AS depth FROM s UNION SELECT e.b, depth + 1 FROM r JOIN e ON e.a = r.u WHERE depth < 10)
    SELECT '/user/' || u AS url, min(depth) AS depth FROM r GROUP BY u
    """
)
def q_reachable(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    to = F.col("user_id") + F.get_json_object("props", "$.k").cast("int") % 7 - 2
    links = events.filter("event_type <> 'error'").select(
        F.lit("u").alias("site"), text("=/user/", "user_id").alias("from_url"), text("=/user/", to).alias("url")
    )
    seeds = events.filter("value > 300").select(F.lit("u").alias("site"), text("=/user/", "user_id").alias("url"))
    return reachable(seeds, links).select("url", "depth")


@check(
    """
    WITH seen AS (SELECT user_id, max(ts) AS seen_at FROM events WHERE event_type = 'view' AND value > 100 GROUP BY user_id)
    SELECT event_id, '/user/' || user_id AS url, strftime(ts, '%Y-%m-%d') AS lastmod
    FROM events LEFT JOIN seen USING (user_id)
    WHERE seen_at IS NULL OR date_trunc('day', ts) > seen_at
    """
)
def q_lastmod(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    sitemap = events.select(
        "event_id", text("=/user/", "user_id").alias("url"), F.date_format("ts", "yyyy-MM-dd").alias("lastmod")
    )
    seen = events.filter("event_type = 'view' AND value > 100").select(
        text("=/user/", "user_id").alias("url"), F.col("ts").cast("timestamp").alias("seen_at")
    )
    return changed_since(sitemap, seen).select("event_id", "url", "lastmod")


@check(
    """
    SELECT o_orderkey, unnest(CASE WHEN o_orderstatus = 'P' THEN []::VARCHAR[]
        WHEN o_orderpriority = '5-LOW' THEN ['https://shop.example.org/order/' || o_orderkey]
        ELSE ['https://shop.example.org/order/' || o_orderkey, 'https://shop.example.org/customer/' || o_custkey || '?a=1&b=2'] END) AS loc,
        strftime(o_orderdate, '%Y-%m-%d') AS lastmod
    FROM orders
    """
)
def q_sitemap(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    start = F.when(F.col("o_orderkey") % 2 == 0, F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'))
    first = text("=<url><loc>\n https://shop.example.org/order/", "o_orderkey", "= </loc><lastmod>", day, "=</lastmod><priority>0.5</priority></url>")
    second = text("=<url><loc>https://shop.example.org/customer/", "o_custkey", "=?a=1&amp;b=2</loc><lastmod>", day, "=</lastmod></url>")
    blank = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("<url><loc>  </loc></url>")).otherwise(second)
    # Status P: an XML text that breaks off.
    end = F.when(F.col("o_orderstatus") == "P", F.lit("<url><loc>")).otherwise(F.lit("</urlset>"))
    xml = F.concat(F.coalesce(start, F.lit("<urlset>")), first, blank, end)
    maps = spread_small(table(spark, d, "orders")).select("o_orderkey", xml.alias("xml"))
    return sitemap_urls(maps).select("o_orderkey", "loc", "lastmod")
