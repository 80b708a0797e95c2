"""Finding article URLs in stored listing pages, archives and sitemaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.urls import query_param, query_param_slot, resolve_url
from folioflow.operators.extraction import dom_select, listing_fields
from folioflow.rules import Rules, SiteRules, allowed_by_rules, by_site
from folioflow.session import broadcast_if_small, cut_counted, cut_lineage

PAGE_CHUNK = 10_000
MAX_LITERAL_SEEDS = 5000
MAX_DEPTH = 10  # fixed value: crawl depth limit
SEED_SCHEMA = "site string, ord int, url string, listing_category string, route string"


def route_of(r: SiteRules, url: str) -> str:
    return "archive" if r.archive_mark and r.archive_mark in url else "listing"


def seed(spark: SparkSession, rules: Rules) -> DataFrame:
    """Start URLs of all sites with their listing category and route."""
    rows = []
    for r in rules.values():
        rows += [(r.site, n, url, cat, route_of(r, url)) for n, (url, cat) in enumerate(r.entry_points)]
        if r.sitemap_url:
            rows.append((r.site, 0, r.sitemap_url, "", "sitemap"))
    return spark.createDataFrame(rows, SEED_SCHEMA)


def seed_pages(pages: DataFrame, rules: Rules) -> DataFrame:
    """Stored pages that are start pages, with ``ord``, ``listing_category`` and ``route``.

    Start URLs are configuration: they are pushed into the scan as an ``IN`` filter,
    and the join that adds their category broadcasts just them.
    """
    starts = seed(pages.sparkSession, rules)
    urls = [u for r in rules.values() for u, _ in r.entry_points] + [r.sitemap_url for r in rules.values() if r.sitemap_url]
    if len(urls) <= MAX_LITERAL_SEEDS:
        pages, starts = pages.filter(F.col("url").isin(urls)), F.broadcast(starts)
    return pages.join(starts, ["site", "url"])


def seed_by_table(pages: DataFrame, entry_points: DataFrame, archive_mark: str | None = None) -> DataFrame:
    """Start pages from a table of entry points (site, ord, url, category)."""
    archive = F.contains("url", F.lit(archive_mark)) if archive_mark else F.lit(False)
    points = entry_points.select("site", "ord", "url", F.col("category").alias("listing_category"))
    return pages.join(points, "url").withColumn(
        "route", F.when(archive, F.lit("archive")).otherwise(F.lit("listing"))
    )


def scan_listings(pages: DataFrame, rules: Rules) -> DataFrame:
    """Link arrays of listing pages in one parse: ``links``, ``editions``, ``next``, ``last``.

    Page text is dropped here; everything after works on URLs only.
    """
    fields = listing_fields(rules)
    scanned = dom_select(pages, fields, into="_listing").drop("html")
    have = scanned.schema["_listing"].dataType.names
    array, text = "array<string>", "string"
    picks = [
        (F.col(f"_listing.{n}") if n in have else F.lit(None).cast(t)).alias(n)
        for n, t in (("links", array), ("editions", array), ("next", text), ("last", text))
    ]
    return scanned.select(*[c for c in scanned.columns if c != "_listing"], *picks)


def prefer_links(first: Column | str, second: Column | str) -> Column:
    """The first link array, and only if it has no link the second."""
    first = F.col(first) if isinstance(first, str) else first
    second = F.col(second) if isinstance(second, str) else second
    return F.when(F.size(first) > 0, first).otherwise(second)


def explode_links(listings: DataFrame, links: str = "links") -> DataFrame:
    """One row per link in document order, resolved against the listing's URL."""
    keep = [c for c in listings.columns if c not in ("links", "editions", "next", "last", "url")]
    rows = listings.select(*keep, F.col("url").alias("from_url"), F.posexplode(links).alias("pos", "_href"))
    return rows.withColumn("url", resolve_url("from_url", "_href")).drop("_href")


def extract_links(listings: DataFrame, rules: Rules) -> DataFrame:
    """Article links of scanned listings that pass their site's URL filter."""
    return filter_urls(explode_links(listings), rules)


def filter_urls(links: DataFrame, rules: Rules, url: str = "url") -> DataFrame:
    return links.filter(allowed_by_rules("site", url, rules))


def filter_urls_by_table(links: DataFrame, url_rules: DataFrame, url: str = "url") -> DataFrame:
    """URL filter with rules given as a table (site, kind, pattern).

    Patterns are gathered per site (rules are configuration: tens per site) and
    looked up by an equi-join: broadcast when the table has been counted to be small,
    else left to AQE. Sites without include rules keep everything not excluded.
    """

    def patterns(kind: str) -> Column:
        return F.collect_set(F.when(F.col("kind") == kind, F.col("pattern"))).alias(f"_{kind}")

    per_site = url_rules.groupBy("site").agg(patterns("include"), patterns("exclude"))
    joined = links.join(broadcast_if_small(per_site), "site", "left")

    def found(kind: str) -> Column:
        return F.exists(F.coalesce(f"_{kind}", F.array().cast("array<string>")), lambda p: F.rlike(F.col(url), p))

    no_include = F.coalesce(F.size("_include"), F.lit(0)) <= 0
    return joined.filter((no_include | found("include")) & ~found("exclude")).select(*links.columns)


def first_seen(links: DataFrame, order: list[str] | None = None, scope: list[str] | None = None) -> DataFrame:
    """Each URL once per scope; the earliest discovery gives the listing category.

    A plain aggregate, so copies are combined before the shuffle however many there
    are of one URL.
    """
    order = order or [c for c in ("depth", "ord", "from_url", "pos") if c in links.columns]
    scope = scope or ["site", "url"]
    rest = [c for c in links.columns if c not in scope]
    first = links.groupBy(*scope).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*scope, "_first.*")


def dedup_links(links: DataFrame, rules: Rules) -> DataFrame:
    """First discovery per URL in the scope each site asks for: run, page, or none.

    One aggregate serves all scopes: the page scope adds the listing URL to the key,
    no scope adds the position as well.
    """

    def scope(r: SiteRules) -> Column:
        page = F.col("from_url") if r.dedup_scope != "site" else F.lit("")
        place = F.col("pos") if r.dedup_scope == "none" else F.lit(-1)
        return F.struct(page.alias("page"), place.alias("place"))

    scoped = links.withColumn("_scope", by_site("site", rules, scope))
    return first_seen(scoped, scope=["site", "url", "_scope"]).drop("_scope")


def expand_pages(listings: DataFrame, rules: Rules, last: str = "last") -> DataFrame:
    """URLs of listing pages 1..n, n read from the "last page" link (absent or no number: none).

    Long ranges are generated in chunks spread over the cluster, so neither a row nor
    a task ever holds a whole range.
    """
    # The link's query is its own, or the page's when the link is empty or a fragment.
    target = F.when(F.col(last).rlike(r"^\s*(#|$)"), F.col("url")).otherwise(F.col(last))
    number = by_site("site", rules, lambda r: query_param(target, r.page_param) if r.last_page_selector else None)
    number = F.regexp_extract(F.coalesce(number.cast("string"), F.lit("")), r"^\s*\+?(\d+)\s*$", 1)
    keep = [c for c in listings.columns if c not in ("links", "editions", "next", "last")]
    slot = by_site("site", rules, lambda r: query_param_slot("url", r.page_param))
    ranged = listings.select(*keep, number.try_cast("bigint").alias("_last"), slot.alias("_slot"))
    # Most ranges are short and are written out where they are; long ones go in chunks over the cluster.
    short = ranged.filter((F.col("_last") >= 1) & (F.col("_last") <= PAGE_CHUNK))
    short = short.withColumn("page_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_last"))))
    last_chunk = F.floor((F.col("_last") - 1) / PAGE_CHUNK)
    chunks = ranged.filter(F.col("_last") > PAGE_CHUNK).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk))
    )
    first = F.col("_chunk") * PAGE_CHUNK + 1
    # A fixed number: AQE would merge these short rows into few tasks before they multiply.
    tasks = int(listings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = chunks.repartition(tasks, "url", "_chunk").withColumn(
        "page_no", F.explode(F.sequence(first, F.least(F.col("_last"), first + PAGE_CHUNK - 1)))
    )
    pages = short.unionByName(long.drop("_chunk"))
    built = F.concat("_slot.head", F.col("page_no").cast("string"), "_slot.tail")
    return pages.withColumnRenamed("url", "from_url").withColumn("url", built).drop("_last", "_slot")


# ---- hops over stored links -----------------------------------------------------------


def two_hop(first: DataFrame, second: DataFrame) -> DataFrame:
    """Links reached over one page in between: ``first.url`` is ``second.from_url``.

    ``first`` is reduced to one row per page in between, so the join multiplies nothing.
    """
    middle = first_seen(first).select("site", F.col("url").alias("from_url"), "listing_category")
    return second.drop("listing_category").join(middle, ["site", "from_url"])


def follow_next(seeds: DataFrame, edges: DataFrame, max_steps: int | None = None) -> DataFrame:
    """Pages reached from the seeds over "next" links, with their seed's category.

    ``seeds``: site, url, ord, listing_category, and ``depth`` if they have one. ``edges``:
    site, from_url, url, and ``fetched_at`` and ``pos`` if known: of several next links of a page the first one of
    the latest fetch counts. Each round doubles the length of the jumps, so a chain of n
    pages takes log2(n) rounds. A page on several chains belongs to the nearest seed.
    """
    columns = ["site", "url", "ord", "listing_category", "depth"]
    start = (seeds if "depth" in seeds.columns else seeds.withColumn("depth", F.lit(0).cast("long"))).select(*columns)
    reached = cut_lineage(first_seen(start, order=["depth", "ord"]).select(*columns))
    newest = [-F.unix_micros(F.col("fetched_at").cast("timestamp"))] if "fetched_at" in edges.columns else []
    first = F.struct(*newest, *(["pos"] if "pos" in edges.columns else []), "url")
    jumps = edges.groupBy("site", "from_url").agg(F.min_by("url", first).alias("url"))
    length = 1
    while max_steps is None or length <= max_steps:
        jumps = cut_lineage(jumps)
        ahead = (
            reached.withColumnRenamed("url", "from_url")
            .join(jumps, ["site", "from_url"])
            .withColumn("depth", F.col("depth") + length)
            .select(*columns)
        )
        if max_steps is not None:
            ahead = ahead.filter(F.col("depth") <= max_steps)
        # Everything nearer than ``length`` is known already, so only pages without a depth are new.
        fresh = first_seen(ahead, order=["depth", "ord"]).join(reached.select("site", "url"), ["site", "url"], "left_anti")
        fresh, n = cut_counted(fresh.select(*columns))
        if not n:
            break
        reached = reached.unionByName(fresh)
        onward = jumps.select("site", F.col("from_url").alias("url"), F.col("url").alias("_to"))
        jumps = jumps.join(onward, ["site", "url"]).select("site", "from_url", F.col("_to").alias("url"))
        length *= 2
    return reached


def reachable(
    seeds: DataFrame,
    links: DataFrame | Callable[[DataFrame], DataFrame],
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """URLs reachable from the seeds over stored links within ``max_depth``, with least depth.

    ``seeds``: site, url. ``links``: site, from_url, url, or a function that gives
    the links leaving a frontier. Every level is cut off by a reliable checkpoint;
    targets are made distinct before they meet the visited set.
    """
    frontier = seeds.select("site", "url").distinct().withColumn("depth", F.lit(0))
    frontier = cut_lineage(frontier)
    visited = frontier
    for depth in range(1, max_depth + 1):
        sources = frontier.select("site", F.col("url").alias("from_url"))
        step = links(sources) if callable(links) else links.join(sources, ["site", "from_url"], "left_semi")
        targets = step.select("site", "url").distinct()
        frontier, n = cut_counted(
            targets.join(visited.select("site", "url"), ["site", "url"], "left_anti").withColumn("depth", F.lit(depth))
        )
        if not n:
            break
        visited = visited.unionByName(frontier)
    return visited


# ---- reports and incremental choice ---------------------------------------------------


def discovery_report(links: DataFrame) -> DataFrame:
    """Dry run: how many URLs each listing gives."""
    return links.groupBy("site", "from_url", "listing_category").agg(
        F.count(F.lit(1)).alias("n_links"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


def changed_since(sitemap: DataFrame, seen: DataFrame) -> DataFrame:
    """Sitemap URLs never seen, or changed after they were last seen."""
    last = seen.groupBy("url").agg(F.max("seen_at").alias("seen_at"))
    modified = F.coalesce(F.try_to_timestamp("lastmod"), F.try_to_date("lastmod", "yyyy-MM-dd").cast("timestamp"))
    return (
        sitemap.join(last, "url", "left")
        .filter(F.col("seen_at").isNull() | (modified > F.col("seen_at")))
        .select(*sitemap.columns, "seen_at")
    )
