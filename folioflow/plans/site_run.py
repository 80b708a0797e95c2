"""Whole runs: stored pages in, new and updated items out.

A run is four steps with a written table between them:

1. ``stage_pages``  one pass over the page text, one parse per page, no shuffle;
2. ``discover``     graph work on URLs only;
3. ``decide``       change detection and output names on narrow rows;
4. ``write_run``    bodies are read back and joined once with the decisions.

Written tables instead of cached ones let a run go on when executors are lost, and
column pruning keeps bodies out of steps 2 and 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.normalize import item_hash, normalize_date
from folioflow.operators.discovery import (
    dedup_links,
    discovery_report,
    extract_links,
    filter_urls,
    first_seen,
    follow_next,
    seed_pages,
)
from folioflow.operators.extraction import (
    article_fields,
    dom_select,
    extract_jsonld,
    flag_captcha,
    listing_fields,
    merge_fields,
)
from folioflow.operators.items import assemble_items
from folioflow.operators.quality import assign_file_names, base_name, detect_changes, drop_unchanged, latest_state
from folioflow.plans.link_graph import KEYS, LISTING, PLAIN, GraphStore, grow, next_edges, start_listings
from folioflow.rules import Rules, by_site
from folioflow.session import cut_lineage, join_path, passing_cuts, spread_small
from folioflow.sources.items import write_items
from folioflow.sources.sitemap import sitemap_urls
from folioflow.streaming.state import COMPACT_EVERY, NameTable, SeenTable

class RunStore:
    """Folders of a site library below one (shared) root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.seen = SeenTable(spark, join_path(root, "seen"))
        self.names = NameTable(spark, join_path(root, "names"))
        self.graph = GraphStore(spark, join_path(root, "graph"))

    def staged(self, batch: int) -> str:
        return join_path(self.root, "staged", f"batch={batch}")

    def items(self, batch: int) -> str:
        return join_path(self.root, "items", f"batch={batch}")

    def compact(self, batch: int) -> None:
        self.seen.compact(batch)
        self.names.compact(batch)
        self.graph.compact(batch)


def stage_pages(pages: DataFrame, rules: Rules, path: str, skip_captcha: bool = False, batch: int = 0) -> DataFrame:
    """Parse every page once for listing and article fields; write and read back the result.

    ``_batch`` and ``_row`` name a staged page over all batches.
    """
    articles, listings = article_fields(rules), listing_fields(rules)
    fields = {s: {**articles.get(s, {}), **listings.get(s, {})} for s in rules}
    known = flag_captcha(pages.filter(F.col("site").isin(list(rules))), skip=skip_captcha)
    parsed = merge_fields(extract_jsonld(dom_select(spread_small(known), fields), rules).drop("html"))
    have = parsed.schema["dom"].dataType.names
    flat = [(F.col(f"dom.{n}") if n in have else F.lit(None).cast(t)).alias(n) for n, t in LISTING.items()]
    # Merged fields are stored once; of the DOM only what has no merged counterpart.
    rest = [F.col(f"dom.{n}").alias(n) for n in ("tags", "images") if n in have]
    dom = F.struct(*rest) if rest else F.struct(F.lit(None).cast("array<string>").alias("tags"))
    kept = [c for c in parsed.columns if c not in ("dom", "jsonld")]
    staged = parsed.select(*kept, dom.alias("dom"), *flat).withColumn("_content_hash", item_hash("merged.body"))
    staged = staged.withColumns({"_batch": F.lit(batch).cast("long"), "_row": F.monotonically_increasing_id()})
    return _stored(staged, path)


def discover(staged: DataFrame, pages: DataFrame, rules: Rules) -> DataFrame:
    """All article links of one set of pages: site, url, listing_category, from_url, ord, depth, pos.

    A run keeps the graph of all its batches instead (``link_graph.grow``).
    """
    scan = staged.select("site", "url", "fetched_at", *LISTING)
    seeds = seed_pages(scan, rules)
    start = seeds.filter(F.col("route") == "listing")
    known = start.withColumn("depth", F.lit(0).cast("long")).select(*PLAIN)
    for more in start_listings(scan, seeds, rules):
        known = known.unionByName(more)
    if any(r.next_selector for r in rules.values()):
        known = known.unionByName(follow_next(start, next_edges(scan)).filter(F.col("depth") > 0).select(*PLAIN))
    known = first_seen(known, order=["depth", "ord"])
    found = extract_links(scan.select("site", "url", "links").join(known, ["site", "url"]), rules)
    return found.unionByName(_sitemap_links(pages, rules), allowMissingColumns=True)


def _sitemap_links(pages: DataFrame, rules: Rules) -> DataFrame:
    urls = [r.sitemap_url for r in rules.values() if r.sitemap_url]
    maps = pages.filter(F.col("url").isin(urls))
    return _map_links(maps.select("site", F.col("url").alias("from_url"), F.col("html").alias("xml")), rules)


def _map_links(maps: DataFrame, rules: Rules) -> DataFrame:
    """Links of the sitemaps ``maps(site, from_url, xml)``."""
    entries = sitemap_urls(maps).select("site", "from_url", F.col("loc").alias("url"), "pos")
    return filter_urls(entries, rules).withColumns(
        {
            "listing_category": F.lit(""),
            "ord": F.lit(0),
            "depth": F.lit(0).cast("long"),
        }
    )


def decide(staged: DataFrame, links: DataFrame | None, rules: Rules, store: RunStore, batch: int) -> DataFrame:
    """``_batch``, ``_row``, ``_change``, ``file_name`` and listing category of every new or updated item."""
    slim = staged.select(
        "_batch",
        "_row",
        "site",
        "url",
        "_content_hash",
        *(["listing_category"] if "listing_category" in staged.columns and links is None else []),
        F.col("fetched_at").alias("_scraped_at"),
        by_site("site", rules, lambda r: F.lit(r.brand)).alias("brand"),
        normalize_date("merged.date_published").alias("date_published"),
    )
    if links is None:
        slim = filter_urls(slim, rules)
    else:
        # Whatever the site's own scope is, a URL is taken up once per run.
        slim = slim.join(first_seen(links).select(*KEYS, "listing_category"), KEYS)
    slim = slim.withColumns(
        {
            "_key": F.col("url"),
            "source_url": F.col("url"),
            "canonical_url": F.col("url"),
            "content_type": F.lit("article"),
        }
    )
    seen = store.seen.before(batch, cut_lineage(slim.select("brand", "url").distinct()))
    changed = drop_unchanged(detect_changes(slim, seen, order=("_scraped_at", "_content_hash", "_batch", "_row")))
    changed = _stored(changed, join_path(store.root, "changed", f"batch={batch}"))
    names = store.names.before(batch, changed.select(base_name().alias("_base")))
    named = assign_file_names(changed, names, order=("_scraped_at", "url", "_content_hash", "_batch", "_row"))
    keep = ["_batch", "_row", "_change", "file_name"] + (["listing_category"] if "listing_category" in named.columns else [])
    return _stored(named.select(*keep), join_path(store.root, "decided", f"batch={batch}"))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_run(staged: DataFrame, decisions: DataFrame, rules: Rules, path: str) -> None:
    """Join decisions with the bodies and write the items."""
    fresh = staged.drop("listing_category") if "listing_category" in decisions.columns else staged
    joined = fresh.join(decisions, ["_batch", "_row"])
    items = assemble_items(joined, rules, keep=("_change", "file_name"))
    write_items(items, path)


def run_batch(
    pages: DataFrame,
    rules: Rules,
    store: RunStore,
    batch: int,
    *,
    crawl_links: bool = True,
    skip_captcha: bool = False,
) -> None:
    """One run over ``pages`` (site, url, html, fetched_at).

    With ``crawl_links`` articles are the pages found over the sites' listings and
    sitemaps, whichever batch the one and the other came in; without, every page that
    passes its site's URL filter is one. Items are written before names and state, so a run
    that stops half-way loses nothing.
    """
    with passing_cuts(store.spark):
        _run_batch(pages, rules, store, batch, crawl_links, skip_captcha)


def _run_batch(pages: DataFrame, rules: Rules, store: RunStore, batch: int, crawl_links: bool, skip_captcha: bool) -> None:
    staged = stage_pages(pages, rules, store.staged(batch), skip_captcha, batch)
    links = None
    if crawl_links:
        staged, links = _with_earlier(staged, pages, rules, store, batch)
    decisions = decide(staged, links, rules, store, batch)
    write_run(staged, decisions, rules, store.items(batch))

    store.names.write_names(decisions, batch)
    # The state after a batch is the last changed version of each key: an unchanged
    # version has the hash that is stored already.
    fresh = staged.select(
        "_batch",
        "_row",
        F.col("url").alias("_key"),
        "_content_hash",
        F.col("fetched_at").alias("_scraped_at"),
        by_site("site", rules, lambda r: F.lit(r.brand)).alias("brand"),
    ).join(decisions.select("_batch", "_row"), ["_batch", "_row"], "left_semi")
    store.seen.write_delta(latest_state(fresh, order=("_scraped_at", "_content_hash", "_batch", "_row")), batch)
    if batch and batch % COMPACT_EVERY == 0:
        store.compact(batch)


def _with_earlier(
    staged: DataFrame, pages: DataFrame, rules: Rules, store: RunStore, batch: int
) -> tuple[DataFrame, DataFrame]:
    """Pages and links this batch has to look at, with those that waited for it.

    Links known before meet the pages of this batch; pages of earlier batches that no link
    led to meet the links that are new now. Of earlier batches only those that hold such a
    page are read, and bodies only where a decision asks for them.
    """
    fresh = grow(staged, rules, store.graph, batch, _sitemap_links(pages, rules)).links
    known = store.graph.linked.read_before(batch, staged.select(*KEYS)).drop("_run")
    waiting = cut_lineage(store.graph.pages.read_before(batch, fresh).drop("_run"))
    held = [r[0] for r in waiting.select("_batch").distinct().collect()]  # as many as batches at most
    if held:
        old = store.spark.read.parquet(*[store.staged(b) for b in sorted(held)])
        old = old.join(waiting.select("_batch", "_row"), ["_batch", "_row"], "left_semi")
        staged = staged.unionByName(old, allowMissingColumns=True)
    return staged, fresh.unionByName(known)


def dry_run(pages: DataFrame, rules: Rules, root: str, batch: int = 0) -> DataFrame:
    """What a run would take up: URLs per listing, in the scope each site counts them. No items."""
    store = RunStore(pages.sparkSession, root)
    staged = stage_pages(pages, rules, store.staged(batch))
    return discovery_report(dedup_links(discover(staged, pages, rules), rules))


def run_sites(pages: DataFrame, rules: Rules, root: str, batch: int = 0, **options) -> str:
    """Run all sites of ``rules`` and give the folder of the written items."""
    store = RunStore(pages.sparkSession, root)
    run_batch(pages, rules, store, batch, **options)
    return store.items(batch)
