"""The link graph of a library, closed batch by batch.

A page is a listing if it is a start page, if a start page's archive or page count names it, or
if a chain of next links leads to it; links of listings name articles. Listing pages, pages
between them and articles may come in any batch. ``grow`` follows only what is new (semi-naive):

* links of pages that came now, from listings known before;
* links of all pages ever stored, from listings that became known now;
* next links: those of this batch and those that wait, because nothing led to their page yet.

What earlier batches have left lies in key buckets, and a batch reads the buckets of its own
URLs. Next links that wait are one small table per batch. A URL keeps the category it was
first found with: first by batch, inside a batch by depth, start page, listing and position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.operators.discovery import expand_pages, explode_links, extract_links, first_seen, follow_next, seed, seed_pages
from folioflow.rules import Rules
from folioflow.session import cut_lineage, join_path
from folioflow.streaming.state import VersionedTable, complete_dirs

LISTING = {"links": "array<string>", "editions": "array<string>", "next": "string", "last": "string"}
KEYS = ["site", "url"]
PLAIN = ["site", "url", "ord", "listing_category", "depth"]



REACHED = "site string, url string, ord int, listing_category string, depth bigint, chained boolean"
SHELF = "site string, url string, links array<string>"
LINKED = "site string, url string, listing_category string, from_url string, ord int, depth bigint, pos int"
STAGED = "site string, url string, _batch bigint, _row bigint"
WAITING = "site string, from_url string, url string, fetched_at timestamp"


class GraphStore:
    """Tables of the link graph below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        tables = {"reached": REACHED, "shelves": SHELF, "linked": LINKED, "pages": STAGED}
        self.reached, self.shelves, self.linked, self.pages = (
            VersionedTable(spark, join_path(root, name), T._parse_datatype_string(schema), KEYS) for name, schema in tables.items()
        )

    def waiting_before(self, batch: int) -> DataFrame:
        """Next links that wait when ``batch`` begins."""
        top = join_path(self.root, "waiting")
        done = sorted(int(n[4:]) for n in complete_dirs(self.spark, top) if n.startswith("run="))
        done = [n for n in done if n < batch]
        schema = T._parse_datatype_string(WAITING)
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(join_path(top, f"run={done[-1]}"))

    def write_waiting(self, edges: DataFrame, batch: int) -> None:
        edges.write.mode("overwrite").parquet(join_path(self.root, "waiting", f"run={batch}"))

    def compact(self, batch: int) -> None:
        for table in (self.reached, self.shelves, self.linked, self.pages):
            table.compact(batch)


def start_listings(scan: DataFrame, seeds: DataFrame, rules: Rules) -> list[DataFrame]:
    """Listings that the start pages in ``scan`` name, over archives and page counts."""
    found = []
    if any(r.edition_selector for r in rules.values()):
        archives = seeds.filter(F.col("route") == "archive")
        editions = first_seen(explode_links(archives, "editions"), order=["ord", "from_url", "pos"])
        found.append(editions.withColumn("depth", F.col("pos").cast("long") + 1).select(*PLAIN))
    if any(r.last_page_selector for r in rules.values()):
        paged = expand_pages(seeds.filter(F.col("route") == "listing"), rules)
        found.append(paged.withColumn("depth", F.col("page_no")).select(*PLAIN))
    return found


def next_edges(scan: DataFrame) -> DataFrame:
    edges = scan.filter(F.col("next").isNotNull()).select("site", "url", "fetched_at", F.array("next").alias("links"))
    return explode_links(edges).select("site", "from_url", "url", "fetched_at")


@dataclass
class Growth:
    """What a batch added: its new listings, and article links that no earlier batch had."""

    listings: DataFrame
    links: DataFrame


def grow(staged: DataFrame, rules: Rules, store: GraphStore, batch: int, more_links: DataFrame | None = None) -> Growth:
    """Close the graph over the pages ``staged`` (site, url, fetched_at, link columns, _batch, _row).

    ``more_links`` are links found elsewhere (sitemaps), with the columns of ``LINKED``.
    """
    scan = staged.select(*KEYS, "fetched_at", *LISTING)
    store.pages.write_delta(staged, batch)
    store.shelves.write_delta(scan.filter(F.size("links") > 0), batch)

    starts = seed(staged.sparkSession, rules).filter(F.col("route") == "listing").withColumn("depth", F.lit(0).cast("long"))
    starts = starts.select(*PLAIN)
    named = [d.withColumn("chained", F.lit(False)) for d in start_listings(scan, seed_pages(scan, rules), rules)]
    chained = [starts]
    if any(r.next_selector for r in rules.values()):
        fresh = next_edges(scan)
        sources = store.reached.read_before(batch, fresh.select("site", F.col("from_url").alias("url"))).filter("chained")
        edges = store.waiting_before(batch).unionByName(fresh)
        chain = follow_next(sources.select(*PLAIN).unionByName(starts), edges)
        left = edges.join(chain.select("site", F.col("url").alias("from_url")), ["site", "from_url"], "left_anti")
        store.write_waiting(left, batch)
        chained.append(chain)
    found = first_seen(chained[-1], order=["depth", "ord"]).select(*PLAIN).withColumn("chained", F.lit(True))
    for more in named:
        found = found.unionByName(more)
    found = cut_lineage(first_seen(found, order=["depth", "ord"], scope=[*KEYS, "chained"]))

    before = store.reached.read_before(batch, found).select(*KEYS, "chained").distinct()
    store.reached.write_delta(found.join(before, [*KEYS, "chained"], "left_anti"), batch)
    listings = found.join(before.select(*KEYS).distinct(), KEYS, "left_anti")
    listings = cut_lineage(first_seen(listings, order=["depth", "ord"], scope=KEYS).select(*PLAIN))

    # New listings meet all pages stored so far, known ones the pages of this batch.
    old_shelves = store.shelves.read_before(batch, listings).drop("_run")
    here = scan.filter(F.size("links") > 0).select(*KEYS, "links")
    known = store.reached.read_before(batch, here)
    known = first_seen(known, order=["_run", "depth", "ord"], scope=KEYS).select(*PLAIN)
    pairs = old_shelves.join(listings, KEYS).unionByName(here.join(listings.unionByName(known), KEYS))
    columns = [c.split()[0] for c in LINKED.split(", ")]
    links = extract_links(pairs, rules).select(*columns)
    if more_links is not None:
        links = links.unionByName(more_links.select(*columns))
    links = cut_lineage(first_seen(links))
    links = links.join(store.linked.read_before(batch, links).select(*KEYS), KEYS, "left_anti").select(*columns)
    store.linked.write_delta(links, batch)
    return Growth(listings, store.linked.read_before(batch + 1).filter(F.col("_run") == batch).drop("_run"))
