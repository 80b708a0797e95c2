"""Tables that outlive a batch: buckets that are read, intervals of names, the link graph, the upsert."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioflow.operators.lake import upsert_table
from folioflow.operators.quality import assign_file_names, merge_intervals, number_intervals
from folioflow.plans.link_graph import GraphStore, grow
from folioflow.rules import SiteRules
from folioflow.session import cut_counted, cut_lineage, passing_cuts
from folioflow.streaming.shared_view import SharedView, fold_batch
from folioflow.streaming.state import NameTable, SeenTable

T0 = datetime(2024, 6, 1)
SEEN = "brand string, url string, content_hash string, seen_at timestamp"


def seen_rows(spark, n, mark):
    return spark.createDataFrame([("b", f"/u/{i}", f"{mark}{i}", T0) for i in range(n)], SEEN)


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    store = SeenTable(spark, str(tmp_path), 32)
    store.write_delta(seen_rows(spark, 2000, "a"), 0)
    store.write_delta(seen_rows(spark, 500, "b"), 1)
    keys = spark.createDataFrame([("b", "/u/7"), ("b", "/u/1999"), ("c", "/u/7")], "brand string, url string")
    state = store.before(2, keys)
    assert sorted((r.url, r.content_hash) for r in state.collect()) == [("/u/1999", "a1999"), ("/u/7", "b7")]
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    store.compact(1)
    assert sorted((r.url, r.content_hash) for r in store.before(2, keys).collect()) == [("/u/1999", "a1999"), ("/u/7", "b7")]
    assert store.before(2).count() == 2000
    # Another number of buckets is not taken over by a table that is there.
    again = SeenTable(spark, str(tmp_path), 5)
    assert again.buckets == 32 and again.before(2, keys).count() == 2


def test_empty_batches_and_no_versions(spark, tmp_path):
    store = SeenTable(spark, str(tmp_path), 4)
    assert store.before(5).count() == 0 and store.before(5, seen_rows(spark, 3, "x")).count() == 0
    store.write_delta(seen_rows(spark, 0, "a"), 0)
    assert store.before(1).count() == 0
    store.write_delta(seen_rows(spark, 2, "a"), 1)
    store.write_delta(seen_rows(spark, 0, "a"), 2)
    assert store.before(3, seen_rows(spark, 1, "x")).count() == 1


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_intervals(spark, hot_rows):
    rng = random.Random(6)
    numbers = {(b, rng.randrange(60)) for b in "xy" for _ in range(40)}
    named = spark.createDataFrame([*numbers, *list(numbers)[:9]], "_base string, _number long")
    runs = number_intervals(named, hot_rows).collect()
    assert {(r._base, n) for r in runs for n in range(r._lo, r._hi + 1)} == numbers
    assert len(runs) == sum((b, n - 1) not in numbers for b, n in numbers)

    given = [(b, lo, lo + rng.randrange(6)) for b in "xy" for lo in rng.sample(range(80), 12)]
    given += given[:3]
    covered = {(b, n) for b, lo, hi in given for n in range(lo, hi + 1)}
    merged = merge_intervals(spark.createDataFrame(given, "_base string, _lo long, _hi long"), hot_rows).collect()
    assert sorted((r._base, n) for r in merged for n in range(r._lo, r._hi + 1)) == sorted(covered)
    assert len(merged) == sum((b, n - 1) not in covered for b, n in covered)


def test_ten_million_used_numbers_are_a_few_rows(spark, tmp_path):
    names = NameTable(spark, str(tmp_path))
    base = "b_article_20240601_x"
    rows = [(base, 0, 4_999_999), (base, 5_000_001, 9_999_999), (base, 10_000_001, 10_000_001)]
    names.write_delta(spark.createDataFrame(rows, "_base string, _lo long, _hi long"), 0)
    items = spark.createDataFrame(
        [("b", "article", "2024-06-01", f"https://e.org/{i}/x", None, str(i), T0) for i in range(4)],
        "brand string, content_type string, date_published string, source_url string, canonical_url string, body string, _scraped_at timestamp",
    )
    got = assign_file_names(items, names.before(1), order=("source_url",))
    assert sorted(r.file_name for r in got.collect()) == [f"{base}_{n}.json" for n in (10000000, 10000002, 10000003, 5000000)]
    names.write_names(got, 1)
    assert names.before(2).count() == 6
    names.compact(1)
    assert [(r._lo, r._hi) for r in names.before(2).collect()] == [(0, 10_000_003)]


PAGES = "site string, url string, fetched_at timestamp, links array<string>, editions array<string>, next string, last string, _batch long, _row long"


def graph_pages():
    """A chain u0 to u7, an archive with two editions, and pages nothing leads to."""
    def page(url, links=(), editions=None, next_=None):
        return url, list(links), editions, next_

    h = "https://s.example.org/"
    pages = [page(f"{h}u{i}", [f"{h}a{i}", f"{h}a{i + 1}"], None, f"{h}u{i + 1}" if i < 7 else f"{h}u0") for i in range(8)]
    pages += [page(f"{h}archive", [], [f"{h}e1", f"{h}e2"]), page(f"{h}e1", [f"{h}x1"]), page(f"{h}e2", [f"{h}x2", f"{h}a3"])]
    pages += [page(f"{h}stray{i}", [f"{h}never{i}"], None, f"{h}stray{i + 1}") for i in range(3)]
    return pages


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_grows_to_the_same_whatever_the_batches(spark, tmp_path, seed):
    h = "https://s.example.org/"
    starts = ((f"{h}u0", "News"), (f"{h}archive", "Old"))
    rules = {"s": SiteRules("s", entry_points=starts, archive_mark="archive", edition_selector="x", next_selector="x", link_selector="x")}
    pages = graph_pages()
    random.Random(seed).shuffle(pages)
    batches = [pages[:5], pages[5:9], [], pages[9:]]
    store = GraphStore(spark, str(tmp_path))
    links, listings = [], []
    for n, part in enumerate([*batches, batches[3]]):
        n = min(n, 3)  # the last batch comes twice
        rows = [("s", url, T0, ls, eds, nxt, None, n, k) for k, (url, ls, eds, nxt) in enumerate(part)]
        grown = grow(spark.createDataFrame(rows, PAGES), rules, store, n)
        if n == 3:
            links, listings = [x for x in links if x[0] < 3], [x for x in listings if x[0] < 3]
        links += [(n, r.url, r.listing_category) for r in grown.links.collect()]
        listings += [(n, r.url) for r in grown.listings.collect()]
    want = {f"{h}a{i}": "News" for i in range(9)} | {f"{h}x1": "Old", f"{h}x2": "Old"}
    assert len(links) == len(want) and {u for _, u, _ in links} == set(want)
    assert all(want[u] == c for _, u, c in links if not u.endswith("/a3"))
    assert sorted(u for _, u in listings) == sorted({f"{h}u{i}" for i in range(8)} | {f"{h}e1", f"{h}e2"})
    assert {r.from_url for r in store.waiting_before(4).collect()} == {f"{h}stray{i}" for i in range(3)}


def test_upsert_keeps_its_number_of_buckets(spark, tmp_path):
    def rows(lo, hi, mark):
        data = [("b", f"/i/{i}", f"{mark}", "body", T0) for i in range(lo, hi)]
        return spark.createDataFrame(data, "brand string, source_url string, _content_hash string, body string, _scraped_at timestamp")

    path = str(tmp_path / "lake")
    counts = []
    for part, buckets in ((rows(0, 20, "a"), 16), (rows(0, 20, "a"), 32), (rows(10, 30, "b"), 8)):
        got = upsert_table(spark, path, part, buckets=buckets)
        counts.append(sorted((r._action, r["count"]) for r in got.groupBy("_action").count().collect()))
    assert counts == [[("inserted", 20)], [("unchanged", 20)], [("inserted", 10), ("updated", 10)]]
    stored = spark.read.parquet(path)
    assert stored.count() == 30 == stored.select("_key").distinct().count()
    assert stored.filter(F.col("_content_hash") == "b").count() == 20


def test_shared_view_follows_what_a_batch_changes(spark, tmp_path):
    rng = random.Random(2)
    state, view = SeenTable(spark, str(tmp_path / "seen"), 4), SharedView(spark, str(tmp_path / "shared"), 4)
    now: dict[tuple[str, str], str] = {}
    for n in range(3):
        part = {(rng.choice("ab"), f"/u/{rng.randint(0, 15)}"): rng.choice(["", "h1", "h2", "h3"]) for _ in range(12)}
        rows = [(b, u, h, T0) for (b, u), h in part.items()]
        fold_batch(spark.createDataFrame(rows, SEEN), state, view, n)
        now |= part
        held: dict[tuple[str, str], list[str]] = {}
        for (b, u), h in now.items():
            held.setdefault((b, h), []).append(u)
        want = sorted((b, h, len(us), min(us), max(us)) for (b, h), us in held.items() if h and len(us) > 1)
        assert sorted(map(tuple, view.shared(n).collect())) == want


def test_cuts_of_a_scope_pass(spark):
    with passing_cuts(spark):
        inside, n = cut_counted(spark.range(7))
        assert n == 7 == inside.count()
    outside = cut_lineage(spark.range(3))
    assert outside.count() == 3
    with pytest.raises(Exception, match="(?i)not.exist"):
        spark.read.schema("id long").parquet(inside.inputFiles()[0]).count()
