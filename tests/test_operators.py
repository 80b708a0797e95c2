"""Operators against brute force in plain Python, with hot keys cut into buckets."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.operators import search
from folioflow.operators.discovery import (
    changed_since,
    expand_pages,
    filter_urls_by_table,
    first_seen,
    follow_next,
    reachable,
    seed,
    seed_pages,
)
from folioflow.operators.lake import fetch_items, list_items, split_rejects, upsert_items, write_routed
from folioflow.operators.ordering import rank_rows, running_sum
from folioflow.operators.quality import (
    annotate_missing,
    assign_file_names,
    detect_changes,
    drop_unchanged,
    latest_state,
    upsert_state,
    with_hash_and_key,
)
from folioflow.rules import SiteRules, default_rules, rule_tables
from folioflow.sources.items import read_items, write_items
from folioflow.sources.sitemap import read_sitemap_files, sitemap_urls

T0 = datetime(2024, 1, 1)


def items_of(spark, rows):
    schema = (
        "title string, body string, source_url string, canonical_url string, brand string, content_type string, "
        "date_published string, _scraped_at timestamp"
    )
    base = {
        "title": "Headline",
        "body": "<p>Text</p>",
        "source_url": "https://desk.example.org/a/one",
        "canonical_url": "https://desk.example.org/a/one",
        "brand": "desk",
        "content_type": "article",
        "date_published": "2024-05-06",
        "_scraped_at": T0,
    }
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def test_missing_fields_annotated_not_dropped(spark):
    got = annotate_missing(items_of(spark, [{}, {"title": None}, {"body": ""}, {"title": None, "body": None, "source_url": None}]))
    assert [r._missing_fields for r in got.collect()] == [None, ["title"], ["body"], ["title", "body", "source_url"]]


def test_new_unchanged_updated(spark):
    hours = [T0 + timedelta(hours=h) for h in range(5)]
    rows = [{"body": b, "_scraped_at": t} for b, t in zip(["a", "a", "b", "a", ""], hours)]
    rows += [{"source_url": "", "canonical_url": ""}, {"source_url": "", "canonical_url": ""}]
    got = detect_changes(with_hash_and_key(items_of(spark, rows)))
    assert [r._change for r in got.filter("_key <> ''").orderBy("_scraped_at").collect()] == [
        "new", "unchanged", "updated", "updated", "updated",
    ]
    assert [r._change for r in got.filter("_key = ''").collect()] == ["new", "new"]
    assert drop_unchanged(got).count() == 6


def _brute_changes(rows, seen):
    state, out = dict(seen), {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[4], r[5])):
        row_id, brand, key, hash_ = r[0], r[1], r[2], r[3]
        if not key:
            out[row_id] = "new"
            continue
        before = state.get((brand, key))
        out[row_id] = "new" if before is None else "unchanged" if before == hash_ else "updated"
        state[(brand, key)] = hash_
    return out, state


@pytest.mark.parametrize("hot_rows", [3, 60, 1_000_000])
def test_changes_with_one_key_holding_most_rows(spark, hot_rows):
    rng = random.Random(hot_rows)
    rows = []
    for i in range(3000):
        key = "/hot" if rng.random() < 0.5 else f"/k{rng.randint(0, 300)}" if rng.random() < 0.9 else ""
        # Many rows of the hot key share one time stamp.
        at = T0 + timedelta(minutes=rng.choice([5, 5, 5, rng.randint(0, 50)]))
        rows.append((i, "b", key, rng.choice("ABC"), at, i))
    seen = {("b", "/hot"): "A", ("b", "/k1"): "B", ("b", "/k2"): "C", ("b", "/never"): "A", ("x", "/k3"): "A"}
    items = spark.createDataFrame(rows, "id int, brand string, _key string, _content_hash string, at timestamp, n int")
    state = spark.createDataFrame(
        [(b, u, h, T0) for (b, u), h in seen.items()], "brand string, url string, content_hash string, seen_at timestamp"
    )
    want, after = _brute_changes(rows, seen)
    got = detect_changes(items, state, order=("at", "n"), hot_rows=hot_rows)
    assert {r.id: r._change for r in got.collect()} == want
    newer = latest_state(items, order=("at", "n"), seen_at="at")
    merged = {(r.brand, r.url): r.content_hash for r in upsert_state(state, newer).collect()}
    assert merged == after


@pytest.mark.parametrize("hot_rows", [2, 50, 1_000_000])
def test_rank_and_running_sum(spark, hot_rows):
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.randint(0, 3), i, rng.randint(0, 9)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, k string, t int, n int, v int")
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        groups[r[1]].append(r)
    ranks = {r[0]: i for g in groups.values() for i, r in enumerate(g, 1)}
    sums = {r[0]: sum(x[4] for x in g[: i + 1]) for g in groups.values() for i, r in enumerate(g)}
    assert {r.id: r.rank for r in rank_rows(df, ["k"], ["t", "n"], "rank", hot_rows).collect()} == ranks
    assert {r.id: r.s for r in running_sum(df, ["k"], ["t", "n"], F.col("v"), "s", hot_rows).collect()} == sums


def test_file_names_fill_free_numbers(spark):
    name = "desk_article_20240506_one"
    rows = [{"_scraped_at": T0 + timedelta(minutes=i)} for i in range(6)]
    rows += [{"date_published": None}, {"source_url": "https://desk.example.org/", "brand": None}]
    rows += [{"source_url": None, "canonical_url": "https://x.org/b/Two Words.html"}]
    items = items_of(spark, rows)
    taken = [f"{name}.json", f"{name}_2.json", f"{name}_3.json", f"{name}_7.json", "desk_article_20240506_other_1.json"]
    for existing, numbers in ((None, [0, 1, 2, 3, 4, 5]), (taken, [1, 4, 5, 6, 8, 9])):
        used = spark.createDataFrame([(t,) for t in existing], "file_name string") if existing else None
        got = [r.file_name for r in assign_file_names(items, used, hot_rows=2 if existing else 10**6).collect()]
        want = [f"{name}_{n}.json" if n else f"{name}.json" for n in numbers]
        want += ["desk_article_20240101_one.json", "unknown_article_20240506_index.json", "desk_article_20240506_two-words-html.json"]
        assert sorted(got) == sorted(want)


def test_items_written_and_read_back(spark, tmp_path):
    items = items_of(spark, [{"title": "Zürich & <b>"}, {"title": None, "brand": "other"}])
    items = annotate_missing(with_hash_and_key(items)).drop("_key").withColumn("file_name", F.lit("f.json"))
    path = str(tmp_path / "items")
    write_items(items, path)
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "items").rglob("*.json"))
    assert "Zürich & <b>" in text and "metadata" not in text and "2024-01-01T00:00:00.000000+00:00" in text
    back = read_items(spark, path, multi_line=False)
    assert sorted((r.brand, r.title) for r in back.collect()) == [("desk", "Zürich & <b>"), ("other", None)]
    assert {r._scraped_at for r in back.collect()} == {T0}
    pretty = tmp_path / "one.json"
    pretty.write_text('{\n  "title": "T",\n  "categories": ["a", "b"],\n  "images": [{"url": "u", "alt": "", "caption": "c"}]\n}')
    row = read_items(spark, str(pretty)).first()
    assert row.title == "T" and row.categories == ["a", "b"] and row.images[0].caption == "c" and row.body is None


def test_sitemaps(spark, tmp_path):
    one = '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://a.org/1 </loc><lastmod>2024-01-02</lastmod><priority>0.5</priority></url><url><loc/></url></urlset>'
    maps = [("s", one), ("p", one.replace("<", "<x:").replace("<x:/", "</x:").replace("<x:?", "<?").replace("xmlns=", "xmlns:x=")), ("bad", "<urlset><url>"), ("none", "")]
    got = sitemap_urls(spark.createDataFrame(maps, "site string, xml string")).collect()
    assert [(r.site, r.loc, r.lastmod, r.priority) for r in got] == [(s, "https://a.org/1", "2024-01-02", 0.5) for s in "sp"]
    (tmp_path / "m.xml").write_text(one)
    assert [r.loc for r in read_sitemap_files(spark, str(tmp_path)).collect()] == ["https://a.org/1"]
    seen = spark.createDataFrame([("https://a.org/1", datetime(2024, 1, 2, 5))], "url string, seen_at timestamp")
    urls = spark.createDataFrame(
        [("https://a.org/1", "2024-01-02"), ("https://a.org/1", "2024-01-03T00:00:00Z"), ("https://a.org/2", None)],
        "url string, lastmod string",
    )
    kept = {(r.url, r.lastmod) for r in changed_since(urls, seen).collect()}
    assert kept == {("https://a.org/1", "2024-01-03T00:00:00Z"), ("https://a.org/2", None)}


def test_page_ranges(spark):
    rules = {"s": SiteRules("s", last_page_selector="a"), "n": SiteRules("n")}
    rows = [
        ("s", "https://h.org/l", "?page=2"), ("s", "https://h.org/m?x=1", "https://h.org/m?page=25001"), ("s", "https://h.org/a", "?page=x"),
        ("s", "https://h.org/b", None), ("s", "https://h.org/c", "?page=0"), ("n", "https://h.org/d", "?page=3"),
        ("s", "https://h.org/e?page=1&y=2", "#end"), ("s", "https://h.org/f", "?page=-4"),
    ]
    df = spark.createDataFrame(rows, "site string, url string, last string")
    got = expand_pages(df, rules)
    urls = {r.url for r in got.filter("from_url not like '%/m?%'").collect()}
    assert urls == {"https://h.org/l?page=1", "https://h.org/l?page=2", "https://h.org/e?page=1&y=2"}
    long = got.filter("from_url like '%/m?%'").agg(F.count("*"), F.countDistinct("url"), F.min("page_no"), F.max("page_no"), F.max("url")).first()
    assert tuple(long)[:4] == (25001, 25001, 1, 25001) and long[4].startswith("https://h.org/m?x=1&page=")


def test_graph_walks(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(41, 20), (99, 98), (98, 99)]
    df = spark.createDataFrame([("s", str(a), str(b)) for a, b in edges], "site string, from_url string, url string")
    seeds = spark.createDataFrame(
        [("s", "0", 0, "zero"), ("s", "41", 1, "side"), ("s", "99", 2, "loop")],
        "site string, url string, ord int, listing_category string",
    )
    got = {int(r.url): (r.listing_category, r.depth) for r in follow_next(seeds, df).collect()}
    want = {i: ("zero", i) for i in range(20)} | {i: ("side", i - 19) for i in range(20, 41)}
    assert got == want | {41: ("side", 0), 99: ("loop", 0), 98: ("loop", 1)}
    assert {int(r.url) for r in follow_next(seeds.filter("ord = 0"), df, max_steps=3).collect()} == {0, 1, 2, 3}

    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(70)]
    depth, frontier = {0: 0}, [0]
    for level in range(1, 6):
        frontier = sorted({b for a, b in links if a in frontier} - set(depth))
        depth |= {n: level for n in frontier}
    df = spark.createDataFrame([("s", str(a), str(b)) for a, b in links], "site string, from_url string, url string")
    start = spark.createDataFrame([("s", "0")], "site string, url string")
    assert {int(r.url): r.depth for r in reachable(start, df, max_depth=5).collect()} == depth


def test_link_rules(spark):
    rules = default_rules()
    tables = rule_tables(spark, rules)
    assert tables["entry_points"].count() == sum(len(r.entry_points) for r in rules.values())
    urls = [
        ("iaum", "https://insuranceaum.com/some-article", True), ("iaum", "https://insuranceaum.com/user/login", False),
        ("iaum", "https://insuranceaum.com/events", False), ("iaum", "https://elsewhere.org/article", False),
        ("itl", "https://www.insurancethoughtleadership.com/cyber/x?utm_source=a", False),
        ("rih", "https://riskandinsurance.com/an-article/", True), ("rih", "https://riskandinsurance.com/a/b/", False),
        ("clm", "https://www.theclm.org/Magazine/articles/title/123", True), ("nobody", "https://x.org/", True),
    ]
    df = spark.createDataFrame(urls, "site string, url string, ok boolean")
    assert {r.url for r in filter_urls_by_table(df, tables["url_rules"]).collect()} == {u for _, u, ok in urls if ok}
    seeds = seed(spark, rules)
    assert {(r.site, r.route): r.n for r in seeds.groupBy("site", "route").agg(F.count("*").alias("n")).collect()} == {
        ("clm", "listing"): 18, ("clm", "archive"): 1, ("griffith", "listing"): 3, ("iasa", "listing"): 2, ("iaum", "sitemap"): 1,
        ("iis", "listing"): 1, ("itl", "listing"): 8, ("rih", "listing"): 9, ("ti", "sitemap"): 1,
    }
    stored = seeds.filter("site = 'clm'").select("site", "url").unionByName(df.select("site", "url"))
    assert seed_pages(stored, rules).count() == 19
    links = spark.createDataFrame(
        [("s", "u", "late", 5, 0), ("s", "u", "early", 1, 3), ("s", "v", "x", 2, 0)],
        "site string, url string, listing_category string, ord int, pos int",
    )
    assert {(r.url, r.listing_category) for r in first_seen(links).collect()} == {("u", "early"), ("v", "x")}
    with pytest.raises(KeyError):
        default_rules(["unknown"])


def test_lake(spark, tmp_path):
    rows = [{"body": "a"}, {"source_url": "/2", "body": "x"}, {"source_url": "/2", "body": "y", "_scraped_at": T0 + timedelta(hours=1)}]
    first = with_hash_and_key(items_of(spark, rows)).drop("_key")
    lake = upsert_items(first.limit(0), first)
    assert {(r.source_url[-1], r.body, r._action) for r in lake.collect()} == {("e", "a", "inserted"), ("2", "y", "inserted")}
    lake = lake.drop("_action")
    again = upsert_items(lake, first)
    assert {r._action for r in again.collect()} == {"unchanged"}
    more = with_hash_and_key(items_of(spark, [{"body": "b", "_scraped_at": T0 + timedelta(days=1)}])).drop("_key")
    assert {(r.body, r._action) for r in upsert_items(lake, more).collect()} == {("b", "updated"), ("y", "kept")}

    mixed = annotate_missing(items_of(spark, [{}, {"title": ""}, {"source_url": None, "canonical_url": None}]))
    good, bad = split_rejects(mixed)
    assert good.count() == 1 and sorted(r._reject_reason for r in bad.collect()) == ["missing: title", "no key"]
    write_routed(mixed, str(tmp_path / "routed"))
    assert spark.read.parquet(str(tmp_path / "routed" / "route=rejected")).count() == 2
    shelf = items_of(spark, [{"date_published": f"2024-0{m}-01", "source_url": f"/{m}"} for m in range(1, 6)])
    shelf = shelf.withColumns({"author": F.lit("A"), "category": F.lit("C"), "categories": F.array(F.lit("D"))})
    hits = list_items(shelf, brand="desk", category="D", author="A", published_from="2024-02-01", published_to="2024-04-30", limit=2)
    assert [r.source_url for r in hits.collect()] == ["/4", "/3"]
    assert fetch_items(shelf, ["/1", "/9"]).count() == 1


@pytest.mark.parametrize("most", [1000, 3])
def test_search(spark, monkeypatch, most):
    monkeypatch.setattr(search, "MAX_QUERIES", most)
    monkeypatch.setattr(search, "MAX_TERMS", 4 if most == 3 else 20_000)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(200, 8))
    vectors[50] = vectors[20]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id int, embedding array<double>")
    queries = table.filter("vec_id < 7").withColumnRenamed("vec_id", "query_id")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = np.round(unit[:7] @ unit.T, 6)
    want = {q: [int(i) for i in np.lexsort((np.arange(200), -scores[q]))[:5]] for q in range(7)}
    got = defaultdict(list)
    for r in search.search_vector(table, queries, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.doc_id)
    assert got == want

    words = "alpha beta gamma delta rho sigma tau".split()
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 9))) for _ in range(60)] + ["", "Alpha, ALPHA!"]
    asked = ["alpha beta", "tau", "nothing here", "rho rho sigma", "delta gamma alpha"]
    counts = [defaultdict(int) for _ in texts]
    for c, t in zip(counts, texts):
        for w in t.lower().replace(",", "").replace("!", "").split():
            c[w] += 1
    df = {w: sum(1 for c in counts if c.get(w)) for w in words}
    best = {}
    for q, text in enumerate(asked):
        points = [
            (-round(sum((1 + np.log(c[w])) * np.log(len(texts) / df[w]) for w in set(text.split()) if c.get(w)), 6), i)
            for i, c in enumerate(counts)
        ]
        best[q] = [i for s, i in sorted(points) if s < 0][:4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = search.search_text(docs, spark.createDataFrame(list(enumerate(asked)), "query_id int, text string"), 4)
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.doc_id)
    assert got == {q: ids for q, ids in best.items() if ids}
