"""Whole runs over stored pages of all built-in sites; stream against batch; replay."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioflow import job, schemas
from folioflow.plans.site_run import RunStore, run_batch, run_sites
from folioflow.rules import default_rules
from folioflow.sources.items import read_items
from folioflow.sources.pages import with_site
from folioflow.streaming.flow import read_page_stream, run_stream

T0 = datetime(2024, 6, 1)
ITL, CLM, RIH = "https://www.insurancethoughtleadership.com", "https://www.theclm.org", "https://riskandinsurance.com"
IIS, GRI, IASA = "https://www.internationalinsurance.org", "https://www.griffithfoundation.org", "https://www.iasa.org"
IAUM, TI = "https://insuranceaum.com", "https://web.theinstitutes.org"


def ld(**fields):
    return f'<script type="application/ld+json">{json.dumps(fields)}</script>'


def itl_list(hrefs, last=None):
    links = "".join(f'<h5><a href="{h}">x</a></h5>' for h in hrefs)
    pager = f'<li class="pager__item pager__item--last"><a href="{last}">Last</a></li>' if last else ""
    return f'<div class="region-content">{links}</div><h5><a href="/outside">o</a></h5>{pager}'


def article_itl(title, body="Text of the article"):
    return (
        ld(**{"@type": "Article", "headline": title, "author": {"name": " Jane Doe "}, "datePublished": "2024-03-04T10:00:00-05:00",
              "publisher": {"name": "Desk"}, "url": f"{ITL}/canonical"})
        + '<nav class="breadcrumb"><ol><li><a>Home</a></li><li><a>AI &amp; Data</a></li></ol></nav>'
        + f'<h1 class="page-title">DOM title</h1><div class="article__body"><p>{body}</p><script>track()</script>'
        + '<figure><img src="/i.jpg" alt="Alt"><figcaption>Cap</figcaption></figure></div>'
    )


def site_pages():
    pages = {
        f"{ITL}/cyber": itl_list(["/cyber/one", "/cyber/two", "/user/login"], "?page=2"),
        f"{ITL}/cyber?page=1": itl_list(["/cyber/three"]),
        f"{ITL}/cyber?page=2": itl_list(["/cyber/one", "/cyber/missing"]),
        f"{ITL}/cyber?page=3": itl_list(["/cyber/unlinked"]),
        f"{ITL}/cyber/one": article_itl("One"),
        f"{ITL}/cyber/two": article_itl("Two"),
        f"{ITL}/cyber/three": "<h1 class=page-title>Bare</h1>",
        f"{ITL}/cyber/unlinked": article_itl("Unlinked"),
        f"{CLM}/Magazine/Home/Archive": '<div id="archive_editions"><a href="Editions/1">1</a><a href="Editions/1">1</a></div>',
        f"{CLM}/Magazine/Home/Editions/1": '<a class="article-link" href="/Magazine/articles/a-b/7">x</a>',
        f"{CLM}/Magazine/articles/a-b/7": '<div class="col-12 card-text"><div>d<span class="artdate"> May 6, 2024 </span></div><div>s</div><div>Third <p>body</p></div></div>'
        '<h1 class="article-link">Clm title</h1>',
        f"{RIH}/category/risk-matrix/": f'<a href="{RIH}/story-a/"><h3 class="splash">A</h3></a><a href="{RIH}/other/">o</a><a class="next page-numbers" href="page/2/">n</a>',
        f"{RIH}/category/risk-matrix/page/2/": f'<a href="/story-b/"><h3 class="splash">B</h3></a><a class="next page-numbers" href="/category/risk-matrix/page/3/">n</a>',
        f"{RIH}/category/risk-matrix/page/3/": f'<a href="/story-a/"><h3 class="splash">A</h3></a><a class="next page-numbers" href="/category/risk-matrix/">n</a>',
        f"{RIH}/story-a/": ld(**{"@graph": [{"@type": "WebPage", "datePublished": "2024-01-02"}]})
        + '<article class="format-main-article"><h1>Story A</h1><div class="contents"><p>a</p></div><div class="categories"><a>Cat 1</a><a>Cat 2</a></div></article>',
        f"{RIH}/story-b/": '<article class="format-main-article"><h1>Story B</h1></article>',
        f"{IIS}/insights-research-1": '<a class="topic-grid-block__item" href="/paper">x</a>',
        f"{IIS}/paper": '<h1 class="post-title"> <span>Paper</span></h1><span property="schema:dateCreated" content="2023-02-03T00:00:00+00:00">x</span>'
        '<div class="field--name-body field__item">B</div><div class="field--name-field-topics"><p class="field__item"><a>T1</a></p></div>'
        '<div class="field--name-field-tags"><p class="field__item"><a>T1</a><a> G2 </a></p></div>',
        f"{GRI}/news": '<h2><a href="/news/skipped">t</a></h2><p><a href="/news/item">Read More</a></p>',
        f"{GRI}/news/item": ld(**{"@type": "Article", "headline": "Griffith", "author": {"name": "Org"}})
        + '<article><div class="sqs-block-content">g</div></article>',
        f"{IASA}/IASA/IASA/Insights/News/News.aspx": '<div id="mainContentWrapper"><a href="/IASA/IASA/Insights/News/Item.aspx">x</a><a href="News.aspx">n</a></div>',
        f"{IASA}/IASA/IASA/Insights/News/Item.aspx": '<div id="mainContentWrapper"><h2>Iasa title</h2>text</div>',
        f"{IAUM}/sitemap.xml": f"<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><url><loc>{IAUM}/funds</loc></url><url><loc>{IAUM}/events</loc></url></urlset>",
        f"{IAUM}/funds": ld(**{"@type": "NewsArticle", "name": "Funds", "@id": f"{IAUM}/id", "about": ["Alternatives", "ESG"], "description": "D", "datePublished": "2024-02-02"})
        + '<article><div class="field--name-body">text <img data-src="/lazy.png" alt="L"></div></article>',
        f"{TI}/sitemap.xml": f"<urlset><url><loc> {TI}/ceu/course </loc></url><url><loc>{TI}/other/x</loc></url></urlset>",
        f"{TI}/ceu/course": '<h1 class="hero__title">Course</h1><div id="block-ti-west-content">c</div>',
        "https://unknown.example.org/x": "<h1>No site</h1>",
    }
    return list(pages.items())


def frame(spark, pages, at=T0, start=0):
    rows = [(start + i, None, u, h, at) for i, (u, h) in enumerate(pages)]
    return with_site(spark.createDataFrame(rows, schemas.PAGES), default_rules()).select(*schemas.PAGES.names)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("library"))
    path = run_sites(frame(spark, site_pages()), default_rules(), root)
    return root, {r.source_url: r.asDict(recursive=True) for r in read_items(spark, path, multi_line=False).collect()}


def test_articles_found_over_all_routes(run):
    assert set(run[1]) == {
        f"{ITL}/cyber/one", f"{ITL}/cyber/two", f"{ITL}/cyber/three", f"{CLM}/Magazine/articles/a-b/7", f"{RIH}/story-a/",
        f"{RIH}/story-b/", f"{IIS}/paper", f"{GRI}/news/item", f"{IASA}/IASA/IASA/Insights/News/Item.aspx", f"{IAUM}/funds", f"{TI}/ceu/course",
    }


def test_item_fields(run):
    got = run[1]

    def check(url, **want):
        assert {k: got[url][k] for k in want} == want

    body = "<html><body><div class=\"article__body\"><p>Text of the article</p><figure><img src=\"/i.jpg\" alt=\"Alt\"/><figcaption>Cap</figcaption></figure></div></body></html>"
    check(
        f"{ITL}/cyber/one", title="One", author="Jane Doe", date_published="2024-03-04", canonical_url=f"{ITL}/canonical", brand="itl",
        content_type="article", category="AI & Data", categories=["AI & Data"], publisher="Desk", body=body, _missing_fields=None,
        images=[{"url": f"{ITL}/i.jpg", "alt": "Alt", "caption": "Cap"}], file_name="itl_article_20240304_one.json",
    )
    check(f"{ITL}/cyber/three", title="Bare", category="Cyber", categories=None, _missing_fields=["body"], _content_hash="", canonical_url=f"{ITL}/cyber/three")
    check(f"{CLM}/Magazine/articles/a-b/7", title="Clm title", date_published="2024-05-06", category="Archive", categories=["Archive"], publisher="The CLM",
          body="<html><body><div>Third <p>body</p></div></body></html>", images=None)
    check(f"{RIH}/story-a/", title="Story A", date_published="2024-01-02", category="Cat 1", categories=["Cat 1", "Cat 2"], publisher="Risk & Insurance")
    check(f"{RIH}/story-b/", category="Risk Matrix", categories=["Risk Matrix"], _missing_fields=["body"])
    check(f"{IIS}/paper", title="Paper", date_published="2023-02-03", category="T1", categories=["T1", "G2"], publisher="International Insurance Society")
    check(f"{GRI}/news/item", title="Griffith", author="Org", category="News", categories=["News"], publisher=None)
    check(f"{IASA}/IASA/IASA/Insights/News/Item.aspx", title="Iasa title", category="IASA News", categories=["IASA News"], publisher=None)
    check(f"{IAUM}/funds", title="Funds", canonical_url=f"{IAUM}/id", category="Alternatives", categories=["Alternatives", "ESG"], description="D",
          images=[{"url": f"{IAUM}/lazy.png", "alt": "L", "caption": ""}])
    check(f"{TI}/ceu/course", title="Course", category="CEU", categories=None, publisher="The Institutes", date_published=None,
          file_name="ti_article_20240601_course.json")


def test_job_and_dry_run(spark, tmp_path, capsys):
    wanted = [(u, h) for u, h in site_pages() if u.startswith((IASA, CLM))]
    frame(spark, wanted).drop("site").write.parquet(str(tmp_path / "pages"))
    common = ["--pages", str(tmp_path / "pages"), "--root", str(tmp_path / "lib"), "--sites", "iasa,clm"]
    job.main(["discover", *common])
    shown = capsys.readouterr().out
    assert "2 URLs in 2 listings" in shown
    report = spark.read.parquet(str(tmp_path / "lib" / "discovered" / "batch=0")).collect()
    assert {r.from_url.rsplit("/", 1)[-1] for r in report} == {"1", "News.aspx"}
    job.main(["run", *common, "--batch", "3"])
    path = capsys.readouterr().out.strip().splitlines()[-1]
    assert {r.brand for r in read_items(spark, path, multi_line=False).collect()} == {"iasa", "clm"}


def test_next_run_only_writes_what_changed(spark, run):
    root, rules = run[0], default_rules()
    changed = [(u, article_itl("Two", "New text") if u.endswith("/two") else h) for u, h in site_pages()]
    path = run_sites(frame(spark, changed, T0 + timedelta(days=1)), rules, root, batch=1)
    assert [(r.source_url, r.file_name) for r in read_items(spark, path, multi_line=False).collect()] == [
        (f"{ITL}/cyber/two", "itl_article_20240304_two_1.json")
    ]
    # The same batch again gives the same output and state.
    run_sites(frame(spark, changed, T0 + timedelta(days=1)), rules, root, batch=1)
    assert read_items(spark, path, multi_line=False).count() == 1
    store = RunStore(spark, root)
    before = sorted(tuple(r) for r in store.seen.before(2).collect())
    store.compact(1)
    assert sorted(tuple(r) for r in store.seen.before(2).collect()) == before and len(before) == 11
    path = run_sites(frame(spark, changed, T0 + timedelta(days=2)), rules, root, batch=2)
    assert read_items(spark, path, multi_line=False).isEmpty()


def _versions():
    """Three arrivals of article pages: first seen, then partly changed, then back again."""
    urls = [f"{ITL}/cyber/v{i}" for i in range(6)]
    first = [(u, article_itl(u)) for u in urls]
    second = [(u, article_itl(u, "changed" if i % 2 else "Text of the article")) for i, u in enumerate(urls)] + [(f"{ITL}/user/login", "x")]
    return [first, second, first]


def _written(spark, root, batches):
    out = []
    for b in batches:
        rows = read_items(spark, RunStore(spark, root).items(b), multi_line=False)
        out += [(r.source_url, r._content_hash, r.file_name) for r in rows.collect()]
    return sorted(out)


def test_stream_equals_batches_and_survives_replay(spark, tmp_path):
    rules, landing = default_rules(["itl"]), tmp_path / "landing"
    for n, pages in enumerate(_versions()):
        batch = frame(spark, pages, T0 + timedelta(days=n), n * 100).coalesce(1)
        batch.write.mode("append").parquet(str(landing))
        source = read_page_stream(spark, str(landing), max_files=1)
        query = run_stream(source, rules, str(tmp_path / "stream"))
        query.awaitTermination()
        run_batch(batch, rules, RunStore(spark, str(tmp_path / "batch")), n, crawl_links=False)
    assert _written(spark, str(tmp_path / "stream"), range(3)) == _written(spark, str(tmp_path / "batch"), range(3))
    assert len(_written(spark, str(tmp_path / "batch"), range(3))) == 6 + 3 + 3

    store = RunStore(spark, str(tmp_path / "stream"))
    state = sorted((r.url, r.content_hash) for r in store.seen.before(3).collect())
    items = _written(spark, store.root, [2])
    run_batch(frame(spark, _versions()[2], T0 + timedelta(days=2), 200), rules, store, 2, crawl_links=False)
    assert sorted((r.url, r.content_hash) for r in store.seen.before(3).collect()) == state
    assert _written(spark, store.root, [2]) == items


def test_several_versions_in_one_batch_and_captcha_skip(spark, tmp_path):
    rules, store = default_rules(["itl"]), RunStore(spark, str(tmp_path / "s"))
    parts = [frame(spark, p, T0 + timedelta(days=n), n * 100) for n, p in enumerate(_versions())]
    wall = frame(spark, [(f"{ITL}/cyber/wall", "<p>Please solve the CAPTCHA")], T0, 900)
    pages = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(wall)
    run_batch(pages, rules, store, 0, crawl_links=False, skip_captcha=True)
    items = read_items(spark, store.items(0), multi_line=False)
    assert items.count() == 12 and items.filter(F.col("source_url").endswith("wall")).isEmpty()
    assert items.filter(F.col("file_name").endswith("_2.json")).count() == 3


def test_sitemap_check_builds_maps_of_bounded_size(spark, tmp_path, monkeypatch):
    """No more than ``MAP_EVENTS`` entries stand in one sitemap, and the counts are those of all of them."""
    from folioflow.checks import runs

    rows = [(i, i % 7) for i in range(4000)]
    spark.createDataFrame(rows, "event_id long, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    sizes = []

    def watched(maps, rules):
        sizes.extend(r[0].count("<loc>") for r in maps.select("xml").collect())
        return site_run._map_links(maps, rules)

    from folioflow.plans import site_run

    monkeypatch.setattr(runs, "_map_links", watched)
    got = {r.site: r.n_links for r in runs.q_sitemap_repeats(spark, str(tmp_path)).collect()}
    assert got == {"all": sum(u % 2 == 0 for _, u in rows), "once": 3}
    assert sum(sizes) == 4000 and max(sizes) <= runs.MAP_EVENTS
