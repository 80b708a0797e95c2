"""The DOM helper on broken and hostile markup, and the DOM job."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from folioflow.functions.dom import Document, Selector, all_text, attr_values, clean_markup, own_texts, raw_images, text_of
from folioflow.operators.extraction import Take, dom_select


def pick(html, selector):
    return Document(html).select(Selector(selector))


@pytest.mark.parametrize(
    "selector, expected",
    [
        ("p", ["1", "2", "3"]),
        ("div > p", ["1", "3"]),
        ("div p", ["1", "2", "3"]),
        (".x.y", ["2"]),
        ("#m .y", ["2"]),
        ("p[data-k]", ["1", "3"]),
        ("p[data-k='b']", ["3"]),
        ('p[data-k*="a"]', ["1"]),
        ("p[data-k^=b], .y", ["2", "3"]),
        (".y, p[data-k]", ["1", "2", "3"]),
        ("div > *:nth-of-type(2)", ["3"]),
        ("section > p.y", ["2"]),
        ("table p", []),
    ],
)
def test_selectors(selector, expected):
    html = "<div id=m><p data-k='xa'>1</p><section><p class=' x  y '>2</p></section><p DATA-K=b>3</p></div>"
    assert [all_text(n) for n in pick(html, selector)] == expected


def test_selector_not_supported():
    with pytest.raises(ValueError):
        Selector("a:hover")


def test_implied_ends():
    assert [all_text(n) for n in pick("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul > li")] == ["a", "bc", "c", "d"]
    assert len(pick("<p><b>x<br><p>y</p>", "p > p")) == 0
    assert [all_text(n) for n in pick("<table><tr><td>a<td>b<tr><td>c</table>", "tr")] == ["ab", "c"]
    assert [all_text(n) for n in pick("<div><span>a</div>b</span>c", "div")] == ["a"]
    assert [all_text(n) for n in pick("<b><div>x</b>y</div>z", "div")] == ["xy"]
    assert [all_text(n) for n in pick("<h1>a &amp; b < c</h1>", "h1")] == ["a & b < c"]
    assert attr_values(pick("<a href='/x?a=1&amp;b=2' title=it's>k</a>", "a"), "href") == ["/x?a=1&b=2"]
    assert [all_text(n) for n in pick("<script>'<p>no</p>'</script><p>yes</p>", "p")] == ["yes"]


def test_text_choice():
    assert text_of(pick("<h1> <i>in</i> own </h1>", "h1")) == "own"
    assert text_of(pick("<h1> <i> in </i> <b>more</b></h1>", "h1")) == "inmore"
    assert text_of(pick("<h1></h1>", "h1")) is None
    assert own_texts(pick("<a> Home </a><a></a><a>X<b>y</b>Z</a>", "a")) == ["Home", "X", "Z"]


def test_clean_markup():
    html = "<div class=\"a\" data-q='say \"x\"'><nav>m</nav>t &lt;1&gt;<!-- c --><img src=x><p>é<aside>s</aside></div>"
    expected = '<html><body><div class="a" data-q=\'say "x"\'>t &lt;1&gt;<img src="x"/><p>é</p></div></body></html>'
    assert clean_markup(pick(html, "div")[0]) == expected
    assert clean_markup(pick("<header>x</header>", "header")[0]) == "<html><body></body></html>"


def test_images():
    html = (
        "<figure><div id=b><img src='/1.png' alt=' A '><figure><p><img data-src=2.png></p><figcaption>C <i>d</i></figcaption>"
        "</figure><img alt=none><figcaption>outer</figcaption></div></figure>"
    )
    box = pick(html, "#b")[0]
    assert raw_images(box) == [
        {"src": "/1.png", "data-src": None, "alt": " A ", "caption": ""},
        {"src": None, "data-src": "2.png", "alt": None, "caption": "Cd"},
        {"src": None, "data-src": None, "alt": "none", "caption": ""},
    ]


def test_image_columns(spark):
    html = "<div id=b><img src='/1.png' alt=' A '><img data-src=2.png><img alt=none></div>"
    pages = spark.createDataFrame([("a", html), ("b", html), ("a", "<p>"), ("a", None)], "site string, html string")
    pages = pages.withColumn("url", F.lit("https://h.org/p/q"))
    fields = {
        "a": {"images": Take("images", "#b", lazy=True)},
        "b": {"images": Take("images", "#b", base_url="https://o.org/")},
    }
    rows = dom_select(pages, fields).select("site", F.col("dom.images").alias("i")).collect()
    found = {(r.site, i): [tuple(x) for x in r.i or []] for i, r in enumerate(rows)}
    assert found == {
        ("a", 0): [("https://h.org/1.png", "A", ""), ("https://h.org/p/2.png", "", "")],
        ("b", 1): [("https://o.org/1.png", "A", "")],
        ("a", 2): [],
        ("a", 3): [],
    }


@pytest.mark.parametrize(
    "piece", ["<a ", '<a ="', "<!--", "<div>", "<script>", "<p><b>", "</p>", "< ", "<li>", "<td>", "<a href='x", "&amp", "<ul><li>"]
)
def test_hostile_markup_takes_linear_time(piece):
    start = time.time()
    clean_markup(Document(piece * 50_000 + "<p>end</p>").root)
    assert time.time() - start < 20


def test_deep_nesting_keeps_text():
    doc = Document("<div>" * 3000 + "deep" + "</div>" * 3000)
    assert "deep" in clean_markup(doc.root)
    doc = Document("<div>" * 1500 + "<ul><li><b>x</b></li></ul>" + "</div>" * 1500)
    assert text_of(doc.select(Selector("li > b"))) == "x"


def test_job_parses_once_and_skips_unknown_sites(spark):
    pages = spark.createDataFrame(
        [("a", "u", "<h1>A</h1><i>x</i>"), ("b", "u", "<h2>B</h2>"), ("c", "u", "<h1>C</h1>"), ("a", "u", None)],
        "site string, url string, html string",
    )
    fields = {"a": {"title": Take("text", "h1"), "list": Take("list", "i")}, "b": {"title": Take("text", "h2")}}
    out = dom_select(pages, fields)
    rows = out.filter(F.col("dom.title").isNotNull()).select("site", "dom.title", "dom.list").orderBy("site").collect()
    assert [tuple(r) for r in rows] == [("a", "A", ["x"]), ("b", "B", None)]
    plan = out.filter(F.col("dom.title").isNotNull()).select("dom.list")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_random_markup_never_fails():
    rng = random.Random(11)
    bits = ["<", ">", "</", "/>", "<a", "<p>", "</p>", "<td", "<script>", "</script>", "<!--", "-->", "<!x", "=", "'", '"', " ", "href", "&", ";",
            "&#xD800;", "&#99999999;", "&amp", "é", "\x00", "<title>", "<svg/>", "<br/>", "<li>", "</ul>", "class=x", "text"]
    selectors = [Selector(s) for s in ("a[href], p.x", "td > p", "li:nth-of-type(2)", "*")]
    for _ in range(3000):
        doc = Document("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))))
        clean_markup(doc.root).encode("utf-8")
        for s in selectors:
            text_of(doc.select(s))
