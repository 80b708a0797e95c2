"""URL, text, date and JSON-LD functions against the standard library or fixed cases."""

from __future__ import annotations

import json
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from folioflow.functions import jsonld
from folioflow.functions.normalize import content_hash, is_captcha, item_hash, item_key, normalize_date, publish_date, strip
from folioflow.functions.urls import prefix_category, query_param, resolve_url, set_query_param, url_allowed, url_to_slug


def one_column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").repartition(4)
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_resolve_url_like_the_standard_library(spark):
    rng = random.Random(7)
    parts = ["/", "//", "/a", "/b", "/..", "/.", "/c.d", "a", "..", ".", "/x y", "é", ";p"]

    def path():
        return "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))

    rows = []
    for _ in range(1500):
        base = rng.choice(["http", "https"]) + "://h.org/" + path().lstrip("/") + rng.choice(["", "?q=1", "#f", "?a=b#z"])
        href = rng.choice(["", "", "https:", "mailto:", "//o.org", "//o.org/", "HTTP://X.y/"]) + path()
        rows.append((base, href + rng.choice(["", "?x=1", "#y", "?x#y", "?", "#"])))
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", resolve_url("b", "h").alias("r")).collect()
    wrong = [(r.b, r.h, r.r, urljoin(r.b, r.h)) for r in got if r.r != urljoin(r.b, r.h)]
    assert not wrong, wrong[:5]


def test_set_query_param(spark):
    cases = {
        "https://h.org/l": "https://h.org/l?page=12",
        "https://h.org/l?": "https://h.org/l?page=12",
        "https://h.org/l?a=1": "https://h.org/l?a=1&page=12",
        "https://h.org/l?a=1&a=2": "https://h.org/l?a=1&a=2&page=12",
        "https://h.org/l?a=1&b=x+y&a=1": "https://h.org/l?a=1&a=1&b=x+y&page=12",
        "https://h.org/l?page=3": "https://h.org/l?page=12",
        "https://h.org/l?page=3&a=1&page=4": "https://h.org/l?page=12&a=1",
        "https://h.org/l?a=&z&c=%C3%A9": "https://h.org/l?c=%C3%A9&page=12",
        "https://h.org/l?d=~*&e=a%2Bb&f=\u00e9#p": "https://h.org/l?d=~%2A&e=a%2Bb&f=%C3%A9&page=12",
    }
    got = one_column(spark, list(cases), lambda v: set_query_param(v, "page", F.lit(12)))
    assert dict(zip(cases, got)) == cases
    assert one_column(spark, ["/l?a=1&page=&page=7", "/l", "?page=x"], lambda v: query_param(v, "page")) == ["7", None, "x"]


def test_slug(spark):
    cases = {
        "https://example.com/article/Some-Title_Here/": "some-title-here",
        "https://example.com/": "index",
        "https://example.com": "index",
        "https://example.com/a/b.html?x=1#y": "b-html",
        "https://example.com/a/Ünïcode!!": "n-code",
        "https://example.com/a/page;v=1": "page",
        "https://example.com/" + "x" * 100: "x" * 80,
        "plain/path": "path",
        "": "index",
    }
    assert one_column(spark, list(cases), url_to_slug) == list(cases.values())


def test_dates(spark):
    cases = {
        "2024-11-15T10:00:00-05:00": "2024-11-15", "2024-11-15T23:59:59+0000": "2024-11-15", "2024-11-15T10:00:00Z": "2024-11-15",
        "2024-1-5T1:2:3": "2024-01-05", "2024-11-15T10:00:00": "2024-11-15", "2024-11-15": "2024-11-15", " 2024-1-5 ": "2024-01-05",
        "November 15, 2024": "2024-11-15", "november 5, 2024": "2024-11-05", "Nov 15, 2024": "2024-11-15", "NOV 05, 2024": "2024-11-05",
        "Sept 5, 2024": None, "May 1, 2020": "2020-05-01", "02/13/2024": "2024-02-13", "13/02/2024": "2024-02-13", "1/2/2024": "2024-01-02",
        "31/12/1999": "1999-12-31", "32/12/1999": None, "2024-13-45": "2024-13-45", "2024-02-30": "2024-02-30",
        "2024-11-15 10:00": "2024-11-15", "2024-11-15T10:00:00.123Z": "2024-11-15", "2024-11-15T25:00:00": "2024-11-15",
        "2024-1-5T25:00:00": None, "next week": None, "": None, "15 November 2024": None, "November 31, 2024": None,
        "November  5,  2024": "2024-11-05", "2024-11-15T10:00:00+05": "2024-11-15", "1/2/24": None, "Foo 1, 2024": None,
    }
    got = one_column(spark, list(cases), normalize_date)
    assert dict(zip(cases, got)) == cases
    assert one_column(spark, ["2024-13-45", "2024-02-29"], lambda v: publish_date(v).cast("string")) == [None, "2024-02-29"]


def test_text_helpers(spark):
    assert one_column(spark, ["\n a b ", ""], strip) == ["a b", ""]
    hashes = one_column(spark, ["x", "x", "y", None], content_hash)
    assert hashes[0] == hashes[1] != hashes[2] and len(hashes[0]) == 64 and hashes[3] is None
    assert one_column(spark, ["", None, "x"], item_hash)[:2] == ["", ""]
    assert one_column(spark, ["", None, "/s"], lambda v: item_key(v, F.lit("/c"))) == ["/c", "/c", "/s"]
    marks = ["<p>ok", "<i>reCAPTCHA", "x" * 5000 + "captcha", "x" * 4993 + "captcha", None, '<form id="Challenge-Form">']
    assert one_column(spark, marks, is_captcha) == [False, True, False, True, False, True]


def test_url_rules(spark):
    urls = ["https://x.org/a/1", "https://x.org/b/1", "https://x.org/a/user/", "https://x.org/a?utm_x=1"]
    allowed = one_column(spark, urls, lambda v: url_allowed(v, [r"^https://x\.org/a"], ["/user/", r"\?.*utm_"]))
    assert allowed == [True, False, False, False]
    assert one_column(spark, urls, lambda v: url_allowed(v, [], [])) == [True] * 4
    assert one_column(spark, urls, lambda v: prefix_category(v, {"/a/": "A", "/": "Any"})) == ["A", "Any", "A", "Any"]


@pytest.mark.parametrize(
    "blocks, path, kind, expected",
    [
        (['{"@type": "A", "x": 1}'], "x", "A", "1"),
        (['{"@type": "A", "x": 1}'], "x", "B", None),
        (["{broken", '{"@type": "A", "x": "ok"}'], "x", "A", "ok"),
        (['{"x": null}', '{"x": "later"}'], "x", None, "later"),
        (['[{"@type": ["A", "B"], "x": {"y": "in"}}]'], "x.y", "A", "in"),
        (['{"@graph": [{"@type": "B", "x": 1}, {"@type": "A", "x": [{"y": "first"}, {"y": "no"}]}]}'], "x.y", "A", "first"),
        (['{"@type": "A", "x": {"name": "N"}}'], "x", "A", "N"),
        (['{"@type": "A", "x": ["", "t"]}'], "x", "A", "t"),
        (['{"@type": "A", "x": []}'], "x.y", "A", None),
        (['"text"', "3", "null", "[]"], "x", None, None),
        (['{"@type": "A", "@id": "u"}'], "@id", "A", "u"),
        (['{"@type": "A", "x": "first", "x": "last"}'], "x", "A", "last"),
    ],
)
def test_jsonld_values(spark, blocks, path, kind, expected):
    html = "".join(f"<script type='application/ld+json'>{b}</script>" for b in blocks)
    items = spark.createDataFrame([(html,)], "html string").select(
        jsonld.jsonld_items(jsonld.jsonld_blocks("html")).alias("items")
    )
    value = jsonld.variant_text(jsonld.first_value(F.col("items"), path, kind))
    assert items.select(value).first()[0] == expected


def test_jsonld_blocks_only_real_scripts(spark):
    body = json.dumps({"a": 1})
    html = (
        f"<!-- <script type='application/ld+json'>{body}</script> -->"
        f"<script>var s = \"<script type='application/ld+json'>x\";</script>"
        f'<SCRIPT id=x TYPE="application/ld+json" data-y>{body}</SCRIPT>'
        f"<script type=application/ld+json>{body}</script>"
        "<script type='application/ld+json+more'>no</script>"
    )
    assert one_column(spark, [html, "none"], jsonld.jsonld_blocks) == [[body, body], []]
