"""URL parsing and rules against plain Python, and a model against its own definition."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from folioflow.llm import urls
from folioflow.llm.queries import URL_RULES


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest[len(host) :])[0]


def rule(host, path):
    fits = [r for r in URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


def some_urls():
    rng = random.Random(1)
    hosts = ["a.example.com", "WWW.Example.COM", "example.com", "notexample.com", "x.net", "net", "casino.org", "é.org", "m.www.example.com", "com", ""]
    paths = ["", "/", "/en/1", "/es/2", "/fr/", "/EN/3", "/de/x?y=/en/", "#top", "?q=1", "/a://b", "//x"]
    made = [rng.choice(["http", "https", "ftp", ""]) + "://" + rng.choice(hosts) + rng.choice(paths) for _ in range(300)]
    return [*made, None, "", "no scheme", "http:/x", "://", "http://a.com\n/en/", "x" * 5000 + "://y.org/" + "z" * 50_000]


def test_hosts_paths_and_rules(spark):
    values = some_urls()
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(values)], "page_id long, url string")
    pages = pages.withColumn("host", F.lit("clash")).withColumn("grams", F.lit(1))
    out = urls.judge_urls(pages, URL_RULES)
    for r in out.collect():
        host, path = parse(values[r.page_id])
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want and want[1] + want[2])
        assert r.verdict == want[0] if want else r.verdict in ("allow", "block")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_model_learns_from_a_small_table(spark):
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(8))
    rows = [(f"http://{word('abcdef')}.org/{word('abcdef')}", "allow") for _ in range(80)]
    rows += [(f"http://casino{word('abcdef')}.org/win/{word('abcdef')}", "block") for _ in range(80)]
    rng.shuffle(rows)
    labelled = spark.createDataFrame(rows[:100], "url string, verdict string")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, (), labelled).collect()}
    assert sum(got[i] == v for i, (_, v) in enumerate(rows)) >= 155


def test_probability_is_the_logistic_of_its_weights(spark):
    import math

    rows = spark.createDataFrame([([0, 2],), ([],), ([1],)], "g array<int>")
    weights = [0.5, -1.0, 2.0, 0.25]
    got = [r[0] for r in rows.select(urls.probability("g", weights)).collect()]
    logit = [2.5 / math.sqrt(2) + 0.25, 0.25, -0.75]
    assert got == pytest.approx([1 / (1 + math.exp(-x)) for x in logit])


def test_one_class_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string")
    labelled = spark.createDataFrame([("http://a.com/", "allow")], "url string, verdict string")
    assert [r.verdict for r in urls.judge_urls(pages, (), labelled, default="block").collect()] == ["block"]
    assert urls.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_repeated_urls_do_not_fill_the_sample(spark):
    rules = (("block", "bad.org", "/"), ("allow", "good.org", "/"))
    once = [f"http://bad.org/win/{i}" for i in range(60)] + [f"http://good.org/read/{i}" for i in range(60)]
    hashed = spark.createDataFrame([(u,) for u in once], "url string").select("url", F.xxhash64(*urls.split_url("url")).alias("x"))
    first = hashed.orderBy("x").first().url
    rows = [*once, *[first] * 400, "http://x.net/win/1", "http://x.net/read/1"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.url: r for r in urls.judge_urls(pages, rules, max_labelled=100).collect()}
    assert [got[f"http://x.net/{w}/1"].verdict for w in ("win", "read")] == ["block", "allow"]
    seen = spark.createDataFrame([("h", f"/{i}", "block" if i < 15 else "allow") for i in range(5000)] * 2, "h string, p string, verdict string")
    some = [(r.p, r.block) for r in urls.sample(seen, 100).collect()]
    assert len(some) == len(set(some)) == 100 and sum(b for _, b in some) >= 10
