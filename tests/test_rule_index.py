"""Rule tables of real size against the direct forms."""

from __future__ import annotations

import random
import re

import pytest

from folioflow.operators.discovery import filter_urls_by_table
from folioflow.operators.rule_index import filter_urls_by_index, index_rules, literal_factor, prefix_category_by_table, rule_candidates


@pytest.mark.parametrize(
    "pattern, factor",
    [
        (r"/news/\d+$", "/news/"),
        (r"^https://a\.example\.org/x", "https://a.example.org/x"),
        (r"abc?defg", "defg"),
        (r"abcd+e", "abcd"),
        (r"(foo|bar)/tail", "/tail"),
        (r"foo|barbar", None),
        (r"x{2}yyyy", "yyyy"),
        (r"[abc\]]longer[^]]z", "longer"),
        (r"(?i)upper", None),
        (r"a.*b", "a"),
        (r"", None),
        (r"(un(closed", None),
        (r"\Qa.b\E", None),
        (r"tab\there", None),
        (r"word\bnext", "word"),
        (r"lazy+?more", "lazy"),
        (r"/caf\é/\?x\=ü$", "/café/?x=ü"),
    ],
)
def test_literal_factor(pattern, factor):
    got = literal_factor(pattern)
    assert got == factor or (factor in ("word", "lazy") and got in ("word", "next", "lazy", "more"))


def test_factor_is_in_every_match():
    rng = random.Random(3)
    pieces = ["ab", "c", r"\.", ".", "d*", "e+", "f?", "[gh]", "(ij|k)", "l{1,2}", "/", "mnop", "$", "^", r"\d"]
    texts = ["".join(rng.choice("abcdefghijklmnop./12") for _ in range(30)) for _ in range(400)] + ["abc.mnop/ijab", "mnopab", "ab"]
    for _ in range(800):
        pattern = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4)))
        factor = literal_factor(pattern)
        if factor:
            assert all(factor in m.group() for t in texts for m in re.finditer(pattern, t)), pattern


def test_thousands_of_patterns(spark):
    rng = random.Random(7)
    urls = [(i, rng.choice("abc"), f"https://h{i % 5}.org/{rng.choice(['en', 'fr'])}/s{rng.randint(0, 900)}/p{i}?q={i % 7}") for i in range(1500)]
    urls += [(9001, "a", None), (9002, "a", ""), (9003, None, "https://x/"), (9004, "z", "https://h1.org/en/s1/p2"), (0, *urls[0][1:])]
    rules = [(rng.choice("ab"), "exclude", rf"/s{n}/p\d+\?") for n in range(0, 900, 2)]
    rules += [("a", "exclude", rf"^https://h{n}\.org/fr/s1\d\d/") for n in range(5)]
    rules += [("b", "include", f"/(en|fr)/s{n}") for n in range(600)] + [("b", "include", "q=[12]$"), ("c", "exclude", "p1.0|p2.0"), ("c", "exclude", None)]
    links = spark.createDataFrame(urls, "n long, site string, url string").repartition(4)
    table = spark.createDataFrame(rules, "site string, kind string, pattern string")
    indexed = index_rules(table)
    assert indexed.filter("gram is not null").count() > 400
    rows = lambda df: sorted(map(str, df.select("n", "site", "url").collect()))
    got, want = filter_urls_by_index(links, indexed), filter_urls_by_table(links.filter("url is not null and site is not null"), table.filter("pattern is not null"))
    assert rows(got.filter("url is not null")) == rows(want)


def test_patterns_that_begin_alike_meet_only_their_own_urls(spark):
    paths = [f"/en/{n}{end}" for n in range(700) for end in ("", ".html", "?a=é")]
    quoted = [re.sub("([^A-Za-z0-9/])", r"\\\1", p) for p in paths]
    rules = spark.createDataFrame([("s", "exclude", f"^[a-z]+://[^/]*{q}$") for q in quoted[::3] + quoted[2::6]], "site string, kind string, pattern string")
    # The literals of short addresses are the beginnings of longer ones; one is there several times.
    links = [(i, "s", f"https://h.org{p}") for i, p in enumerate(paths)] + [(9001, "s", "https://h.org/en/7/en/7/en/7"), (9002, "s", "/en"), (9003, "s", None)]
    frame = spark.createDataFrame(links, "n long, site string, url string")
    indexed = index_rules(rules)
    assert indexed.filter("gram is null").count() == 0
    pairs = rule_candidates(frame.select("site", frame.url.alias("_url")).distinct(), indexed)
    holds = sum(q.replace("\\", "") in p for p in paths for q in quoted[::3] + quoted[2::6])
    assert holds <= pairs.count() <= holds + 2 and holds < 5 * len(paths)
    kept = {r.n for r in filter_urls_by_index(frame, indexed).collect()}
    barred = {*paths[::3], *paths[2::6]}
    assert kept == {i for i, p in enumerate(paths) if p not in barred} | {9001, 9002, 9003}


def test_prefixes_as_a_table(spark):
    paths = ["/a/b/c", "/a/b", "/ab/c", "", "/x" * 3000, "/ä/ö"]
    rows = [(i, "s", f"https://h.org{p}?q=1") for i, p in enumerate(paths)] + [(90, "t", "https://h.org/a/b"), (91, "s", None), (0, "s", "https://h.org/a/b/c?q=1")]
    rules = [("s", 2, "/a/", "A"), ("s", 1, "/a/b/", "AB"), ("s", 3, "/ä", "Ä"), ("s", 9, "/x/x/x", "X"), ("s", 0, "/zzz", "Z"), ("u", 0, "/", "U")]
    rules += [("s", 100 + n, f"/many/{n}", str(n)) for n in range(3000)]
    frame = spark.createDataFrame(rows, "n long, site string, url string")
    table = spark.createDataFrame(rules, "site string, ord int, prefix string, label string")
    got = sorted((r.n, r.category) for r in prefix_category_by_table(frame, table).collect())
    assert got == [(0, "AB"), (0, "AB"), (1, "A"), (2, ""), (3, ""), (4, "X"), (5, "Ä"), (90, ""), (91, "")]
    assert {r.category for r in prefix_category_by_table(frame, table.limit(0)).collect()} == {""}
