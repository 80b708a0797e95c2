"""Rules given as tables of any size: URL patterns by a literal index, path prefixes by expansion.

A pattern that needs a literal text is found by it: its longest required literal is its key. Every
URL is cut into its pieces of ``GRAM`` characters inside its row; those that begin a literal tell how
long the literals are that do, so a URL writes out only pieces of these lengths at these places, and
an equi-join brings together only patterns and URLs that hold their whole literal. The regular
expression decides on these pairs alone. Patterns without such a literal are tried on all URLs of
their site.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.urls import url_path
from folioflow.session import broadcast_if_small, cut_lineage, ship_package

GRAM = 4
MAX_INDEX_ROWS = 100_000


def literal_factor(pattern: str) -> str | None:
    """The longest text that every match of ``pattern`` contains, or None if none is certain.

    Groups, classes, escapes other than of signs, and characters that may be left out end a text;
    alternatives outside groups and inline flags leave nothing certain.
    """
    runs, run, i, n = [], "", 0, len(pattern)
    if "(?" in pattern or "\\Q" in pattern:
        return None
    while i < n:
        c = pattern[i]
        literal = None
        if c == "|":
            return None
        if c == "\\":
            if i + 1 < n and not (pattern[i + 1].isascii() and pattern[i + 1].isalnum()):
                literal = pattern[i + 1]
            elif i + 1 < n and pattern[i + 1] not in "bBdDwWsSAzZ":
                return None
            i += 2
        elif c in "[(":
            i = _past(pattern, i)
            if i is None:
                return None
        else:
            if c not in ".^$*+?{}])":
                literal = c
            i += 1
        quantifier = pattern[i] if i < n and pattern[i] in "*+?{" else ""
        if literal is None or quantifier in ("*", "?", "{"):
            runs.append(run)
            run = ""
        else:
            run += literal
            if quantifier == "+":
                runs.append(run)
                run = ""
        if quantifier:
            if quantifier == "{" and "}" not in pattern[i:]:
                return None
            i = pattern.index("}", i) + 1 if quantifier == "{" else i + 1
            while i < n and pattern[i] in "?+":  # lazy and possessive forms
                i += 1
    best = max([*runs, run], key=len)
    return best or None


def _past(pattern: str, i: int) -> int | None:
    """The place after the class or group that begins at ``i``; None if it does not end as expected."""
    if pattern[i] == "[":
        j = i + 1 + (pattern[i + 1 : i + 2] == "^")
        j += pattern[j : j + 1] == "]"
        while j < len(pattern) and pattern[j] != "]":
            if pattern[j] == "[":
                return None
            j += 2 if pattern[j] == "\\" else 1
        return j + 1 if j < len(pattern) else None
    depth, j = 0, i
    while j < len(pattern):
        if pattern[j] == "\\":
            j += 2
            continue
        if pattern[j] == "[":
            j = _past(pattern, j)
            if j is None:
                return None
            continue
        depth += (pattern[j] == "(") - (pattern[j] == ")")
        j += 1
        if not depth:
            return j
    return None


def index_rules(url_rules: DataFrame) -> DataFrame:
    """``site, kind, pattern, gram, literal``: the key of each pattern and how it begins, null where it has none."""
    ship_package(url_rules.sparkSession)

    def keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            factors = [f if f and len(f) >= GRAM else None for f in map(literal_factor, part["pattern"])]
            yield part.assign(gram=[f and f[:GRAM] for f in factors], literal=factors)

    rules = url_rules.select("site", "kind", "pattern").filter("pattern is not null").distinct()
    return cut_lineage(rules.mapInPandas(keyed, "site string, kind string, pattern string, gram string, literal string"))


def rule_candidates(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``site, _url, kind, pattern``: the distinct ``urls(site, _url)`` with the patterns whose literal they hold."""
    size = F.length("_url")
    place = F.sequence(F.lit(1), size - GRAM + 1)
    every = F.transform(place, lambda i: F.substring(F.col("_url"), i, F.lit(GRAM)))
    pieces = urls.filter(size >= GRAM).select("site", "_url", F.explode(F.array_distinct(every)).alias("gram"))
    known = rules.filter("gram is not null")
    sizes = known.groupBy("site", "gram").agg(F.collect_set(F.length("literal")).alias("_sizes"))
    begun = pieces.join(broadcast_if_small(sizes, MAX_INDEX_ROWS), ["site", "gram"])
    starts = F.filter(place, lambda i: F.substring(F.col("_url"), i, F.lit(GRAM)) == F.col("gram"))
    texts = F.transform(
        starts,
        lambda i: F.transform(
            F.filter("_sizes", lambda n: i + n - 1 <= size), lambda n: F.xxhash64(F.substring(F.col("_url"), i, n))
        ),
    )
    held = begun.select("site", "_url", F.explode(F.array_distinct(F.flatten(texts))).alias("_key"))
    known = known.select("site", F.xxhash64("literal").alias("_key"), "kind", "pattern")
    return held.join(broadcast_if_small(known, MAX_INDEX_ROWS), ["site", "_key"]).select("site", "_url", "kind", "pattern")


def filter_urls_by_index(links: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``discovery.filter_urls_by_table`` for rule tables with many patterns (``index_rules``)."""
    target = F.col(url)
    urls = links.select("site", target.alias("_url")).distinct()
    rest = rules.filter("gram is null").select("site", "kind", "pattern")
    pairs = rule_candidates(urls, rules).unionByName(urls.join(broadcast_if_small(rest), "site").select("site", "_url", "kind", "pattern"))
    hits = pairs.filter(F.rlike("_url", F.col("pattern"))).groupBy("site", "_url")
    hits = hits.agg(F.bool_or(F.col("kind") == "include").alias("_in"), F.bool_or(F.col("kind") == "exclude").alias("_out"))
    limited = rules.filter("kind = 'include'").select("site").distinct().withColumn("_limited", F.lit(True))
    marked = links.withColumn("_url", target).join(hits, ["site", "_url"], "left").join(broadcast_if_small(limited), "site", "left")
    yes = F.lit(True)
    keep = (F.coalesce("_in", ~yes) | F.coalesce("_limited", ~yes).eqNullSafe(F.lit(False))) & ~F.coalesce("_out", ~yes)
    return marked.filter(keep & F.col("site").isNotNull()).select(*links.columns)


def prefix_category_by_table(rows: DataFrame, prefixes: DataFrame, url: str = "url", into: str = "category") -> DataFrame:
    """Label of the first rule whose prefix the path has: ``prefixes(site, ord, prefix, label)``, else empty.

    All prefixes of a path are written out inside its row, as long as the longest rule, and meet the
    rules by an equi-join; the least ``ord`` wins.
    """
    path: Column = url_path(url)
    longest = prefixes.agg(F.max(F.length("prefix"))).first()[0] or 0
    paths = rows.select("site", F.col(url).alias("_url"), path.alias("_path")).distinct()
    ends = F.sequence(F.lit(0), F.least(F.length("_path"), F.lit(longest)))
    expanded = paths.select("site", "_url", F.explode(F.transform(ends, lambda n: F.substring(F.col("_path"), F.lit(1), n))).alias("prefix"))
    first = expanded.join(broadcast_if_small(prefixes, MAX_INDEX_ROWS), ["site", "prefix"]).groupBy("site", "_url")
    first = first.agg(F.min_by("label", "ord").alias(into))
    out = rows.withColumn("_url", F.col(url)).join(first, ["site", "_url"], "left").withColumn(into, F.coalesce(into, F.lit("")))
    return out.select(*rows.columns, into)
