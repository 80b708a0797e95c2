"""URL expressions. Everything here is a plain Column, nothing leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme, authority, path, query, fragment (RFC 3986, appendix B)
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_DOT_SEGMENT = r"(^|/)\.\.?(/|$)"
_HIERARCHICAL = ("", "http", "https", "ftp", "file", "sftp")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def url_path(url: Column | str) -> Column:
    return _part(_col(url), 3)


def _without_controls(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _unsplit(scheme: Column, netloc: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((netloc != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(""),
        rooted,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _remove_dots(segments: Column) -> Column:
    def step(done: Column, seg: Column) -> Column:
        return (
            F.when((seg == "..") & (F.size(done) > 0), F.slice(done, F.lit(1), F.size(done) - 1))
            .when(seg.isin(".", ".."), done)
            .otherwise(F.array_append(done, seg))
        )

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    # A dot segment at the end stands for the folder itself.
    closing = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_join(F.concat(kept, closing), "/")


def _merge_paths(base_path: Column, path: Column) -> Column:
    """Path of a relative or rooted reference against the base path."""
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    # Parameters (";...") of the last segment take no part in dot removal.
    params = F.regexp_extract(path, r"(;[^/]*)$", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    # Empty segments vanish between folder and leaf, but not in a rooted path.
    inner = F.regexp_replace(F.concat(folder, path), r"//+", "/")
    joined = F.when(path.startswith("/"), path).otherwise(inner)

    def without_dots(plain: Column) -> Column:
        # Folding the segments is only paid for by paths that hold a dot segment.
        return F.when(plain.rlike(_DOT_SEGMENT), _remove_dots(F.split(plain, "/"))).otherwise(plain)

    merged = _let(joined, lambda plain: _let(without_dots(plain), lambda p: F.when(p == "", F.lit("/")).otherwise(p)))
    return F.concat(merged, params)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of ``href`` found on page ``base`` (RFC 3986 reference resolution)."""
    base, href = _col(base), _col(href)

    def parts(url: Column, prefix: str) -> list[Column]:
        names = ("scheme", "netloc", "path", "query", "fragment")
        found = {n: _part(url, i) for i, n in enumerate(names, 1)}
        found["scheme"] = F.lower(found["scheme"])
        return [c.alias(prefix + n) for n, c in found.items()]

    def resolved(p: Column) -> Column:
        scheme = F.when(p["scheme"] == "", p["b_scheme"]).otherwise(p["scheme"])
        query = F.when((p["path"] == "") & (p["query"] == "") & (p["netloc"] == ""), p["b_query"]).otherwise(p["query"])
        path = (
            F.when(p["netloc"] != "", p["path"])
            .when(p["path"] == "", p["b_path"])
            .otherwise(_merge_paths(p["b_path"], p["path"]))
        )
        netloc = F.when(p["netloc"] == "", p["b_netloc"]).otherwise(p["netloc"])
        whole = _let(path, lambda made: _unsplit(scheme, netloc, made, query, p["fragment"]))
        return F.when((scheme != p["b_scheme"]) | ~scheme.isin(*_HIERARCHICAL), href).otherwise(whole)

    both = F.struct(*parts(_without_controls(href), ""), *parts(_without_controls(base), "b_"))
    return F.when(base == "", href).when(href == "", base).otherwise(_let(both, resolved))


def _query_escape(text: Column) -> Column:
    # url_encode escapes '~' and keeps '*'; query strings here do the opposite.
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_param_slot(url: Column | str, name: str) -> Column:
    """Struct (head, tail): the text around the value of one query parameter of ``url``.

    Other parameters stay, repeats are grouped at their first position, blank ones
    go, and so does the fragment. A parameter that is not there yet comes last.
    """
    url = _without_controls(_col(url))
    start = F.concat(F.lower(_part(url, 1)), F.lit("://"), _part(url, 2), _part(url, 3), F.lit("?"))

    def recoded(text: Column) -> Column:
        return _query_escape(F.coalesce(F.try_url_decode(text), text))

    pairs = F.transform(
        F.filter(F.split(_part(url, 4), "&"), lambda p: p.rlike("(?s)^[^=]*=.")),
        lambda p: F.struct(
            recoded(F.substring_index(p, "=", 1)).alias("k"),
            recoded(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    key = _query_escape(F.lit(name))

    def slot(p: Column) -> Column:
        names = F.array_distinct(F.transform(p, lambda x: x["k"]))

        def written(some: Column) -> Column:
            grouped = F.flatten(F.transform(some, lambda n: F.filter(p, lambda x: x["k"] == n)))
            return F.array_join(F.transform(grouped, lambda x: F.concat(x["k"], F.lit("="), x["v"])), "&")

        def around(names: Column) -> Column:
            size, at = F.size(names), F.array_position(names, key).cast("int")
            before = F.when(at > 0, F.slice(names, F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(names)
            after = F.when(at > 0, F.slice(names, at + 1, size)).otherwise(F.slice(names, F.lit(1), F.lit(0)))
            head = F.concat(written(before), F.when(F.size(before) > 0, F.lit("&")).otherwise(""), key, F.lit("="))
            tail = F.concat(F.when(F.size(after) > 0, F.lit("&")).otherwise(""), written(after))
            return F.struct(F.concat(start, head).alias("head"), tail.alias("tail"))

        return _let(names, around)

    return _let(pairs, slot)


def set_query_param(url: Column | str, name: str, value: Column | str) -> Column:
    """``url`` with one query parameter set (see ``query_param_slot``)."""
    text = _query_escape(_col(value).cast("string"))
    return _let(query_param_slot(url, name), lambda s: F.concat(s["head"], text, s["tail"]))


def query_param(url: Column | str, name: str) -> Column:
    """First non-blank value of a query parameter, still encoded; null when absent."""
    query = _part(_without_controls(_col(url)), 4)
    hit = F.filter(F.split(query, "&"), lambda p: p.startswith(name + "=") & (F.length(p) > len(name) + 1))
    return F.substring(F.get(hit, F.lit(0)), len(name) + 2, 2_147_483_647)


def url_to_slug(url: Column | str, max_length: int = 80) -> Column:
    """File-name-safe last path segment; ``index`` when nothing is left."""
    path = F.regexp_replace(url_path(_without_controls(_col(url))), r";[^/]*$", "")
    segment = F.regexp_extract(F.regexp_replace(path, r"^/+|/+$", ""), r"([^/]*)$", 1)
    dashed = F.regexp_replace(segment, r"[^a-zA-Z0-9]+", "-")
    slug = F.lower(F.regexp_replace(dashed, r"^-+|-+$", ""))
    return F.when(slug == "", F.lit("index")).otherwise(F.substring(slug, 1, max_length))


def any_pattern(text: Column, patterns: Iterable[str]) -> Column:
    """True when any regular expression is found; one literal, so it compiles once."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns))


def url_allowed(url: Column | str, include: Iterable[str], exclude: Iterable[str]) -> Column:
    url, include, exclude = _col(url), list(include), list(exclude)
    keep = any_pattern(url, include) if include else F.lit(True)
    return keep & ~any_pattern(url, exclude) if exclude else keep


def prefix_category(url: Column | str, prefixes: Mapping[str, str]) -> Column:
    """Label of the first path prefix that matches, else the empty string."""
    path, out = url_path(url), None
    for prefix, label in prefixes.items():
        hit = path.startswith(prefix)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit("") if out is None else out.otherwise(F.lit(""))
