"""JSON-LD access with VARIANT values.

All steps are array expressions inside the page row: the blocks of a page never
leave it, so first-value-wins needs neither an explode nor a shuffle.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comments and other raw-text elements are matched too (with an empty group), so
# that a block quoted inside a script or a comment is not taken for a real one.
_BLOCK = (
    r"(?is)<!--.*?-->"
    r"|<script\b(?=[^>]*\btype\s*=\s*(?:\"application/ld\+json\"|'application/ld\+json'|application/ld\+json[\s>]))"
    r"[^>]*>(.*?)</script\s*>"
    r"|<(script|style|textarea|title)\b[^>]*>.*?</\2\s*>"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jsonld_blocks(html: Column | str) -> Column:
    """Text of every JSON-LD script block, in document order."""
    html = _col(html)
    found = F.filter(F.regexp_extract_all(html, F.lit(_BLOCK), F.lit(1)), lambda t: t != "")
    return F.when(F.contains(html, F.lit("ld+json")), found).otherwise(F.array().cast("array<string>"))


def _is_kind(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def jsonld_items(blocks: Column | str) -> Column:
    """Objects of all blocks: list elements, ``@graph`` elements, or the root itself.

    A block that is no JSON is skipped, and so is everything that is no object.
    """

    def elements(root: Column) -> Column:
        graph = F.try_variant_get(root, '$["@graph"]', "variant")
        return (
            F.when(_is_kind(root, "ARRAY"), F.try_variant_get(root, "$", "array<variant>"))
            .when(_is_kind(graph, "ARRAY"), F.try_variant_get(root, '$["@graph"]', "array<variant>"))
            .otherwise(F.array(root))
        )

    parsed = F.filter(F.transform(_col(blocks), lambda t: F.try_parse_json(t)), lambda v: v.isNotNull())
    return F.filter(F.flatten(F.transform(parsed, elements)), lambda v: _is_kind(v, "OBJECT"))


def item_type(item: Column) -> Column:
    """``@type`` of an object, the first one when it is a list."""
    kind = F.try_variant_get(item, '$["@type"]', "variant")
    return F.when(_is_kind(kind, "ARRAY"), F.try_variant_get(item, '$["@type"][0]', "string")).when(
        _is_kind(kind, "STRING"), F.try_variant_get(item, '$["@type"]', "string")
    )


def dot_path(item: Column, path: str) -> Column:
    """Value at a dotted path; a list on the way is entered at its first element."""
    head, *tail = [f'["{key}"]' for key in path.split(".")]
    routes = ["$" + head + "".join(hops) for hops in product(*[(t, "[0]" + t) for t in tail])]
    hits = [F.try_variant_get(item, route, "variant") for route in routes]
    return F.coalesce(*[F.when(~F.is_variant_null(h), h) for h in hits])


def variant_text(value: Column) -> Column:
    """A value as text: scalars as they are, the first text of a list, ``name`` of an object."""
    texts = F.try_variant_get(value, "$", "array<variant>")
    return (
        F.when(_is_kind(value, "OBJECT"), F.try_variant_get(value, "$.name", "string"))
        .when(
            _is_kind(value, "ARRAY"),
            F.get(F.filter(F.transform(texts, _scalar_or_name), lambda t: t.isNotNull() & (t != "")), F.lit(0)),
        )
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def _scalar_or_name(value: Column) -> Column:
    return F.when(_is_kind(value, "OBJECT"), F.try_variant_get(value, "$.name", "string")).when(
        ~_is_kind(value, "ARRAY"), F.try_variant_get(value, "$", "string")
    )


def variant_texts(value: Column) -> Column:
    """A value as a list of texts; a single text becomes a list of one."""
    many = F.filter(
        F.transform(F.try_variant_get(value, "$", "array<variant>"), _scalar_or_name),
        lambda t: t.isNotNull() & (t != ""),
    )
    one = variant_text(value)
    return F.when(_is_kind(value, "ARRAY"), many).when(one.isNotNull() & (one != ""), F.array(one))


def first_value(items: Column, path: str, type_filter: str | None) -> Column:
    """First non-null value at ``path`` over the objects of the wanted type."""
    wanted = items if not type_filter else F.filter(items, lambda i: item_type(i) == type_filter)
    values = F.transform(wanted, lambda i: dot_path(i, path))
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))
