"""Page extraction: the DOM job, JSON-LD fields, and their merge.

The DOM job is the only place where page text reaches Python. It runs as one
Arrow function per page that answers every selector of the page's site in a single
parse and returns a struct, so Spark keeps all other columns on the JVM side and no
page text is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import schemas
from folioflow.functions import dom as html_dom
from folioflow.functions import jsonld
from folioflow.functions.normalize import is_captcha, non_empty, non_empty_array, strip
from folioflow.functions.urls import resolve_url
from folioflow.rules import Rules, by_site
from folioflow.session import ship_package

TEXT, ATTR, HTML, LIST, ATTRS, IMAGES, LINKS = "text", "attr", "html", "list", "attrs", "images", "links"
RAW_IMAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("src", "data-src", "alt", "caption")])
_RESULT_TYPE = {
    TEXT: T.StringType(),
    ATTR: T.StringType(),
    HTML: T.StringType(),
    LIST: T.ArrayType(T.StringType()),
    ATTRS: T.ArrayType(T.StringType()),
    LINKS: T.ArrayType(T.StringType()),
    IMAGES: T.ArrayType(RAW_IMAGE),
}
_ARROW_TYPE = {
    T.StringType(): pa.string(),
    T.ArrayType(T.StringType()): pa.list_(pa.string()),
    T.ArrayType(RAW_IMAGE): pa.list_(pa.struct([(f.name, pa.string()) for f in RAW_IMAGE.fields])),
}


class Take:
    """What one output field takes from a page: a selector and a mode."""

    def __init__(self, mode: str, selector: str, name: str = "", base_url: str | None = None, lazy: bool = False):
        html_dom.Selector(selector)  # fail on the driver, not in a task
        self.mode, self.selector, self.name, self.base_url, self.lazy = mode, selector, name, base_url, lazy


def _taker(take: Take):
    """Function document -> value, with its selector compiled."""
    selector, name = html_dom.Selector(take.selector), take.name
    if take.mode == TEXT:
        return lambda doc: html_dom.text_of(doc.select(selector))
    if take.mode == ATTR:
        return lambda doc: next(iter(html_dom.attr_values(doc.select(selector), name)), None)
    if take.mode == LIST:
        return lambda doc: html_dom.own_texts(doc.select(selector))
    if take.mode == ATTRS:
        return lambda doc: html_dom.attr_values(doc.select(selector), name)
    if take.mode == HTML:
        return lambda doc: next((html_dom.clean_markup(n) for n in doc.select(selector)[:1]), None)
    if take.mode == IMAGES:
        return lambda doc: next((html_dom.raw_images(n) for n in doc.select(selector)[:1]), [])
    if take.mode == LINKS:

        def links(doc):
            named = {"read_more_or_css": html_dom.read_more_links, "headline": html_dom.headline_links}.get(name)
            nodes = named(doc) if named else []
            if not nodes and name != "headline":
                nodes = doc.select(selector)
            return html_dom.attr_values(nodes, "href")

        return links
    raise ValueError(f"unknown mode {take.mode!r}")


def dom_select(
    pages: DataFrame,
    fields: Mapping[str, Mapping[str, Take]],
    *,
    site: str = "site",
    url: str = "url",
    html: str = "html",
    into: str = "dom",
) -> DataFrame:
    """Add a struct column with the selected fields of each page.

    ``fields`` maps a site to its output fields. Pages of sites without fields get
    a null struct and are never handed to Python.
    """
    ship_package(pages.sparkSession)
    modes: dict[str, str] = {}
    for takes in fields.values():
        for name, take in takes.items():
            if _RESULT_TYPE[modes.setdefault(name, take.mode)] != _RESULT_TYPE[take.mode]:
                raise ValueError(f"field {name} has two result types")
    struct = T.StructType([T.StructField(n, _RESULT_TYPE[m]) for n, m in modes.items()])
    arrow = {n: _ARROW_TYPE[_RESULT_TYPE[m]] for n, m in modes.items()}
    plan = {s: dict(takes) for s, takes in fields.items()}

    compiled: dict[str, dict] = {}  # filled once per task

    def run(site_col: pa.Array, html_col: pa.Array) -> pa.Array:
        if not compiled:
            compiled.update({s: {n: _taker(t) for n, t in takes.items()} for s, takes in plan.items()})
        columns: dict[str, list] = {n: [] for n in arrow}
        for s, h in zip(site_col.to_pylist(), html_col.to_pylist()):
            takers = compiled.get(s) if h is not None else None
            doc = html_dom.Document(h) if takers else None
            for n, values in columns.items():
                take = takers.get(n) if takers else None
                values.append(take(doc) if take else None)
        return pa.StructArray.from_arrays([pa.array(v, arrow[n]) for n, v in columns.items()], names=list(arrow))

    # Non-deterministic only for the planner: the parse must not be repeated when a
    # filter or a second projection refers to its result.
    job = F.arrow_udf(run, struct).asNondeterministic()
    known = F.when(F.col(site).isin(*plan), F.col(html))
    out = pages.withColumn(into, job(F.col(site), known))
    for name in (n for n, mode in modes.items() if mode == IMAGES):
        images = None
        for s, takes in plan.items():
            if take := takes.get(name):
                made = images_from(F.col(into)[name], F.lit(take.base_url) if take.base_url else F.col(url), take.lazy)
                images = F.when(F.col(site) == s, made) if images is None else images.when(F.col(site) == s, made)
        out = out.withColumn(into, F.when(F.col(into).isNotNull(), F.col(into).withField(name, images)))
    return out


def images_from(raw: Column, base: Column, lazy: bool) -> Column:
    """Images (url, alt, caption) of raw image attributes; those without a source are left out."""
    source = lambda i: F.coalesce(non_empty(i["src"]), non_empty(i["data-src"]) if lazy else F.lit(None), F.lit(""))
    return F.transform(
        F.filter(raw, lambda i: source(i) != ""),
        lambda i: F.struct(
            resolve_url(F.coalesce(base, F.lit("")), source(i)).alias("url"),
            strip(F.coalesce(i["alt"], F.lit(""))).alias("alt"),
            i["caption"].alias("caption"),
        ),
    )


def clean_body(html: Column | str) -> Column:
    """Cleaned whole document of an HTML fragment column."""
    ship_package(SparkSession.active())

    def run(fragments: pa.Array) -> pa.Array:
        return pa.array(
            [None if f is None else html_dom.clean_markup(html_dom.Document(f).root) for f in fragments.to_pylist()],
            pa.string(),
        )

    html = F.col(html) if isinstance(html, str) else html
    return F.arrow_udf(run, T.StringType()).asNondeterministic()(html)


def article_fields(rules: Rules) -> dict[str, dict[str, Take]]:
    """DOM fields of article pages from the site rules; sites without any are left out."""
    out = {}
    for name, r in rules.items():
        takes: dict[str, Take] = {}
        for field, selector in r.selectors.items():
            if field == "body":
                takes["body"] = Take(HTML, selector)
            elif field == "date":
                takes["date_published"] = Take(ATTR, selector, r.date_attr)
            elif field == "date_text":
                takes["date_published"] = Take(TEXT, selector)
            elif field in ("category", "tags"):
                takes["categories" if field == "category" else "tags"] = Take(LIST, selector)
            else:
                takes[field] = Take(TEXT, selector)
        if r.image_container:
            takes["images"] = Take(IMAGES, r.image_container, base_url=r.image_base_url, lazy=r.lazy_images)
        if takes:
            out[name] = takes
    return out


def listing_fields(rules: Rules) -> dict[str, dict[str, Take]]:
    """DOM fields of listing pages: article links, edition links, next and last page."""
    out = {}
    for name, r in rules.items():
        takes: dict[str, Take] = {}
        if r.link_selector or r.link_mode == "headline":
            takes["links"] = Take(LINKS, r.link_selector or "a", "" if r.link_mode == "css" else r.link_mode)
        if r.edition_selector:
            takes["editions"] = Take(ATTRS, r.edition_selector, "href")
        if r.next_selector:
            takes["next"] = Take(ATTR, r.next_selector, "href")
        if r.last_page_selector:
            takes["last"] = Take(ATTR, r.last_page_selector, "href")
        if takes:
            out[name] = takes
    return out


def breadcrumb_categories(crumbs: Column | str) -> Column:
    """Trimmed crumb texts without blanks and without "home" in any case."""
    crumbs = F.col(crumbs) if isinstance(crumbs, str) else crumbs
    return F.filter(F.transform(crumbs, strip), lambda c: ~F.lower(c).isin("home", ""))


def flag_captcha(pages: DataFrame, html: str = "html", skip: bool = False) -> DataFrame:
    """Mark pages that are a CAPTCHA wall; with ``skip`` they are left out."""
    flagged = pages.withColumn("captcha_detected", is_captcha(html))
    return flagged.filter(~F.col("captcha_detected")) if skip else flagged


def extract_jsonld(pages: DataFrame, rules: Rules, *, site: str = "site", html: str = "html") -> DataFrame:
    """Add struct ``jsonld`` with the mapped fields of each page's site."""
    # An object may name a key twice: the last value counts, as in any JSON reader.
    pages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    names = list(dict.fromkeys(f for r in rules.values() for f in r.jsonld_fields))
    if not names:
        return pages.withColumn("jsonld", F.lit(None).cast("struct<title:string>"))
    mapped = [s for s, r in rules.items() if r.jsonld_fields]
    text = F.when(F.col(site).isin(*mapped), F.col(html))

    def raw(name: str) -> Column:
        return by_site(
            site,
            rules,
            lambda r: jsonld.first_value(F.col("_jsonld_items"), r.jsonld_fields[name], r.jsonld_type)
            if name in r.jsonld_fields
            else None,
        )

    def value(name: str) -> Column:
        as_column = jsonld.variant_texts if name == "categories" else jsonld.variant_text
        return as_column(F.col(f"_jsonld_raw.{name}"))

    # One projection per step, so that the objects are parsed once and not per field.
    staged = pages.withColumn("_jsonld_items", jsonld.jsonld_items(jsonld.jsonld_blocks(text)))
    staged = staged.withColumn(
        "_jsonld_raw", F.when(F.size("_jsonld_items") > 0, F.struct(*[raw(n).alias(n) for n in names]))
    )
    fields = F.struct(*[value(n).alias(n) for n in names])
    out = staged.withColumn("jsonld", F.when(F.col("_jsonld_raw").isNotNull(), fields))
    return out.drop("_jsonld_items", "_jsonld_raw")


MERGED = ("title", "author", "date_published", "description", "body", "canonical_url", "publisher", "category")


def merge_fields(df: DataFrame, into: str = "merged") -> DataFrame:
    """JSON-LD wins where it has a value, the DOM fills gaps. Empty counts as no value."""
    have = {s: set(df.schema[s].dataType.names) for s in ("jsonld", "dom")}

    def pick(name: str, clean) -> Column:
        sources = [clean(F.col(f"{s}.{name}")) for s in ("jsonld", "dom") if name in have[s]]
        return F.coalesce(*sources, F.lit(None))

    crumbs = breadcrumb_categories("dom.categories") if "categories" in have["dom"] else F.lit(None)
    own = non_empty_array(F.col("jsonld.categories")) if "categories" in have["jsonld"] else F.lit(None)
    crumbs = crumbs.cast("array<string>")
    texts = [pick(n, non_empty).cast("string").alias(n) for n in MERGED if n != "category"]
    from_jsonld = non_empty("jsonld.category") if "category" in have["jsonld"] else F.lit(None).cast("string")
    # The most specific crumb is the last one.
    category = F.coalesce(from_jsonld, F.get(crumbs, F.size(crumbs) - 1))
    categories = F.coalesce(own.cast("array<string>"), non_empty_array(crumbs))
    return df.withColumn(into, F.struct(*texts, category.alias("category"), categories.alias("categories")))
