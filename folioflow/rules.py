"""Per-site rules: the small dimension data every operator is driven by.

Rules are plain configuration. They are compiled into Column expressions (``CASE``
on the site with literal patterns), so no rule table is joined or broadcast, and
they can also be listed as DataFrames (``rule_tables``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.urls import prefix_category, url_allowed
from folioflow.site_data import SITES as _SITE_TREES

LINK_MODES = ("css", "read_more_or_css", "headline")
CATEGORY_RULES = (
    "merged_or_listing",  # merged category, else listing category
    "list_or_listing",  # as above, and the listing category stands in for the list
    "first",  # first of the merged list
    "first_or_listing",  # first of the list, else the listing category for both
    "topics_and_tags",  # page topics followed by new tags; first, else listing
    "listing",  # listing category for both
    "prefix",  # label of the URL prefix
)
DEDUP_SCOPES = ("site", "page", "none")


# Link paths of a configuration and the link mode that answers them.
LINK_PATHS = {
    "read_more_xpath": {
        "//a[contains(translate(text(), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'read more')]/@href": "read_more_or_css"
    },
    "link_xpath": {"//a[h3[@class='splash']]/@href": "headline"},
}


@dataclass(frozen=True)
class SiteRules:
    site: str
    brand: str = ""
    entry_points: tuple[tuple[str, str], ...] = ()
    sitemap_url: str | None = None
    archive_mark: str | None = None
    edition_selector: str | None = None
    link_selector: str | None = None
    link_mode: str = "css"
    page_param: str = "page"
    last_page_selector: str | None = None
    next_selector: str | None = None
    dedup_scope: str = "site"
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    jsonld_type: str | None = None
    jsonld_fields: Mapping[str, str] = field(default_factory=dict)
    selectors: Mapping[str, str] = field(default_factory=dict)
    date_attr: str = "datetime"
    image_container: str | None = None
    image_base_url: str | None = None
    lazy_images: bool = False
    publisher: str | None = None
    category_rule: str = "merged_or_listing"
    prefix_categories: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for value, known in (
            (self.link_mode, LINK_MODES),
            (self.category_rule, CATEGORY_RULES),
            (self.dedup_scope, DEDUP_SCOPES),
        ):
            if value not in known:
                raise ValueError(f"site {self.site}: {value!r} is none of {known}")
        if not self.brand:
            object.__setattr__(self, "brand", self.site)

    @classmethod
    def from_tree(cls, site: str, tree: Mapping, **extra) -> "SiteRules":
        """Rules from a parsed site configuration tree.

        Keys: ``brand``, ``entry_points``, ``sitemap_url``, ``pagination``,
        ``listing``, ``extraction.{jsonld,dom_fallback,images}``, ``url_filters``.
        Disabled extractors leave their rules empty, so nothing runs for them.
        """
        extraction = tree.get("extraction", {})
        jsonld = extraction.get("jsonld", {})
        dom = extraction.get("dom_fallback", {})
        images = extraction.get("images", {})
        listing = tree.get("listing", {})
        paging = tree.get("pagination", {})
        filters = tree.get("url_filters", {})
        for key, paths in LINK_PATHS.items():
            if (path := listing.get(key)) is not None:
                if path not in paths:
                    raise ValueError(f"site {site}: listing.{key} {path!r} is not supported, use link_selector")
                extra.setdefault("link_mode", paths[path])
        return cls(
            site=site,
            brand=tree.get("brand", site),
            entry_points=tuple((e["url"], e.get("category", "")) for e in tree.get("entry_points", ())),
            sitemap_url=tree.get("sitemap_url"),
            edition_selector=listing.get("edition_selector"),
            link_selector=listing.get("link_selector"),
            page_param=paging.get("page_param", "page"),
            last_page_selector=paging.get("last_page_selector"),
            next_selector=paging.get("next_page_selector"),
            include=tuple(filters.get("include", ())),
            exclude=tuple(filters.get("exclude", ())),
            jsonld_type=jsonld.get("type_filter"),
            jsonld_fields=dict(jsonld.get("field_map", {})) if jsonld.get("enabled") else {},
            selectors=dict(dom.get("selectors", {})) if dom.get("enabled") else {},
            image_container=images.get("container"),
            image_base_url=images.get("base_url"),
            lazy_images=images.get("lazy_load", False),
            **extra,
        )

    def with_(self, **changes) -> "SiteRules":
        return replace(self, **changes)


Rules = Mapping[str, SiteRules]


def default_rules(sites: Iterable[str] | None = None) -> dict[str, SiteRules]:
    """Rules of the eight built-in sites, or of the named ones."""
    wanted = list(sites) if sites is not None else list(_SITE_TREES)
    unknown = [s for s in wanted if s not in _SITE_TREES]
    if unknown:
        raise KeyError(f"no rules for site {', '.join(unknown)}; known: {', '.join(_SITE_TREES)}")
    out = {}
    for site in wanted:
        tree = dict(_SITE_TREES[site])
        out[site] = SiteRules.from_tree(site, tree, **tree.pop("hooks", {}))
    return out


def by_site(site: Column | str, rules: Rules, make: Callable[[SiteRules], Column | None]) -> Column:
    """``CASE site WHEN ... THEN make(rules) ... END``; null where a site has no branch."""
    site = F.col(site) if isinstance(site, str) else site
    branches = [(name, made) for name, r in rules.items() if (made := make(r)) is not None]
    if len(rules) == 1 and branches:
        return F.when(site == branches[0][0], branches[0][1])
    out = None
    for name, made in branches:
        out = F.when(site == name, made) if out is None else out.when(site == name, made)
    return F.lit(None) if out is None else out


def allowed_by_rules(site: Column | str, url: Column | str, rules: Rules) -> Column:
    """URL filter of every site in one expression; unknown sites keep nothing."""
    return F.coalesce(by_site(site, rules, lambda r: url_allowed(url, r.include, r.exclude)), F.lit(False))


def category_from_prefix(site: Column | str, url: Column | str, rules: Rules) -> Column:
    hit = by_site(
        site, rules, lambda r: prefix_category(url, r.prefix_categories) if r.prefix_categories else None
    )
    return F.coalesce(hit.cast("string"), F.lit(""))


def rule_tables(spark: SparkSession, rules: Rules) -> dict[str, DataFrame]:
    """The rules as dimension tables."""
    seeds, filters, paths, selectors = [], [], [], []
    for r in rules.values():
        seeds += [(r.site, n, url, category) for n, (url, category) in enumerate(r.entry_points)]
        filters += [(r.site, "include", p) for p in r.include] + [(r.site, "exclude", p) for p in r.exclude]
        paths += [(r.site, f, p) for f, p in r.jsonld_fields.items()]
        selectors += [(r.site, f, s, SELECTOR_MODES.get(f, "text")) for f, s in r.selectors.items()]
    return {
        "entry_points": spark.createDataFrame(seeds, schemas.ENTRY_POINTS),
        "url_rules": spark.createDataFrame(filters, schemas.URL_RULES),
        "field_map": spark.createDataFrame(paths, schemas.FIELD_MAP),
        "selectors": spark.createDataFrame(selectors, schemas.SELECTORS),
    }


SELECTOR_MODES = {"body": "html", "date": "attr", "category": "list", "tags": "list"}
