"""Extraction operators. Page texts the tables do not have are built from columns of
whole tables; the SQL states the expected values from those columns directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.checks.registry import check, joined, table, text
from folioflow.functions.jsonld import dot_path, item_type, jsonld_blocks, jsonld_items, variant_text, variant_texts
from folioflow.operators.extraction import (
    HTML,
    TEXT,
    Take,
    article_fields,
    breadcrumb_categories,
    clean_body,
    dom_select,
    extract_jsonld,
    flag_captcha,
    merge_fields,
)
from folioflow.operators.items import assemble_items, extract_pages, image_table, resolve_categories
from folioflow.rules import CATEGORY_RULES, SiteRules
from folioflow.session import spread_small


def _one_site(df: DataFrame, html: Column, *keep: str) -> DataFrame:
    cols = [F.lit("s").alias("site"), F.lit("https://s.example.org/page").alias("url"), html.alias("html")]
    return spread_small(df).select(*keep, *cols)


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _block(body: Column) -> Column:
    return text('=<script type="application/ld+json">', body, "=</script>")


def _folded(markup: Column) -> Column:
    """Text of cleaned markup with tags removed and white space folded."""
    plain = F.regexp_replace(markup, "<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


_HEADING = "trim(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&quot;', chr(34)), '&amp;', '&'))"
_ARTICLE = (
    "trim(regexp_replace(replace(replace(regexp_replace(regexp_extract(html, '<article>(.*?)</article>', 1, 's'),"
    r" '<[^>]*>', ' ', 'g'), '&quot;', chr(34)), '&amp;', '&'), '\s+', ' ', 'g'))"
)


@check(f"SELECT page_id, url, {_HEADING} AS title FROM pages")
def q_dom_title(spark: SparkSession, d: str) -> DataFrame:
    pages = spread_small(table(spark, d, "pages").withColumn("site", F.lit("s")))
    found = dom_select(pages, {"s": {"title": Take(TEXT, "article > h1")}})
    return found.select("page_id", "url", F.col("dom.title").alias("title"))


@check(f"SELECT page_id, {_ARTICLE} AS body_text FROM pages")
def q_body_text(spark: SparkSession, d: str) -> DataFrame:
    pages = spread_small(table(spark, d, "pages").withColumn("site", F.lit("s")))
    found = dom_select(pages, {"s": {"body": Take(HTML, "article")}})
    return found.select("page_id", _folded(F.col("dom.body")).alias("body_text"))


@check(
    """
    SELECT doc_id, '<html><body><div class="a" id="d' || doc_id || '"><p>' || lang || ' &amp; ' || source || ' &lt; 1</p><br/><b>x</b></div></body></html>' AS body
    FROM documents
    """
)
def q_clean_body(spark: SparkSession, d: str) -> DataFrame:
    markup = text(
        "=<DIV class='a' id=d", "doc_id", "=><!-- note --><nav>menu</nav><p>", "lang", "= &amp; ", "source",
        "= &lt; 1<script>var a = '<p>';</script></p><br><b>x</b><footer>end</footer><noscript>n</noscript></DIV>",
    )
    docs = spread_small(table(spark, d, "documents").select("doc_id", "lang", "source"))
    return docs.select("doc_id", clean_body(markup).alias("body"))


@check(
    r"""
    SELECT page_id, brand, title, source_url, canonical_url, category, categories, publisher, body_text, missing, _scraped_at FROM (
        SELECT page_id, regexp_extract(url, 'example\.([a-z]+)', 1) AS brand, title, url AS source_url, url AS canonical_url,
               CASE WHEN contains(url, 'example.net') THEN regexp_extract(nav, '([^|]*)$', 1)
                    ELSE regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1) END AS category,
               CASE WHEN contains(url, 'example.net') THEN nav ELSE regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1) END AS categories,
               CASE WHEN contains(url, 'example.org') THEN 'The Desk' ELSE '' END AS publisher,
               CASE WHEN contains(url, 'example.com') THEN '' ELSE body END AS body_text,
               CASE WHEN contains(url, 'example.com') THEN 'body' ELSE '' END AS missing,
               '2024-05-0' || (1 + mod(page_id, 9)) AS _scraped_at
        FROM (SELECT page_id, url, %s AS title, %s AS body,
                     array_to_string(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '>([^<]+)</a>', 1), '|') AS nav FROM pages))
    """
    % (_HEADING, _ARTICLE)
)
def q_items(spark: SparkSession, d: str) -> DataFrame:
    """Pages to items under three rule sets, told apart by the top-level domain."""
    rules = {
        "com": SiteRules("com", selectors={"title": "h1"}, category_rule="listing"),
        "net": SiteRules(
            "net", selectors={"title": "h1", "body": "article", "category": "nav li a"}, category_rule="merged_or_listing"
        ),
        "org": SiteRules(
            "org", selectors={"title": "article h1", "body": "article"}, category_rule="list_or_listing", publisher="The Desk"
        ),
    }
    pages = table(spark, d, "pages").select(
        "page_id",
        "url",
        F.regexp_extract("url", r"example\.([a-z]+)", 1).alias("site"),
        F.regexp_extract("url", "^[a-z]+://[^/]*/([a-z]+)", 1).alias("listing_category"),
        "html",
        F.to_timestamp(text("=2024-05-0", F.col("page_id") % 9 + 1)).alias("fetched_at"),
    )
    items = assemble_items(extract_pages(spread_small(pages), rules), rules, keep=("page_id",))
    return items.select(
        "page_id",
        "brand",
        "title",
        "source_url",
        "canonical_url",
        "category",
        joined("categories").alias("categories"),
        F.coalesce("publisher", F.lit("")).alias("publisher"),
        F.coalesce(_folded(F.col("body")), F.lit("")).alias("body_text"),
        joined("_missing_fields").alias("missing"),
        F.date_format("_scraped_at", "yyyy-MM-dd").alias("_scraped_at"),
    )


@check(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS time_date, strftime(ts, '%d.%m.%Y') AS content_date,
           strftime(ts, '%B %Y') AS text_date, event_type || '|' || user_id AS tags,
           CASE WHEN event_type = 'view' THEN 'By ' || user_id ELSE 'inner' || user_id || 'tail' END AS author,
           'third ' || event_id AS third
    FROM events
    """
)
def q_dom_fields(spark: SparkSession, d: str) -> DataFrame:
    date, dotted = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "dd.MM.yyyy")
    author = F.when(F.col("event_type") == "view", text("= By ", "user_id", "= <i>x</i>")).otherwise(
        text("=<i> inner", "user_id", "= </i> <b>tail</b>")
    )
    html = text(
        "=<time>no date</time><time datetime='", date, "='>x</time>",
        '=<span property="schema:dateCreated" content="', dotted, '=">y</span>',
        "=<span class='x artdate big'>\n ", F.date_format("ts", "MMMM yyyy"), "= </span>",
        "=<div class='tags'><a>", "event_type", "=</a><a> </a><p><a> ", "user_id", "=</a></div><div class='by'>", author, "=</div>",
        "=<div class='col w'><p>0</p><div>first</div><div>second</div><div>third ", "event_id", "=</div></div>",
    )
    takes = {
        "time_date": Take("attr", "time[datetime]", "datetime"),
        "content_date": Take("attr", 'span[property="schema:dateCreated"]', "content"),
        "text_date": Take(TEXT, "span.artdate"),
        "tags": Take("list", "div.tags a"),
        "author": Take(TEXT, "#none, div.by"),
        "third": Take(TEXT, "div.col.w > div:nth-of-type(3)"),
    }
    found = dom_select(_one_site(table(spark, d, "events"), html, "event_id"), {"s": takes})
    return found.select("event_id", "dom.time_date", "dom.content_date", "dom.text_date", joined("dom.tags").alias("tags"), "dom.author", "dom.third")


@check(
    """
    SELECT event_id, pos, CASE WHEN pos = 0 THEN 'https://img.example.org/a/' || user_id || '.png' ELSE 'https://cdn.example.org/' || event_type || '.jpg' END AS url,
           CASE WHEN pos = 0 THEN 'User ' || user_id ELSE '' END AS alt, CASE WHEN pos = 0 THEN 'Seen' || event_type ELSE '' END AS caption
    FROM (SELECT *, unnest(CASE WHEN event_type = 'error' THEN []::INT[] WHEN event_type = 'view' THEN [0] ELSE [0, 1] END) AS pos FROM events)
    """
)
def q_images(spark: SparkSession, d: str) -> DataFrame:
    rules = {
        "s": SiteRules("s", image_container="div.body", image_base_url="https://img.example.org/x/y", lazy_images=True)
    }
    kind = F.col("event_type")
    second = F.when(kind == "view", F.lit("<img alt='no source'>")).otherwise(
        text("=<img data-src='https://cdn.example.org/", "event_type", "=.jpg'>")
    )
    html = text(
        F.when(kind == "error", F.lit("<div class='other'>")).otherwise("<div class='big body'>"),
        "=<figure><div><img src='../a/", "user_id", "=.png' alt=' User ", "user_id", "= '></div>",
        "=<figcaption>Seen <b>", "event_type", "=</b></figcaption></figure>", second, "=</div><img src='/outside.png'>",
    )
    pages = _one_site(table(spark, d, "events"), html, "event_id")
    found = dom_select(pages, article_fields(rules))
    items = found.select(F.lit("s").alias("brand"), F.col("event_id").alias("source_url"), F.col("dom.images").alias("images"))
    return image_table(items).withColumnRenamed("source_url", "event_id").drop("brand")


@check(
    """
    SELECT event_id, event_type IN ('view', 'click') AS captcha_detected FROM events
    """
)
def q_captcha(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    mark = F.when(kind == "view", F.lit('<div class="CF-Turnstile">')).when(kind == "click", F.lit("hCaptcha")).otherwise("")
    late = F.when(kind == "error", F.lit("captcha")).otherwise("challenge_form")
    html = F.concat(F.lit("<html>"), F.repeat(F.lit("x "), 2400), mark, F.repeat(F.lit("y"), 300), late)
    pages = spread_small(table(spark, d, "events")).select("event_id", html.alias("html"))
    return flag_captcha(pages).select("event_id", "captcha_detected")


@check(
    """
    SELECT doc_id, source || '|Home Office' || CASE WHEN lang = 'en' THEN '' ELSE '|' || lang END AS categories,
           CASE WHEN lang = 'en' THEN 'Home Office' ELSE lang END AS category
    FROM documents
    """
)
def q_categories(spark: SparkSession, d: str) -> DataFrame:
    last = F.when(F.col("lang") == "en", F.lit("HOME ")).otherwise(F.col("lang"))
    html = text(
        '=<nav class="breadcrumb"><ol><li><a href="/"> Home</a><li><a> ', "source", "=</a></li><li><a>Home Office</a>",
        "=<li><a> </a></li><li><a>", last, "=</a></ol></nav>",
    )
    pages = _one_site(table(spark, d, "documents"), html, "doc_id")
    found = dom_select(pages, {"s": {"categories": Take("list", "nav.breadcrumb ol li a")}})
    crumbs = found.select("doc_id", breadcrumb_categories("dom.categories").alias("c"))
    return crumbs.select("doc_id", joined("c").alias("categories"), F.element_at("c", -1).alias("category"))


@check(
    """
    WITH e AS (SELECT event_id, ['merged_or_listing', 'list_or_listing', 'first', 'first_or_listing', 'topics_and_tags', 'listing', 'prefix'][1 + user_id % 7] AS rule,
               event_type AS listing, CASE WHEN value > 60 THEN 'top' || user_id END AS category,
               CASE WHEN event_type IN ('view', 'error') THEN ['a' || user_id, 'b'] END AS list FROM events)
    SELECT event_id, rule, CASE rule
        WHEN 'merged_or_listing' THEN coalesce(category, listing) WHEN 'list_or_listing' THEN coalesce(category, listing)
        WHEN 'first' THEN list[1] WHEN 'first_or_listing' THEN coalesce(list[1], listing)
        WHEN 'topics_and_tags' THEN coalesce(list[1], 'b') WHEN 'listing' THEN listing ELSE 'Docs' END AS category,
      CASE WHEN rule IN ('merged_or_listing', 'first') THEN coalesce(array_to_string(list, '|'), '')
           WHEN rule IN ('list_or_listing', 'first_or_listing') THEN coalesce(array_to_string(list, '|'), listing)
           WHEN rule = 'topics_and_tags' THEN coalesce(array_to_string(list, '|'), 'b') || '|tag'
           WHEN rule = 'listing' THEN listing ELSE '' END AS categories
    FROM e
    """
)
def q_category_rule(spark: SparkSession, d: str) -> DataFrame:
    rules = {r: SiteRules(r, category_rule=r) for r in CATEGORY_RULES}
    names = F.array(*[F.lit(r) for r in CATEGORY_RULES])
    events = table(spark, d, "events").withColumn("site", F.get(names, (F.col("user_id") % 7).cast("int")))
    some = F.col("event_type").isin("view", "error")
    category, categories = resolve_categories(
        rules,
        category=F.when(F.col("value") > 60, text("=top", "user_id")),
        categories=F.when(some, F.array(text("=a", "user_id"), F.lit("b"))),
        tags=F.array(F.lit(" b"), F.lit(""), F.lit("tag ")),
        listing=F.col("event_type"),
        prefix=F.lit("Docs"),
    )
    return events.select(
        "event_id", F.col("site").alias("rule"), category.alias("category"), joined(categories).alias("categories")
    )


@check(
    """
    SELECT doc_id, text AS title, CASE WHEN lang = 'en' THEN source ELSE 'second' END AS author, '2024-01-0' || (1 + doc_id % 9) || 'T10:00:00-05:00' AS date_published,
           lang || '|' || source AS categories, CASE WHEN lang = 'de' THEN NULL ELSE 'd' || n_chars END AS description
    FROM documents
    """
)
def q_jsonld(spark: SparkSession, d: str) -> DataFrame:
    """Several blocks per page: broken, of another type, and two that share the fields."""
    rules = {
        "s": SiteRules(
            "s",
            jsonld_type="Article",
            jsonld_fields={
                "title": "headline",
                "author": "author.name",
                "date_published": "datePublished",
                "categories": "about",
                "description": "description",
            },
        )
    }
    first = _json(
        **{
            "@type": F.lit("Article"),
            "headline": F.col("text"),
            "author": F.struct(F.when(F.col("lang") == "en", F.col("source")).alias("name"), F.lit("Person").alias("@type")),
            "datePublished": text("=2024-01-0", F.col("doc_id") % 9 + 1, "=T10:00:00-05:00"),
            "about": F.array("lang", "source"),
        }
    )
    second = _json(
        **{
            "@type": F.array(F.lit("Article"), F.lit("Thing")),
            "headline": F.lit("late"),
            "author": F.array(F.struct(F.lit("second").alias("name"))),
            "description": F.when(F.col("lang") != "de", text("=d", "n_chars")),
        }
    )
    other = _json(**{"@type": F.lit("WebPage"), "headline": F.lit("wrong type"), "description": F.lit("wrong")})
    html = text(
        '=<head><!-- <script type="application/ld+json">{"@type":"Article","headline":"in a comment"}</script> -->',
        _block(other), _block(F.lit('{"@type": "Article", "headline": ')), _block(first), "=<script>var x = 1;</script>",
        _block(second), "=</head>",
    )
    found = extract_jsonld(_one_site(table(spark, d, "documents"), html, "doc_id"), rules)
    return found.select(
        "doc_id", "jsonld.title", "jsonld.author", "jsonld.date_published", "jsonld.description",
        joined("jsonld.categories").alias("categories"),
    )


@check(
    """
    SELECT event_id, pos, kind, label FROM (
      SELECT event_id, unnest(CASE WHEN event_type = 'click' THEN [{'pos': 0, 'kind': 'WebPage', 'label': 'p' || user_id}, {'pos': 1, 'kind': 'Person', 'label': event_type}]
        WHEN event_type = 'view' THEN [{'pos': 0, 'kind': 'List', 'label': 'l' || user_id}]
        WHEN event_type = 'error' THEN []
        ELSE [{'pos': 0, 'kind': 'Event', 'label': 'n' || user_id}] END, recursive := true) FROM events)
    """
)
def q_jsonld_graph(spark: SparkSession, d: str) -> DataFrame:
    """``@graph``, list, object and scalar roots; elements that are no object are left out."""
    kind = F.col("event_type")
    graph = text('={"@graph": [{"@type": ["WebPage", "X"], "n": "p', "user_id", '="}, 7, "text", {"@type": "Person", "n": "', "event_type", '="}]}')
    listed = text('=[[1], {"@type": "List", "n": "l', "user_id", '="}, null]')
    single = text('={"@type": "Event", "@graph": {"@type": "Hidden"}, "n": "n', "user_id", '="}')
    body = F.when(kind == "click", graph).when(kind == "view", listed).when(kind == "error", F.lit("42")).otherwise(single)
    items = table(spark, d, "events").select("event_id", F.posexplode(jsonld_items(jsonld_blocks(_block(body)))).alias("pos", "item"))
    item = F.col("item")
    return items.select("event_id", "pos", item_type(item).alias("kind"), variant_text(dot_path(item, "n")).alias("label"))


@check(
    """
    SELECT event_id, event_type AS deep, 'u' || user_id AS in_list, NULL::VARCHAR AS absent, NULL::VARCHAR AS null_value,
           'a' || user_id || '|b' AS whole_list, 'id' || event_id AS at_id, CAST(user_id AS VARCHAR) AS number
    FROM events
    """
)
def q_jsonld_path(spark: SparkSession, d: str) -> DataFrame:
    body = text(
        '={"a": {"b": {"c": "', "event_type", '="}}, "l": [{"m": [{"n": "u', "user_id", '="}]}, {"m": 1}], "z": null, ',
        '="list": ["a', "user_id", '=", "b"], "@id": "id', "event_id", '=", "num": ', "user_id", "=}",
    )
    items = table(spark, d, "events").select("event_id", F.get(jsonld_items(jsonld_blocks(_block(body))), F.lit(0)).alias("i"))
    i = F.col("i")
    texts = {"deep": "a.b.c", "in_list": "l.m.n", "absent": "a.x.c", "null_value": "z", "at_id": "@id", "number": "num"}
    return items.select(
        "event_id",
        *[variant_text(dot_path(i, p)).alias(n) for n, p in texts.items()],
        joined(variant_texts(dot_path(i, "list"))).alias("whole_list"),
    )


@check(
    """
    SELECT doc_id, CASE WHEN site = 'dom' OR lang = 'en' THEN 'dom ' || lang ELSE 'ld ' || source END AS title,
           CASE WHEN site = 'ld' THEN NULL ELSE 'by ' || lang END AS author,
           CASE WHEN site = 'dom' THEN NULL ELSE 'about ' || lang END AS description
    FROM (SELECT *, ['both', 'dom', 'ld'][1 + doc_id % 3] AS site FROM documents) WHERE site <> 'ld' OR lang <> 'en'
    UNION ALL
    SELECT doc_id, NULL, NULL, 'about ' || lang FROM documents WHERE doc_id % 3 = 2 AND lang = 'en'
    """
)
def q_merge(spark: SparkSession, d: str) -> DataFrame:
    """JSON-LD wins where it has a value; sites with one extractor switched off get only the other."""
    selectors, paths = {"title": "h1", "author": ".by"}, {"title": "headline", "description": "description"}
    rules = {
        "both": SiteRules("both", selectors=selectors, jsonld_fields=paths),
        "dom": SiteRules("dom", selectors=selectors),
        "ld": SiteRules("ld", jsonld_fields=paths),
    }
    names = F.array(*[F.lit(n) for n in ("both", "dom", "ld")])
    headline = F.when(F.col("lang") == "en", F.lit("")).otherwise(text("=ld ", "source"))
    block = _block(_json(headline=headline, description=text("=about ", "lang")))
    html = F.concat(block, text("=<h1>dom ", "lang", '=</h1><p class="x by">by ', "lang", "=</p>"))
    docs = _one_site(table(spark, d, "documents"), html, "doc_id").withColumn(
        "site", F.get(names, (F.col("doc_id") % 3).cast("int"))
    )
    merged = merge_fields(extract_jsonld(dom_select(docs, article_fields(rules)), rules))
    return merged.select("doc_id", "merged.title", "merged.author", "merged.description")
