"""URL, text and date functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.checks.registry import check, table, text
from folioflow.functions.normalize import content_hash, item_hash, item_key, normalize_date, publish_date, strip
from folioflow.functions.urls import prefix_category, resolve_url, set_query_param, url_to_slug
from folioflow.sources.pages import read_pages


@check("SELECT page_id, url, length(html) AS html_chars FROM pages")
def q_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = read_pages(spark, f"{d}/pages.parquet", ["page_id", "url", "html"])
    return pages.select("page_id", "url", F.length("html").alias("html_chars"))


@check(
    r"""
    WITH p AS (SELECT page_id, url, trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS path FROM pages),
    s AS (SELECT page_id, url,
                 lower(trim(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '[^a-zA-Z0-9]+', '-', 'g'), '-')) AS s FROM p)
    SELECT page_id, url, CASE WHEN s = '' THEN 'index' ELSE s[1:80] END AS slug FROM s
    UNION ALL
    SELECT doc_id, NULL, CASE WHEN s = '' THEN 'index' ELSE s[1:80] END FROM (
        SELECT doc_id, lower(trim(regexp_replace(text, '[^a-zA-Z0-9]+', '-', 'g'), '-')) AS s
        FROM (SELECT doc_id, replace(replace(replace(replace(text, '/', ' '), '?', ' '), '#', ' '), ';', ' ') AS text FROM documents))
    """
)
def q_slug(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", url_to_slug("url").alias("slug"))
    # Whole texts as last path segment: long and full of other characters.
    headline = F.translate("text", "/?#;", "    ")
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("page_id"),
        F.lit(None).cast("string").alias("url"),
        url_to_slug(text("=https://library.example.org/item/", headline)).alias("slug"),
    )
    return pages.unionByName(docs)


@check(
    r"""
    SELECT o_orderkey, o_orderdate_text, CASE WHEN layout = 8 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
           CASE WHEN layout = 8 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS valid_day
    FROM (
      SELECT o_orderkey, o_orderdate, layout, CASE layout
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT23:30:00-05:00')
        WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT01:02:03')
        WHEN 2 THEN strftime(o_orderdate, '  %Y-%m-%d ')
        WHEN 3 THEN strftime(o_orderdate, '%B %d, %Y')
        WHEN 4 THEN strftime(o_orderdate, '%b %d, %Y')
        WHEN 5 THEN strftime(o_orderdate, '%m/%d/%Y')
        WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%d 10:00')
        WHEN 7 THEN CASE WHEN day(o_orderdate) > 12 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%dT99:99') END
        ELSE strftime(o_orderdate, 'on %d.%m.%Y') END AS o_orderdate_text
      FROM (SELECT *, o_orderkey % 9 AS layout FROM orders))
    """
)
def q_dates(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    when = F.col("o_orderdate")
    layouts = [
        "yyyy-MM-dd'T23:30:00-05:00'",
        "yyyy-MM-dd'T01:02:03'",
        "'  'yyyy-MM-dd' '",
        "MMMM dd, yyyy",
        "MMM dd, yyyy",
        "MM/dd/yyyy",
        "yyyy-MM-dd' 10:00'",
        None,
        "'on 'dd.MM.yyyy",
    ]
    shown = [
        F.date_format(when, p)
        if p
        else F.when(F.dayofmonth(when) > 12, F.date_format(when, "dd/MM/yyyy")).otherwise(
            F.date_format(when, "yyyy-MM-dd'T99:99'")
        )
        for p in layouts
    ]
    written = F.get(F.array(*shown), (F.col("o_orderkey") % 9).cast("int"))
    dated = orders.select("o_orderkey", written.alias("o_orderdate_text"))
    day = normalize_date("o_orderdate_text")
    return dated.select(
        "o_orderkey", "o_orderdate_text", day.alias("day"), publish_date(day).cast("string").alias("valid_day")
    )


@check(
    """
    SELECT doc_id, sha256(text) AS content_hash, CASE WHEN coalesce(toxic, 0) = 1 THEN '' ELSE sha256(text) END AS item_hash
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def q_hash(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    body = F.when(F.coalesce("toxic", F.lit(0)) == 1, F.lit("")).otherwise(F.col("text"))
    return docs.select("doc_id", content_hash("text").alias("content_hash"), item_hash(body).alias("item_hash"))


@check(
    r"""
    SELECT event_id, trim(event_type) AS label,
           CASE WHEN event_type = 'view' THEN '/canonical/' || user_id WHEN event_type = 'error' THEN '' ELSE '/source/' || event_id END AS item_key
    FROM events
    """
)
def q_item_key(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    kind = F.col("event_type")
    source = F.when(kind == "view", F.lit("")).when(kind != "error", text("=/source/", "event_id"))
    canonical = F.when(kind != "error", text("=/canonical/", "user_id"))
    return events.select(
        "event_id",
        strip(text("=\n\t ", "event_type", "= \r\n")).alias("label"),
        item_key(source, canonical).alias("item_key"),
    )


_LABELS = {"/en/": "English", "/fr/": "French", "/de/": "German"}


@check(
    r"""
    SELECT page_id, url, CASE WHEN path LIKE '/en/%' THEN 'English' WHEN path LIKE '/fr/%' THEN 'French'
                              WHEN path LIKE '/de/%' THEN 'German' ELSE '' END AS category
    FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
    """
)
def q_prefix_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", "url", prefix_category("url", _LABELS).alias("category"))


@check(
    r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://([^/]*)(/[^?#]*)', ['scheme', 'host', 'path']) AS m,
                      regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages),
    r AS (SELECT page_id, url, m.scheme AS scheme, m.host AS host, m.path AS path,
                 regexp_replace(m.path, '[^/]*$', '') AS folder, query FROM p)
    SELECT page_id, 'absolute' AS kind, 'https://other.example.org/a/../b?x=1#y' AS resolved FROM r
    UNION ALL SELECT page_id, 'other scheme', 'mailto:desk@example.org' FROM r
    UNION ALL SELECT page_id, 'host', scheme || '://cdn.example.org/lib.js' FROM r
    UNION ALL SELECT page_id, 'rooted', scheme || '://' || host || '/top/leaf-' || page_id FROM r
    UNION ALL SELECT page_id, 'relative', scheme || '://' || host || folder || 'leaf-' || page_id || '?v=2' FROM r
    UNION ALL SELECT page_id, 'dots', scheme || '://' || host || '/up/leaf-' || page_id FROM r
    UNION ALL SELECT page_id, 'query', scheme || '://' || host || path || '?page=' || page_id FROM r
    UNION ALL SELECT page_id, 'fragment', scheme || '://' || host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END || '#end' FROM r
    """
)
def q_resolve_url(spark: SparkSession, d: str) -> DataFrame:
    forms = {
        "absolute": F.lit("https://other.example.org/a/../b?x=1#y"),
        "other scheme": F.lit("mailto:desk@example.org"),
        "host": F.lit("//cdn.example.org/lib.js"),
        "rooted": text("=/top/leaf-", "page_id"),
        "relative": text("=leaf-", "page_id", "=?v=2"),
        "dots": text("=../../../up/./x/../leaf-", "page_id"),
        "query": text("=?page=", "page_id"),
        "fragment": F.lit("#end"),
    }
    refs = F.array(*[F.struct(F.lit(k).alias("kind"), h.alias("href")) for k, h in forms.items()])
    hrefs = table(spark, d, "pages").select("page_id", "url", F.explode(refs).alias("ref"))
    return hrefs.select("page_id", "ref.kind", resolve_url("url", "ref.href").alias("resolved"))


@check(
    r"""
    SELECT event_id, 'https://shop.example.org/list?tag=a%20b'.replace('%20', '+') || '&tag=' || event_type
           || '&page=' || user_id || '&sort=%2Aup~' AS url
    FROM events
    """
)
def q_query_param(spark: SparkSession, d: str) -> DataFrame:
    before = text("=https://shop.example.org/list?tag=a%20b&page=0&blank=&tag=", "event_type", "=&sort=*up~#part")
    return table(spark, d, "events").select(
        "event_id", set_query_param(before, "page", F.col("user_id")).alias("url")
    )
