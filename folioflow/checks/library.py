"""Reports, the content table and search over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.checks.change import doc_items
from folioflow.checks.registry import check, joined, table, text
from folioflow.operators.lake import fetch_items, list_items, mark_rejects, upsert_items, upsert_table
from folioflow.operators.lake_layout import list_page, write_clustered
from folioflow.operators.quality import annotate_missing
from folioflow.operators.reports import (
    CATEGORY_WORDS,
    MODEL_NAMES,
    TAG_WORDS,
    classify_terms,
    missing_profile,
    sample_pages,
    shared_content,
    shared_content_members,
    to_library,
    vocabulary_report,
    volume_check,
)
from folioflow.operators.search import search_text, search_vector
from folioflow.operators.text_index import build_text_index, search_index
from folioflow.operators.vector_index import build_vector_index, search_cells
from folioflow.session import cut_lineage, join_path, shared_dir

_MISSING = """
    m AS (SELECT doc_id, source AS brand, lang = 'fr' OR coalesce(toxic, 0) = 1 AS no_title, coalesce(quality, 1) = 0 AS no_body,
                 quality IS NULL AND lang = 'de' AS no_url FROM documents LEFT JOIN labels USING (doc_id))
"""


@check(
    f"""
    WITH {_MISSING}
    SELECT brand, count(*) AS items, count_if(NOT no_title AND NOT no_body AND NOT no_url) AS complete,
           count_if(no_title) AS missing_title, count_if(no_body) AS missing_body, count_if(no_url) AS missing_source_url
    FROM m GROUP BY brand
    """
)
def q_missing_profile(spark: SparkSession, d: str) -> DataFrame:
    return missing_profile(annotate_missing(doc_items(spark, d)))


@check(
    """
    SELECT brand, coalesce(found, 0) AS found, expected, round(coalesce(found, 0) / expected, 4) AS ratio
    FROM (SELECT source AS brand, count(*) AS found FROM documents GROUP BY source)
    FULL JOIN (VALUES ('src0', 300), ('src1', 1000), ('src2', 250), ('gone', 250)) AS e(brand, expected) USING (brand)
    """
)
def q_volume(spark: SparkSession, d: str) -> DataFrame:
    return volume_check(doc_items(spark, d), {"src0": 300, "src1": 1000, "src2": 250, "gone": 250})


@check(
    """
    SELECT brand, source_url, sample_no FROM (
        SELECT source AS brand, '/doc/' || doc_id AS source_url,
               row_number() OVER (PARTITION BY source ORDER BY sha256('/doc/' || doc_id || '7'), doc_id) AS sample_no FROM documents)
    WHERE sample_no <= 5
    """
)
def q_sample(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").select(
        F.col("source").alias("brand"), text("=/doc/", "doc_id").alias("source_url")
    )
    return sample_pages(items, 5, seed="7").select("brand", "source_url", "sample_no")


@check(
    """
    SELECT lang AS brand, sha256(text) AS content_hash, count(DISTINCT doc_id) AS n_urls, count(*) AS n_items,
           min('/doc/' || doc_id) AS first_url, max('/doc/' || doc_id) AS last_url
    FROM documents GROUP BY lang, text HAVING count(DISTINCT doc_id) > 1
    """
)
def q_shared_content(spark: SparkSession, d: str) -> DataFrame:
    return shared_content(_hashed(spark, d))


@check(
    """
    SELECT brand, content_hash, url, n_urls FROM (
        SELECT lang AS brand, sha256(text) AS content_hash, '/doc/' || doc_id AS url, count(*) OVER (PARTITION BY lang, text) AS n_urls FROM documents)
    WHERE n_urls > 1
    """
)
def q_shared_members(spark: SparkSession, d: str) -> DataFrame:
    return shared_content_members(_hashed(spark, d))


def _hashed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("lang").alias("brand"),
        text("=/doc/", "doc_id").alias("source_url"),
        F.sha2("text", 256).alias("_content_hash"),
    )


_TERMS = "['Risk ', lang, CASE WHEN doc_id % 2 = 0 THEN 'technology' ELSE source END]"


def _with_terms(spark: SparkSession, d: str) -> DataFrame:
    third = F.when(F.col("doc_id") % 2 == 0, F.lit("technology")).otherwise(F.col("source"))
    return table(spark, d, "documents").select("doc_id", F.array(F.lit("Risk "), F.col("lang"), third).alias("categories"))


@check(
    """
    SELECT doc_id, 'risk' || CASE WHEN doc_id % 2 = 0 THEN '|technology' ELSE '' END AS known,
           lang || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '|' || source END AS other
    FROM documents
    """
)
def q_vocab(spark: SparkSession, d: str) -> DataFrame:
    split = classify_terms(_with_terms(spark, d))
    return split.select("doc_id", joined("known_terms").alias("known"), joined("other_terms").alias("other"))


@check(
    f"""
    SELECT term, count(*) AS uses, term IN ('insurance', 'risk', 'finance', 'technology') AS in_vocabulary
    FROM (SELECT lower(trim(unnest({_TERMS}))) AS term FROM documents) GROUP BY term
    """
)
def q_vocab_report(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in CATEGORY_WORDS], "term string")
    return vocabulary_report(_with_terms(spark, d), words)


@check(
    """
    SELECT doc_id, split_part(text, chr(10), 1) AS library_title, text AS library_body_html, source AS library_published, '/doc/' || doc_id AS source_url
    FROM documents
    """
)
def q_library(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        F.col("source").alias("date_published"),
        text("=/doc/", "doc_id").alias("source_url"),
    )
    return to_library(items)


@check(
    """
    WITH e AS (SELECT *, CAST(props::JSON->>'k' AS INT) AS k FROM events),
    lake AS (SELECT user_id, arg_max(sha256(event_type), (ts, event_id)) AS hash, arg_max(event_id, (ts, event_id)) AS event_id FROM e WHERE k < 60 AND user_id % 5 <> 0 GROUP BY user_id),
    new AS (SELECT user_id, arg_max(sha256(event_type), (ts, event_id)) AS hash, arg_max(event_id, (ts, event_id)) AS event_id FROM e WHERE k >= 60 AND user_id % 5 <> 1 GROUP BY user_id)
    SELECT '/user/' || coalesce(l.user_id, n.user_id) AS source_url,
           CASE WHEN n.user_id IS NULL THEN 'kept' WHEN l.user_id IS NULL THEN 'inserted' WHEN l.hash = n.hash THEN 'unchanged' ELSE 'updated' END AS action,
           CASE WHEN n.user_id IS NULL OR l.hash = n.hash THEN l.event_id ELSE n.event_id END AS event_id
    FROM lake l FULL JOIN new n ON l.user_id = n.user_id
    """
)
def q_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A lake filled from one part of the events takes in the other part."""
    events = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    rows = events.select(
        "event_id",
        "ts",
        "k",
        "user_id",
        F.lit("b").alias("brand"),
        text("=/user/", "user_id").alias("source_url"),
        F.sha2("event_type", 256).alias("_content_hash"),
    )
    order = ("ts", "event_id")
    first = rows.filter("k < 60 AND user_id % 5 <> 0").drop("k", "user_id")
    second = rows.filter("k >= 60 AND user_id % 5 <> 1").drop("k", "user_id")
    lake = upsert_items(first.limit(0), first, order=order).drop("_action")
    return upsert_items(lake, second, order=order).select("source_url", F.col("_action").alias("action"), "event_id")


_TAGS = "[c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN ' Policy' WHEN c_custkey % 3 = 1 THEN 'claim ' ELSE 'insurtech' END, 'RISK']"


def _with_tags(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("c_custkey") % 3
    word = F.when(turn == 0, " Policy").when(turn == 1, "claim ").otherwise("insurtech")
    return table(spark, d, "customer").select("c_custkey", F.array(F.col("c_mktsegment"), word, F.lit("RISK")).alias("tags"))


@check(
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'policy|' WHEN c_custkey % 3 = 1 THEN 'claim|' ELSE '' END || 'risk' AS known,
           CASE WHEN c_custkey % 3 < 2 THEN lower(c_mktsegment) ELSE least(lower(c_mktsegment), 'insurtech') || '|' || greatest(lower(c_mktsegment), 'insurtech') END AS other
    FROM customer
    """
)
def q_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags against their own word list."""
    split = classify_terms(_with_tags(spark, d), TAG_WORDS, "tags")
    return split.select("c_custkey", joined("known_terms").alias("known"), joined("other_terms").alias("other"))


@check(
    f"""
    SELECT term, count(*) AS uses, term IN ('insurance', 'risk', 'finance', 'compliance', 'policy', 'claim', 'technology', 'insuretech', 'personal', 'commercial') AS in_vocabulary
    FROM (SELECT lower(trim(unnest({_TAGS}))) AS term FROM customer) GROUP BY term
    """
)
def q_tags_report(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in TAG_WORDS], "term string")
    return vocabulary_report(_with_tags(spark, d), words, "tags")


@check("SELECT doc_id, text AS summary, source AS publish_date, '/doc/' || doc_id AS url FROM documents")
def q_content_model(spark: SparkSession, d: str) -> DataFrame:
    """Items under the names of the content model."""
    items = table(spark, d, "documents").select(
        "doc_id",
        F.col("text").alias("description"),
        F.col("source").alias("date_published"),
        text("=/doc/", "doc_id").alias("source_url"),
    )
    return to_library(items, MODEL_NAMES)


_TABLE_SQL = """
    WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 3 > 0 THEN '/doc/' || doc_id // 2 END AS url,
                      CASE WHEN doc_id % 5 > 0 THEN '/doc/' || doc_id // 2 ELSE '' END AS other FROM documents),
    k AS (SELECT doc_id, text, coalesce(nullif(url, ''), other) AS key FROM d)
"""


@check(
    f"""
    {_TABLE_SQL}
    SELECT key, max(doc_id) AS doc_id, arg_max(text, doc_id) AS body, 'unchanged' AS action FROM k WHERE key <> '' GROUP BY key
    """
)
def q_upsert_table(spark: SparkSession, d: str) -> DataFrame:
    """Documents enter a stored table in two batches, the second one twice; keyless ones never do."""
    url = text("=/doc/", F.floor(F.col("doc_id") / 2))
    rows = table(spark, d, "documents").select(
        "doc_id",
        F.col("text").alias("body"),
        F.lit("b").alias("brand"),
        F.when(F.col("doc_id") % 3 > 0, url).alias("source_url"),
        F.when(F.col("doc_id") % 5 > 0, url).otherwise("").alias("canonical_url"),
        F.sha2(F.concat_ws("|", "doc_id", "text"), 256).alias("_content_hash"),
    )
    path = join_path(shared_dir(spark), f"upsert-{uuid.uuid4().hex}")
    half = F.col("doc_id") % 2 == 0
    upsert_table(spark, path, rows.filter(half), buckets=16, order=("doc_id",))
    for buckets in (16, 32):  # the table keeps the number it was made with
        actions = upsert_table(spark, path, rows, buckets=buckets, order=("doc_id",))
    stored = spark.read.parquet(path)
    return stored.join(actions, ["brand", "_key"]).select(
        F.col("_key").alias("key"), "doc_id", "body", F.col("_action").alias("action")
    )


@check(
    f"""
    WITH {_MISSING}
    SELECT doc_id, CASE WHEN doc_id % 2 = 1 AND no_url THEN 'no key'
        WHEN no_title OR no_body OR no_url THEN 'missing: ' || concat_ws(', ', CASE WHEN no_title THEN 'title' END, CASE WHEN no_body THEN 'body' END, CASE WHEN no_url THEN 'source_url' END) END AS reason
    FROM m
    """
)
def q_rejects(spark: SparkSession, d: str) -> DataFrame:
    marked = mark_rejects(annotate_missing(doc_items(spark, d)))
    return marked.select("doc_id", F.col("_reject_reason").alias("reason"))


_LIST_SQL = """
    WITH i AS (SELECT doc_id, lang, source, '2024-0' || (1 + doc_id % 9) || '-1' || (doc_id % 7) AS date_published, CASE WHEN doc_id % 3 = 0 THEN source END AS author FROM documents)
    SELECT doc_id, source AS brand, lang AS category, date_published FROM i
    WHERE lang = 'en' AND author = 'src3' AND date_published >= '2024-02-01' AND date_published <= '2024-08-31'
    """


@check(_LIST_SQL)
def q_list(spark: SparkSession, d: str) -> DataFrame:
    hits = list_items(
        doc_items(spark, d), category="en", author="src3", published_from="2024-02-01", published_to="2024-08-31"
    )
    return hits.select("doc_id", "brand", "category", "date_published")


@check(_LIST_SQL)
def q_list_pages(spark: SparkSession, d: str) -> DataFrame:
    """The same list page by page, from a table in curve order."""
    path = join_path(shared_dir(spark), f"curve-{uuid.uuid4().hex}")
    write_clustered(doc_items(spark, d), path)
    lake = spark.read.parquet(path)
    size = max(5, lake.count() // 200)
    wanted = {"category": "en", "author": "src3", "published_from": "2024-02-01", "published_to": "2024-08-31"}
    pages, last = None, None
    while True:
        page = cut_lineage(list_page(lake, size, last, **wanted).select("doc_id", "brand", "category", "date_published", "source_url"))
        pages = page if pages is None else pages.unionByName(page)
        end = page.orderBy(F.asc("date_published"), F.desc("brand"), F.desc("source_url")).first()
        if end is None:
            return pages.select("doc_id", "brand", "category", "date_published")
        last = end.asDict()


@check(
    """
    SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT user_id FROM events WHERE value > 20)
    """
)
def q_fetch(spark: SparkSession, d: str) -> DataFrame:
    lake = table(spark, d, "documents").withColumn("source_url", text("=/doc/", "doc_id"))
    ids = table(spark, d, "events").filter("value > 20").select(text("=/doc/", "user_id").alias("id"))
    return fetch_items(lake, ids).select("doc_id", "text")


_TEXT_SQL = r"""
    WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark),
    s AS (SELECT item_id, doc_id, sum((1 + ln(tf)) * ln((SELECT count(*) FROM documents) / df)) AS score
          FROM q JOIN tf USING (term) JOIN df USING (term) GROUP BY item_id, doc_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT item_id AS query_id, md5(text) AS text_md5, round(score, 4) AS score, rank FROM r JOIN documents USING (doc_id) WHERE rank <= 10
    """


@check(_TEXT_SQL)
def q_search_text(spark: SparkSession, d: str) -> DataFrame:
    queries = table(spark, d, "benchmark").withColumnRenamed("item_id", "query_id")
    hits = search_text(table(spark, d, "documents"), queries, k=10)
    # Copies of a text have one score, up to the order in which it was summed: they are told by their text.
    texts = table(spark, d, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    return hits.join(texts, "doc_id").select("query_id", "text_md5", F.round("score", 4).alias("score"), "rank")


@check(_TEXT_SQL)
def q_search_index(spark: SparkSession, d: str) -> DataFrame:
    """The same hits from a stored index of all documents."""
    path = build_text_index(table(spark, d, "documents"), join_path(shared_dir(spark), f"text-{uuid.uuid4().hex}"), shard_docs=500)
    hits = search_index(spark, path, table(spark, d, "benchmark").withColumnRenamed("item_id", "query_id"), k=10)
    texts = table(spark, d, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    return hits.join(texts, "doc_id").select("query_id", "text_md5", F.round("score", 4).alias("score"), "rank")


_VECTOR_SQL = """
    WITH p AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    c AS (SELECT label, list(m ORDER BY i) AS center FROM (SELECT label, i, avg(x) AS m FROM p GROUP BY label, i) GROUP BY label),
    s AS (SELECT c.label AS query_id, vec_id, list_cosine_similarity(center, embedding::DOUBLE[]) AS score FROM c, embeddings)
    SELECT query_id, vec_id, round(score, 4) AS score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
    """


def _label_centers(vectors: DataFrame) -> DataFrame:
    parts = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    mean = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return mean.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda p: p["m"]).alias("embedding"))


@check(_VECTOR_SQL)
def q_search_vector(spark: SparkSession, d: str) -> DataFrame:
    """Nearest vectors to the center of each label."""
    vectors = table(spark, d, "embeddings")
    hits = search_vector(vectors, _label_centers(vectors), k=10)
    return hits.select("query_id", F.col("doc_id").alias("vec_id"), F.round("score", 4).alias("score"), "rank")


@check(_VECTOR_SQL)
def q_search_cells(spark: SparkSession, d: str) -> DataFrame:
    """The same hits from a stored metric partitioning."""
    vectors = table(spark, d, "embeddings")
    path = build_vector_index(vectors, join_path(shared_dir(spark), f"vectors-{uuid.uuid4().hex}"), cell_rows=100)
    hits = search_cells(spark, path, _label_centers(vectors), k=10)
    return hits.select("query_id", F.col("doc_id").alias("vec_id"), F.round("score", 4).alias("score"), "rank")
