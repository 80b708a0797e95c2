"""Change detection, state and output names over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.checks.registry import CHECKS, check, joined, table, text
from folioflow.operators.ordering import rank_rows
from folioflow.operators.quality import (
    annotate_missing,
    assign_file_names,
    base_name,
    detect_changes,
    latest_state,
    numbered_name,
    upsert_state,
)
from folioflow.session import join_path, shared_dir
from folioflow.streaming.changes import run_changes, state_session
from folioflow.streaming.shared_view import SharedView, fold_batch
from folioflow.streaming.state import SeenTable

_ORDER = ("ts", "event_id")


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Events as versions of one item per user; users without purchases have no key."""
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        F.lit("b").alias("brand"),
        F.when(F.col("user_id") % 10 > 0, text("=/user/", "user_id")).otherwise("").alias("_key"),
        F.sha2("event_type", 256).alias("_content_hash"),
    )


_VERSIONS = """v AS (SELECT event_id, ts, user_id, CASE WHEN user_id % 10 > 0 THEN '/user/' || user_id ELSE '' END AS key,
                     sha256(event_type) AS hash FROM events)"""


@check(
    f"""
    WITH {_VERSIONS}
    SELECT event_id, CASE WHEN key = '' OR prev IS NULL THEN 'new' WHEN prev = hash THEN 'unchanged' ELSE 'updated' END AS change
    FROM (SELECT *, lag(hash) OVER (PARTITION BY key ORDER BY ts, event_id) AS prev FROM v)
    """
)
def q_change(spark: SparkSession, d: str) -> DataFrame:
    changes = detect_changes(_versions(spark, d), order=_ORDER)
    return changes.select("event_id", F.col("_change").alias("change"))


_STREAM_SQL = CHECKS["q_change"][1]


@check(_STREAM_SQL)
def q_change_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream: three arrivals of files, each taken up by a query that goes on from its state."""
    own = state_session(spark)
    versions = _versions(spark, d)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = versions.agg(F.min(micros), F.max(micros)).first()
    part = F.floor((micros - F.lit(low)) * 3 / F.lit(high - low + 1))
    root = join_path(shared_dir(spark), f"changes-{uuid.uuid4().hex}")
    landing = join_path(root, "landing")
    for n in range(3):
        versions.filter(part == n).write.mode("append").parquet(landing)
        arriving = own.readStream.schema(versions.schema).parquet(landing)
        run_changes(arriving, root, order=_ORDER).awaitTermination()
    return spark.read.parquet(join_path(root, "changes")).select("event_id", F.col("_change").alias("change"))


_HALVES = f"""{_VERSIONS},
    cut AS (SELECT user_id AS u, min(ts) + (max(ts) - min(ts)) / 2 AS mid FROM events GROUP BY user_id),
    h AS (SELECT v.*, ts <= mid AS old FROM v JOIN cut ON u = user_id),
    state AS (SELECT key AS k, arg_max(hash, (ts, event_id)) AS known, max(ts) AS seen_at FROM h WHERE old AND key <> '' GROUP BY key)"""


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Each user's events before and after the middle of their time span."""
    events = table(spark, d, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.groupBy("user_id").agg(F.min(micros).alias("a"), F.max(micros).alias("b"))
    marked = events.join(span, "user_id").select(
        "event_id", (F.floor((micros - F.col("a")) * 2) <= F.col("b") - F.col("a")).alias("old")
    )
    both = _versions(spark, d).join(marked, "event_id")
    return both.filter("old").drop("old"), both.filter("NOT old").drop("old")


_CHANGE_STATE = f"""
    WITH {_HALVES}
    SELECT event_id, CASE WHEN key = '' OR prev IS NULL THEN 'new' WHEN prev = hash THEN 'unchanged' ELSE 'updated' END AS change
    FROM (SELECT h.*, coalesce(lag(hash) OVER (PARTITION BY key ORDER BY ts, event_id), known) AS prev
          FROM h LEFT JOIN state ON k = key WHERE NOT old)
"""


@check(_CHANGE_STATE)
def q_change_state(spark: SparkSession, d: str) -> DataFrame:
    old, new = _halves(spark, d)
    seen = latest_state(old, order=_ORDER, seen_at="ts")
    return detect_changes(new, seen, order=_ORDER).select("event_id", F.col("_change").alias("change"))


@check(_CHANGE_STATE)
def q_change_hot(spark: SparkSession, d: str) -> DataFrame:
    """The same with every key treated as hot: rows of one key are spread over buckets."""
    old, new = _halves(spark, d)
    seen = latest_state(old, order=_ORDER, seen_at="ts")
    return detect_changes(new, seen, order=_ORDER, hot_rows=4).select("event_id", F.col("_change").alias("change"))


@check(
    f"""
    WITH {_HALVES}, later AS (SELECT key, arg_max(hash, (ts, event_id)) AS hash, max(ts) AS ts FROM h WHERE NOT old AND key <> '' GROUP BY key)
    SELECT coalesce(key, k) AS url, coalesce(hash, known) AS content_hash, strftime(coalesce(ts, seen_at), '%Y-%m-%d %H:%M:%S') AS seen_at
    FROM state FULL JOIN later ON k = key
    """
)
def q_state(spark: SparkSession, d: str) -> DataFrame:
    old, new = (latest_state(part, order=_ORDER, seen_at="ts") for part in _halves(spark, d))
    return upsert_state(old, new).select("url", "content_hash", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss").alias("seen_at"))


@check(
    """
    WITH e AS (SELECT user_id, sha256(event_type) AS hash, ts, event_id, event_id % 3 AS batch FROM events),
    s AS (SELECT user_id, batch, arg_max(hash, (ts, event_id)) AS hash FROM e WHERE batch < 2 GROUP BY user_id, batch)
    SELECT '/user/' || user_id AS url, arg_max(hash, batch) AS content_hash FROM s
    WHERE user_id IN (SELECT user_id FROM e WHERE batch = 2) GROUP BY user_id
    """
)
def q_state_replay(spark: SparkSession, d: str) -> DataFrame:
    """State that batch 2 sees: two earlier batches, gathered, the second one played again."""
    events = table(spark, d, "events").select(
        (F.col("event_id") % 3).alias("batch"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("b").alias("brand"),
        text("=/user/", "user_id").alias("_key"),
        F.sha2("event_type", 256).alias("_content_hash"),
    )
    parts = [latest_state(events.filter(F.col("batch") == n), order=_ORDER, seen_at="ts") for n in range(3)]
    store = SeenTable(spark, join_path(shared_dir(spark), f"seen-{uuid.uuid4().hex}"))
    store.write_delta(parts[0], 0)
    store.write_delta(parts[1], 1)
    store.compact(1)
    store.write_delta(parts[1], 1)
    return store.before(2, parts[2].select("brand", "url")).select("url", "content_hash")


@check(
    """
    WITH e AS (SELECT user_id, 'b' || user_id % 3 AS brand, sha256(event_type || user_id % 4) AS hash, ts, event_id, event_id % 3 AS part FROM events),
    s AS (SELECT turn, part AS batch, brand, '/user/' || user_id AS url, arg_max(hash, (ts, event_id)) AS hash
          FROM e, range(3) r(turn) WHERE part <= turn GROUP BY turn, part, brand, user_id),
    c AS (SELECT turn, brand, url, arg_max(hash, batch) AS hash FROM s GROUP BY turn, brand, url)
    SELECT turn AS batch, brand, hash AS content_hash, count(*) AS n_urls, min(url) AS first_url, max(url) AS last_url
    FROM c GROUP BY turn, brand, hash HAVING count(*) > 1
    """
)
def q_shared_view(spark: SparkSession, d: str) -> DataFrame:
    """Shared content after each of three batches, from what each changed; the last one comes twice."""
    events = table(spark, d, "events").select(
        (F.col("event_id") % 3).alias("part"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        text("=b", F.col("user_id") % 3).alias("brand"),
        text("=/user/", "user_id").alias("_key"),
        F.sha2(text("event_type", F.col("user_id") % 4), 256).alias("_content_hash"),
    )
    root = join_path(shared_dir(spark), f"shared-{uuid.uuid4().hex}")
    state, view = SeenTable(spark, join_path(root, "seen")), SharedView(spark, join_path(root, "shared"))
    found = []
    for n in (0, 1, 2, 2):
        fold_batch(latest_state(events.filter(F.col("part") == n), order=_ORDER, seen_at="ts"), state, view, n)
        if n == 1:
            view.compact(0)
        found = [*found[:n], view.shared(n).withColumn("batch", F.lit(n).cast("long"))]
    return found[0].unionByName(found[1]).unionByName(found[2])


@check("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events")
def q_rank_hot(spark: SparkSession, d: str) -> DataFrame:
    """Positions inside five big groups, each cut into ordered buckets."""
    events = table(spark, d, "events").select("event_id", "event_type", "ts")
    return rank_rows(events, ["event_type"], _ORDER, "n", hot_rows=500).select("event_id", "n")


_NAMED = r"""
    named AS (SELECT page_id, url, 'desk_article_2024' || lpad(CAST(1 + page_id % 12 AS VARCHAR), 2, '0') || '01_' || s AS base FROM (
        SELECT page_id, url, lower(trim(regexp_replace(regexp_extract(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '([^/]*)$', 1),
               '[^a-zA-Z0-9]+', '-', 'g'), '-')) AS s FROM pages))
"""


def _page_items(spark: SparkSession, d: str) -> DataFrame:
    """Pages as items; an item without a date is named by its scrape time."""
    month = F.lpad((F.col("page_id") % 12 + 1).cast("string"), 2, "0")
    return table(spark, d, "pages").select(
        "page_id",
        F.lit("desk").alias("brand"),
        F.lit("article").alias("content_type"),
        F.when(F.col("page_id") % 2 == 0, text("=2024-", month, "=-01")).alias("date_published"),
        F.col("url").alias("source_url"),
        F.lit(None).cast("string").alias("canonical_url"),
        F.lit(None).cast("string").alias("body"),
        F.to_timestamp(text("=2024-", month, "=-01")).alias("_scraped_at"),
    )


@check(
    f"""
    WITH {_NAMED}
    SELECT page_id, base || CASE WHEN k = 1 THEN '' ELSE '_' || (k - 1) END || '.json' AS file_name
    FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY page_id) AS k FROM named)
    """
)
def q_file_name(spark: SparkSession, d: str) -> DataFrame:
    named = assign_file_names(_page_items(spark, d), order=("_scraped_at", "page_id"))
    return named.select("page_id", "file_name")


@check(
    f"""
    WITH {_NAMED}, taken AS (SELECT DISTINCT base FROM named WHERE url LIKE 'https:%')
    SELECT page_id, base || CASE WHEN n = 0 THEN '' ELSE '_' || n END || '.json' AS file_name
    FROM (SELECT page_id, base, CASE WHEN base NOT IN (SELECT base FROM taken) THEN k WHEN k = 0 THEN 1 ELSE k + 2 END AS n
          FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY page_id) - 1 AS k FROM named))
    """
)
def q_file_name_taken(spark: SparkSession, d: str) -> DataFrame:
    """Names of an earlier run leave the gap 1 and everything from 3 on."""
    items = _page_items(spark, d)
    earlier = items.filter(F.col("source_url").startswith("https:")).select(base_name().alias("b"))
    used = earlier.select("b", F.explode(F.array(F.lit(0), F.lit(2))).alias("n")).select(
        numbered_name("b", "n").alias("file_name")
    )
    named = assign_file_names(items, used, order=("_scraped_at", "page_id"), hot_rows=2)
    return named.select("page_id", "file_name")


@check(
    """
    SELECT doc_id, concat_ws('|', CASE WHEN lang = 'fr' OR toxic = 1 THEN 'title' END, CASE WHEN quality = 0 THEN 'body' END,
                             CASE WHEN quality IS NULL AND lang = 'de' THEN 'source_url' END) AS missing
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def q_missing(spark: SparkSession, d: str) -> DataFrame:
    return annotate_missing(doc_items(spark, d)).select("doc_id", joined("_missing_fields").alias("missing"))


def doc_items(spark: SparkSession, d: str) -> DataFrame:
    """Documents as items, with fields blanked by language and label."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    no_title = (F.col("lang") == "fr") | (F.coalesce("toxic", F.lit(0)) == 1)
    no_url = F.col("quality").isNull() & (F.col("lang") == "de")
    return docs.select(
        "doc_id",
        F.when(~no_title, F.substring_index("text", "\n", 1)).otherwise(F.when(F.col("lang") == "fr", F.lit(""))).alias("title"),
        F.when(F.coalesce("quality", F.lit(1)) != 0, F.col("text")).alias("body"),
        F.when(~no_url, text("=/doc/", "doc_id")).alias("source_url"),
        F.when(~no_url | (F.col("doc_id") % 2 == 0), text("=/doc/", "doc_id")).alias("canonical_url"),
        F.col("source").alias("brand"),
        F.col("lang").alias("category"),
        F.array("lang", "source").alias("categories"),
        text("=2024-0", F.col("doc_id") % 9 + 1, "=-1", F.col("doc_id") % 7).alias("date_published"),
        F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("author"),
        F.to_timestamp(text("=2024-01-0", F.col("doc_id") % 9 + 1)).alias("_scraped_at"),
    )
