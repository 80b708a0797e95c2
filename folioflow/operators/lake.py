"""The content table: idempotent upsert, rejects, listing and fetching."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.normalize import item_key, publish_date
from folioflow.session import cut_lineage, join_path
from folioflow.streaming.state import BUCKET, bucket_of, stored_buckets, touched_buckets, write_buckets

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def upsert_items(
    lake: DataFrame,
    items: DataFrame,
    *,
    keys: Sequence[str] | None = None,
    hash_col: str = "_content_hash",
    order: Sequence[str] = ("_scraped_at", "_content_hash"),
) -> DataFrame:
    """The lake after the items came in, with ``_action`` per row.

    One row per brand and item key (``source_url``, or ``canonical_url`` where that is
    missing), or per ``keys``. Items without a key do not enter: ``split_rejects`` names
    them. An item with the hash already stored changes nothing, so the same batch can
    come twice. What happens is decided on keys and hashes; bodies of the lake only meet
    the keys of the batch. ``order`` tells the versions of a key in one batch apart.
    """
    keyed, last = _last_versions(items, keys, order)
    stored = _with_key(lake, keys)
    actions = cut_lineage(_actions(stored.select(*keyed, hash_col), last.select(*keyed, hash_col), keyed, hash_col))
    old = stored.join(actions, keyed, "left").filter(F.coalesce("_action", F.lit(KEPT)) != UPDATED)
    old = old.select(*lake.columns, F.coalesce("_action", F.lit(KEPT)).alias("_action"))
    new = last.join(actions.filter(F.col("_action").isin(INSERTED, UPDATED)), keyed)
    return old.unionByName(new.select(*lake.columns, "_action"))


def _with_key(rows: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    if keys:
        return rows
    other = "canonical_url" if "canonical_url" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("_key", item_key("source_url", other))


def _last_versions(items: DataFrame, keys: Sequence[str] | None, order: Sequence[str]) -> tuple[list[str], DataFrame]:
    """Key columns, and the last version of each key of a batch."""
    keyed = list(keys or ("brand", "_key"))
    rows = _with_key(items, keys)
    for k in keyed[-1:] if not keys else keyed:
        rows = rows.filter(F.coalesce(F.col(k).cast("string"), F.lit("")) != "")
    rows = rows.withColumn("brand", F.coalesce("brand", F.lit("unknown"))) if not keys else rows
    rest = [c for c in rows.columns if c not in keyed]
    last = rows.groupBy(*keyed).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_new"))
    return keyed, cut_lineage(last.select(*keyed, "_new.*"))


def _actions(old: DataFrame, new: DataFrame, keyed: list[str], hash_col: str) -> DataFrame:
    """What happens to each key of the batch, from keys and hashes alone."""
    have = old.withColumnRenamed(hash_col, "_old_hash").withColumn("_stored", F.lit(True))
    action = (
        F.when(F.col("_stored").isNull(), F.lit(INSERTED))
        .when(F.col("_old_hash").eqNullSafe(F.col(hash_col)), F.lit(UNCHANGED))
        .otherwise(F.lit(UPDATED))
    )
    return new.join(have, keyed, "left").select(*keyed, action.alias("_action"))


def upsert_table(
    spark: SparkSession,
    path: str,
    items: DataFrame,
    *,
    buckets: int | None = None,
    hash_col: str = "_content_hash",
    order: Sequence[str] = ("_scraped_at", "_content_hash"),
) -> DataFrame:
    """Upsert into a table stored in key buckets; gives ``brand``, ``_key``, ``_action`` of the batch.

    Only keys and hashes of the batch's buckets are read to decide, and only buckets with
    a new or changed item are rewritten: a batch that comes again rewrites nothing. The table
    keeps the number of buckets it was made with (``buckets``, or one per shuffle partition);
    a large bucket is written by several tasks.
    """
    buckets = stored_buckets(spark, path, buckets)
    path = join_path(path, f"buckets={buckets}")
    keyed, last = _last_versions(items, None, order)
    last = last.withColumn(BUCKET, bucket_of(keyed, buckets))
    try:
        lake = spark.read.schema(last.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lake = spark.createDataFrame([], last.schema)
    touched = touched_buckets(last, keyed, buckets)
    slim = lake.select(BUCKET, *keyed, hash_col).join(F.broadcast(touched), BUCKET, "left_semi").drop(BUCKET)
    actions = cut_lineage(_actions(slim, last.select(*keyed, hash_col), keyed, hash_col))
    fresh = last.join(actions.filter(F.col("_action") != UNCHANGED).drop("_action"), keyed, "left_semi")
    changed = F.broadcast(touched_buckets(fresh, keyed, buckets))
    if not fresh.isEmpty():
        kept = lake.join(changed, BUCKET, "left_semi").join(fresh.select(*keyed), keyed, "left_anti")
        write_buckets(kept.select(*last.columns).unionByName(fresh), path, partitionOverwriteMode="dynamic")
    return actions


def reject_reason(captcha: str | None = None) -> Column:
    """Why an item may not enter the lake; null when it may."""
    no_key = item_key("source_url", "canonical_url") == ""
    incomplete = F.size(F.coalesce("_missing_fields", F.array().cast("array<string>"))) > 0
    first = F.when(F.coalesce(F.col(captcha), F.lit(False)), F.lit("captcha")) if captcha else None
    out = F.when(no_key, F.lit("no key")) if first is None else first.when(no_key, F.lit("no key"))
    return out.when(incomplete, F.concat(F.lit("missing: "), F.concat_ws(", ", "_missing_fields")))


def mark_rejects(items: DataFrame, captcha: str | None = None) -> DataFrame:
    return items.withColumn("_reject_reason", reject_reason(captcha))


def split_rejects(items: DataFrame, captcha: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected items carry ``_reject_reason``."""
    marked = mark_rejects(items, captcha)
    ok = F.col("_reject_reason").isNull()
    return marked.filter(ok).drop("_reject_reason"), marked.filter(~ok)


def write_routed(items: DataFrame, path: str, captcha: str | None = None, mode: str = "append") -> None:
    """Accepted and rejected items in one pass, as partitions ``route=accepted|rejected``."""
    marked = mark_rejects(items, captcha)
    route = F.when(F.col("_reject_reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    marked.withColumn("route", route).write.mode(mode).partitionBy("route").parquet(path)


def list_items(
    lake: DataFrame,
    *,
    brand: str | None = None,
    category: str | None = None,
    author: str | None = None,
    published_from: date | str | None = None,
    published_to: date | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Items that meet all given filters, newest first.

    Filters are plain comparisons on stored columns, so they reach the scan. ISO dates
    compare like text, which keeps the date range pushable too.
    """
    out = lake
    if brand is not None:
        out = out.filter(F.col("brand") == brand)
    if author is not None:
        out = out.filter(F.col("author") == author)
    if published_from is not None:
        out = out.filter(F.col("date_published") >= str(published_from))
    if published_to is not None:
        out = out.filter(F.col("date_published") <= str(published_to))
    if category is not None:
        in_list = F.coalesce(F.array_contains("categories", category), F.lit(False))
        out = out.filter((F.col("category") == category) | in_list)
    newest = [F.desc_nulls_last("date_published"), F.asc("source_url")]
    return out.orderBy(*newest).limit(limit) if limit is not None else out.orderBy(*newest)


def with_publish_date(items: DataFrame) -> DataFrame:
    return items.withColumn("publish_date", publish_date("date_published"))


def fetch_items(lake: DataFrame, ids: DataFrame | Sequence[str], key: str = "source_url") -> DataFrame:
    """Items by id. A short list becomes a pushed-down ``IN``; a table a semi-join."""
    if isinstance(ids, DataFrame):
        return lake.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")
    return lake.filter(F.col(key).isin(list(ids)))
