"""Required fields, change detection against earlier runs, state, output names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.normalize import first_non_empty, item_hash, item_key, non_empty
from folioflow.functions.urls import url_to_slug
from folioflow.operators.ordering import BUCKET, HOT_ROWS, add_bucket, lookup, order_cuts, rank_rows, running_sum
from folioflow.session import cut_lineage

# An item without one of these is incomplete (but kept).
REQUIRED_FIELDS = ("title", "body", "source_url")

NEW, UPDATED, UNCHANGED = "new", "updated", "unchanged"


def missing_fields(required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Names of the empty required fields; null when all are there."""
    names = F.filter(
        F.array(*[F.when(F.coalesce(F.col(f), F.lit("")) == "", F.lit(f)) for f in required]), lambda n: n.isNotNull()
    )
    return F.when(F.size(names) > 0, names)


def annotate_missing(items: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    return items.withColumn("_missing_fields", missing_fields(required))


def with_hash_and_key(items: DataFrame) -> DataFrame:
    """Add ``_content_hash`` (from the body) and ``_key`` (the URL an item is known by)."""
    out = items.withColumn("_content_hash", item_hash("body"))
    return out.withColumn("_key", item_key("source_url", "canonical_url"))


def detect_changes(
    items: DataFrame,
    seen: DataFrame | None = None,
    *,
    order: Sequence[str] = ("_scraped_at", "_content_hash"),
    brand: str = "brand",
    key: str = "_key",
    hash_col: str = "_content_hash",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``_change``: each item against the one before it under the same brand and key.

    The item before the first of a run is the one in ``seen`` (brand, url,
    content_hash). No earlier item means new, the same hash unchanged, another hash
    updated. Items without a key are always new. ``order`` must be a total order of
    the versions of one key.

    One shuffle of the items, on (brand, key, bucket). The keys of a big input are
    counted first, so ``items`` should be a stored table then, not a page parse.
    """
    keys = [brand, key]
    has_key = F.coalesce(F.col(key), F.lit("")) != ""
    cuts = order_cuts(items.filter(has_key), keys, order, hot_rows)
    rows = add_bucket(items, cuts, keys, order)
    # Keyless items need no order; their hash spreads them over all tasks.
    rows = rows.withColumn(BUCKET, F.when(has_key, F.col(BUCKET)).otherwise(F.xxhash64(*order)))

    known = None
    if seen is not None:
        known = seen.select(F.col("brand").alias(brand), F.col("url").alias(key), F.col("content_hash").alias("_known"))
    carry = None
    if cuts is not None:
        ends = rows.filter("_hot").groupBy(*keys, BUCKET).agg(F.max_by(hash_col, F.struct(*order)).alias("_end"))
        by_bucket = Window.partitionBy(*keys).orderBy(BUCKET)
        carry = ends.withColumn("_carry", F.lag("_end").over(by_bucket)).drop("_end")
        if known is not None:
            # Only the first bucket of a hot key follows the stored state.
            first = ends.groupBy(*keys).agg(F.min(BUCKET).alias("_first"))
            known = lookup(known, first, keys)
    if known is not None:
        at = F.coalesce("_first", F.lit(0).cast("long")) if carry is not None else F.lit(0).cast("long")
        known = known.withColumn(BUCKET, at).select(*keys, BUCKET, "_known")
        rows = rows.join(known, [*keys, BUCKET], "left")

    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    rows = rows.withColumn("_prev", F.lag(hash_col).over(inside))
    if carry is not None:
        rows = lookup(rows, carry, [*keys, BUCKET])
    before = ["_prev"] + ["_carry"] * (carry is not None) + ["_known"] * (known is not None)
    prev = F.coalesce(*before)
    change = (
        F.when(~has_key | prev.isNull(), F.lit(NEW))
        .when(prev == F.col(hash_col), F.lit(UNCHANGED))
        .otherwise(F.lit(UPDATED))
    )
    return rows.withColumn("_change", change).select(*items.columns, "_change")


def drop_unchanged(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("_change") != UNCHANGED)


def latest_state(
    items: DataFrame,
    *,
    order: Sequence[str] = ("_scraped_at", "_content_hash"),
    brand: str = "brand",
    key: str = "_key",
    hash_col: str = "_content_hash",
    seen_at: str = "_scraped_at",
) -> DataFrame:
    """Last hash per brand and key of these items (combined map-side, so hot keys are cheap)."""
    last = F.max_by(F.struct(F.col(hash_col), F.col(seen_at)), F.struct(*order))
    return (
        items.filter(F.coalesce(F.col(key), F.lit("")) != "")
        .groupBy(F.col(brand).alias("brand"), F.col(key).alias("url"))
        .agg(last.alias("_last"))
        .select("brand", "url", F.col(f"_last.{hash_col}").alias("content_hash"), F.col(f"_last.{seen_at}").alias("seen_at"))
    )


def upsert_state(seen: DataFrame, newer: DataFrame) -> DataFrame:
    """``seen`` with the rows of ``newer`` put in place of their predecessors.

    The newer run wins whatever its timestamps say: a late item is compared with the
    current state and then becomes it.
    """
    cols = ["brand", "url", "content_hash", "seen_at"]
    both = seen.select(*cols, F.lit(0).alias("_run")).unionByName(newer.select(*cols, F.lit(1).alias("_run")))
    return (
        both.groupBy("brand", "url")
        .agg(F.max_by(F.struct("content_hash", "seen_at"), "_run").alias("_last"))
        .select("brand", "url", "_last.content_hash", "_last.seen_at")
    )


# ---- output names ---------------------------------------------------------------------


def base_name(scraped_at: str = "_scraped_at") -> Column:
    """``{brand}_{content_type}_{yyyymmdd}_{slug}`` of an item."""
    date = F.coalesce(
        F.replace(non_empty("date_published"), F.lit("-"), F.lit("")), F.date_format(F.col(scraped_at), "yyyyMMdd")
    )
    slug = url_to_slug(F.coalesce(first_non_empty("source_url", "canonical_url"), F.lit("")))
    return F.concat_ws(
        "_", F.coalesce("brand", F.lit("unknown")), F.coalesce("content_type", F.lit("content")), date, slug
    )


def numbered_name(base: str, number: str) -> Column:
    suffix = F.when(F.col(number) > 0, F.concat(F.lit("_"), F.col(number).cast("string"))).otherwise("")
    return F.concat(F.col(base), suffix, F.lit(".json"))


def parse_file_names(names: DataFrame, column: str = "file_name") -> DataFrame:
    """(base, number) of names already used."""
    pattern = r"^(.+?_\d{8}_[a-z0-9-]+)(?:_(\d+))?\.json$"
    number = F.coalesce(non_empty(F.regexp_extract(column, pattern, 2)).cast("long"), F.lit(0).cast("long"))
    return names.select(F.regexp_extract(column, pattern, 1).alias("_base"), number.alias("_number")).filter(
        F.col("_base") != ""
    )


def number_intervals(names: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``_base``, ``_lo``, ``_hi``: unbroken runs of the numbers ``names(_base, _number)``."""
    ranked = rank_rows(names.distinct(), ["_base"], ["_number"], "_pos", hot_rows)
    runs = ranked.groupBy("_base", (F.col("_number") - F.col("_pos")).alias("_run"))
    return runs.agg(F.min("_number").alias("_lo"), F.max("_number").alias("_hi")).drop("_run")


def merge_intervals(intervals: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Intervals of a base that overlap or touch become one.

    A sweep over both ends of all intervals: where the number of open ones rises from nothing
    an interval begins, where it falls to nothing it ends.
    """
    ends = intervals.select(
        "_base",
        F.explode(
            F.array(
                F.struct(F.col("_lo").alias("_at"), F.lit(0).alias("_kind")),
                F.struct((F.col("_hi") + 1).alias("_at"), F.lit(1).alias("_kind")),
            )
        ).alias("e"),
    ).select("_base", "e.*")
    # Ends of one kind at one place are one step, so that the order is total.
    steps = ends.groupBy("_base", "_at", "_kind").agg(F.count("*").alias("_n"))
    step = F.when(F.col("_kind") == 0, F.col("_n")).otherwise(-F.col("_n"))
    open_ = running_sum(steps, ["_base"], ["_at", "_kind"], step, "_open", hot_rows)
    begins = (F.col("_kind") == 0) & (F.col("_open") == F.col("_n"))
    marks = open_.withColumn("_begins", begins).filter(F.col("_begins") | ((F.col("_kind") == 1) & (F.col("_open") == 0)))
    part = running_sum(marks, ["_base"], ["_at", "_kind"], F.col("_begins").cast("long"), "_part", hot_rows)
    return part.groupBy("_base", "_part").agg(F.min("_at").alias("_lo"), (F.max("_at") - 1).alias("_hi")).drop("_part")


def assign_file_names(
    items: DataFrame,
    existing: DataFrame | None = None,
    *,
    order: Sequence[str] = ("_scraped_at", "_tie"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``file_name``: the k-th item with a name gets the k-th free number.

    ``existing`` holds the ``file_name`` of outputs already present, or intervals of used
    numbers (``_base``, ``_lo``, ``_hi``); gaps left by removed ones are filled first. Items of
    one time are ordered by a hash of their URL and body (``_tie``).
    """
    named = items.withColumn("_base", base_name())
    if "_tie" in order:
        tie = F.sha2(F.concat_ws("\u0000", F.col("source_url"), F.col("canonical_url"), F.col("body")), 256)
        named = named.withColumn("_tie", tie)
    ranked = rank_rows(named, ["_base"], order, "_rank", hot_rows).withColumn("_number", F.col("_rank") - 1)
    if existing is not None:
        if "file_name" in existing.columns:
            one = F.col("_number")
            existing = parse_file_names(existing).select("_base", one.alias("_lo"), one.alias("_hi"))
        ranked = _skip_taken(ranked, existing, hot_rows)
    return ranked.withColumn("file_name", numbered_name("_base", "_number")).select(*items.columns, "file_name")


def _skip_taken(ranked: DataFrame, taken: DataFrame, hot_rows: int) -> DataFrame:
    """Turn the k-th position into the k-th number not in the intervals ``taken``.

    An interval with f free numbers below it pushes every position >= f up by its length, so
    the pushes are summed along the merged order of positions and f values.
    """
    ranked = cut_lineage(ranked)
    # Names of this batch only; the others are dropped where they are read.
    taken = taken.join(ranked.select("_base").distinct(), "_base", "left_semi").distinct()
    runs = merge_intervals(taken, hot_rows).withColumn("_push", F.col("_hi") - F.col("_lo") + 1)
    runs = running_sum(runs, ["_base"], ["_lo"], F.col("_push"), "_used", hot_rows)
    runs = cut_lineage(runs.select("_base", (F.col("_hi") + 1 - F.col("_used")).alias("_at"), "_push"))
    cols = [c for c in ranked.columns if c not in ("_base", "_number")]
    marks = ranked.select(
        "_base",
        F.col("_number").alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(0).cast("long").alias("_push"),
        F.struct(*cols).alias("_row"),
    ).unionByName(runs.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    summed = running_sum(marks, ["_base"], ["_at", "_kind"], F.col("_push"), "_pushed", hot_rows)
    moved = summed.filter(F.col("_kind") == 1).withColumn("_number", F.col("_at") + F.col("_pushed"))
    return moved.select("_base", "_number", "_row.*")
