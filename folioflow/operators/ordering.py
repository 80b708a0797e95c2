"""Ordered work inside a key that stays parallel when one key holds most rows.

``row_number`` and ``lag`` need all rows of a key in one task. Here a hot key is cut
into buckets that follow the order, each bucket is worked on by itself, and what has
to cross a bucket border comes from one summary row per bucket. The cuts only decide
where rows are processed; results are exact whatever the cuts are.

Every key with more than ``hot_rows`` rows is cut, into as many buckets as its counted rows
need. The tables of hot keys hold one row per ``hot_rows`` input rows at most; they are
joined without a hint, so that their real size decides how.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import cut_lineage

HOT_ROWS = 1_000_000
SAMPLE_PER_CUT = 16
BUCKET = "_bucket"


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def lookup(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with a table that has each key once, null keys included."""
    extra = [c for c in small.columns if c not in keys]
    joined = df.alias("l").join(small.alias("r"), _same_keys("l", "r", keys), "left")
    return joined.select("l.*", *[f"r.{c}" for c in extra])


def order_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame | None:
    """Cut points of the hot keys: ``keys``, ``_cuts`` (ascending order values).

    None if no key has more than ``hot_rows`` rows, which one count of the keys tells.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (counted.agg(F.max("_n")).first()[0] or 0) <= hot_rows:
        return None
    hot = cut_lineage(counted.filter(F.col("_n") > hot_rows))
    slim = df.select(*keys, F.struct(*order).alias("_ord"))
    marked = lookup(slim, hot, keys).filter(F.col("_n").isNotNull())
    parts = F.ceil(F.col("_n") / hot_rows)
    thin = F.greatest(F.lit(1), F.floor(F.col("_n") / (parts * SAMPLE_PER_CUT)))
    picked = marked.filter(F.pmod(F.xxhash64("_ord", F.lit(1)), thin) == 0)
    sample = picked.groupBy(*keys, "_n").agg(F.sort_array(F.collect_set("_ord")).alias("_s"))
    n = F.size("_s")
    cuts = F.transform(
        F.sequence(F.lit(1), F.least(parts, n)),
        lambda i: F.get(F.col("_s"), F.least(n - 1, F.floor(i * n / (parts + 1)).cast("int"))),
    )
    return cut_lineage(sample.select(*keys, F.array_distinct(cuts).alias("_cuts")))


def add_bucket(df: DataFrame, cuts: DataFrame | None, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_bucket``, growing with the order inside a hot key, and ``_hot``."""
    if cuts is None:
        return df.withColumn("_hot", F.lit(False)).withColumn(BUCKET, F.lit(0).cast("long"))
    here = F.struct(*order)
    rows = lookup(df, cuts, keys).withColumn("_hot", F.col("_cuts").isNotNull())
    rows = rows.withColumn(BUCKET, F.lit(0))
    # Binary search for the number of cuts below this row: one projection per halving,
    # all inside generated code. Past the last cut there is null, which counts as above.
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 1
    step = 1 << (most.bit_length() - 1)
    while step:
        below = F.get("_cuts", F.col(BUCKET) + (step - 1)) < here
        rows = rows.withColumn(BUCKET, F.col(BUCKET) + F.when(below, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return rows.withColumn(BUCKET, F.col(BUCKET).cast("long")).drop("_cuts")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    into: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one."""
    keys = list(keys)
    rows = df.withColumn("_v", value)
    cuts = order_cuts(rows, keys, order, hot_rows)
    parts = add_bucket(rows, cuts, keys, order)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumn(into, F.sum("_v").over(inside))
    if cuts is not None:
        totals = parts.filter("_hot").groupBy(*keys, BUCKET).agg(F.sum("_v").alias("_t"))
        before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.withColumn("_before", F.sum("_t").over(before)).drop("_t")
        summed = lookup(summed, offsets, [*keys, BUCKET])
        summed = summed.withColumn(into, F.col(into) + F.coalesce(F.col("_before"), F.lit(0))).drop("_before")
    return summed.drop("_v", BUCKET, "_hot")


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """1-based position of each row inside its key."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), into, hot_rows)
