"""Physical order of the content table for its two ways of access.

Listing filters on brand, category and date in any combination: rows are stored along a Z curve over
the three, so that every row group holds a small box of all of them and its statistics let a scan
leave it out. Fetching asks for single ids: row groups carry a Bloom filter on them. Pages of a list
go on from the last key of the page before instead of counting rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.lake import list_items

CURVE = ("brand", "category", "date_published")
PAGE_ORDER = ("date_published", "brand", "source_url")
BITS, SAMPLE = 8, 20_000


def curve_cuts(rows: DataFrame, columns: Sequence[str] = CURVE, bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """Ascending cut points of each column, ``2 ** bits - 1`` at most, from ``sample`` rows."""
    n = rows.count()
    some = rows.select(*columns)
    if n > sample:
        some = some.sample(sample / n, seed=7)
    values = some.limit(sample).collect()
    cuts = {}
    for c in columns:
        known = sorted(r[c] for r in values if r[c] is not None)
        steps = 1 << bits
        picked = known if len(set(known)) < steps else [known[len(known) * i // steps] for i in range(1, steps)]
        cuts[c] = sorted(set(picked))
    return cuts


def _rank(value: Column, points: Sequence[Any]) -> Column:
    """How many cut points ``value`` has reached."""
    if not points:
        return F.lit(0)
    reached = F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p <= value))
    return F.when(value.isNull(), F.lit(0)).otherwise(reached)


def curve_place(cuts: Mapping[str, Sequence[Any]], bits: int = BITS) -> Column:
    """Place on the Z curve: the bits of all columns' ranks in turn, highest first; nulls rank lowest."""
    out = F.lit(0).cast("long")
    for i, (name, points) in enumerate(cuts.items()):
        # Ranks of a column with few values are spread, so that all columns decide in the highest bits.
        rank = F.floor(_rank(F.col(name), points) * (1 << bits) / (len(points) + 1)).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(cuts) + i))
    return out


def write_clustered(
    lake: DataFrame,
    path: str,
    *,
    columns: Sequence[str] = CURVE,
    key: str = "source_url",
    files: int | None = None,
    group_bytes: int = 64 << 20,
    keys_per_group: int = 100_000,
) -> None:
    """Write the table along the curve, with Bloom filters on ``key``.

    Rows of one place are dealt by the hash of their key, so that a place with very many rows
    (one brand, category and day) still falls into several files.
    """
    placed = lake.withColumn("_place", curve_place(curve_cuts(lake, columns))).withColumn("_deal", F.xxhash64(key))
    tasks = files or int(lake.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(tasks, "_place", "_deal").sortWithinPartitions("_place", "_deal").drop("_place", "_deal")
    options = {
        "parquet.block.size": str(group_bytes),
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.expected.ndv#{key}": str(keys_per_group),
    }
    ordered.write.mode("overwrite").options(**options).parquet(path)


def list_page(lake: DataFrame, size: int, after: Mapping[str, Any] | None = None, **filters: Any) -> DataFrame:
    """The next ``size`` items of a list, newest first, after the last one of the page before.

    ``after`` holds that item's date, brand and ``source_url``, which together tell items apart;
    ``filters`` are those of ``list_items``. A later page costs no more than the first.
    """
    rows = list_items(lake, **filters)
    if after is not None:
        rows = rows.filter(_beyond(after))
    order = [F.desc_nulls_last("date_published"), F.asc_nulls_first("brand"), F.asc_nulls_first("source_url")]
    return rows.orderBy(*order).limit(size)


def _beyond(after: Mapping[str, Any]) -> Column:
    day, brand, url = (after[c] for c in PAGE_ORDER)
    none = F.col("date_published").isNull()
    beyond = _same("brand", brand) & _above("source_url", url)
    beyond = _same("date_published", day) & (_above("brand", brand) | beyond)
    if day is None:
        return beyond
    # The first part alone decides which row groups are read.
    return ((F.col("date_published") <= F.lit(day)) | none) & ((F.col("date_published") < F.lit(day)) | none | beyond)


def _same(name: str, value: Any) -> Column:
    return F.col(name).isNull() if value is None else F.col(name).eqNullSafe(F.lit(value))


def _above(name: str, value: Any) -> Column:
    return F.col(name).isNotNull() if value is None else F.coalesce(F.col(name) > F.lit(value), F.lit(False))
