"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut_lineage, ship_package

#: Words are runs of anything but ASCII white space (Java and Python syntax).
WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FOREST_NODES = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def n_words(text: str | Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def lower_ascii(text: str | Column) -> Column:
    return F.translate(whole(text), UPPER, LOWER)


def crc_fold(doc_id: str, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def row_key(df: DataFrame) -> DataFrame:
    """Add ``_llm_k1``, ``_llm_k2``: 128 bits that only rows equal in every column share."""
    names = [f"`{c}`" for c in df.columns]
    marks = [F.col(c).isNull() for c in names]
    return df.withColumns(
        {"_llm_k1": F.xxhash64(*names, *marks), "_llm_k2": F.xxhash64(F.lit(7), *reversed(names), *marks)}
    )


def hash_sample(df: DataFrame, key: Column, n: int, most: int, *ties: str) -> DataFrame:
    """The ``most`` rows of ``df`` (``n`` rows, ``key`` a hash) with the least keys.

    A bound on the hash leaves little more than ``most`` rows in all before they are put in order,
    so what tasks hand on does not grow with their number.
    """
    share = (most + 8 * most**0.5 + 64) / max(1, n)
    near = df.filter(key <= F.lit(int(share * 2**64) - 2**63).cast("long")) if share < 1 else df
    return near.orderBy(key, *ties).limit(most)


def ship(df: DataFrame) -> None:
    """Make this package importable on the executors before a Python stage.

    Texts are large rows: a session that leaves the number of rows per Arrow batch at
    Spark's default gets a smaller one, so that a worker holds a few megabytes at a time.
    """
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each part holds about ``max_bytes`` of ``column`` (one row at least)."""
    offsets = np.concatenate(([0], np.cumsum(byte_lengths(batch.column(column)))))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def byte_lengths(values: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _forest(batches: Iterable[pa.RecordBatch], most: int = FOREST_NODES) -> Iterator[pa.RecordBatch]:
    """Edges of one partition to ``(node, smallest node of its tree)``, a forest for about ``most`` nodes at a time."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def trees() -> pa.RecordBatch:
        nodes = [x for x in parent if root(x) != x]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["a", "b"]
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= most:
            yield trees()
            parent.clear()
    yield trees()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node reachable.

    Each partition first contracts its own edges to a forest. Then large-star and
    small-star steps alternate; every step is a written table, and the loop ends when a
    round changes nothing. All edges of a component may stand under one root: least
    neighbours are aggregates that shrink before the shuffle, and as they are written, the
    join with them reads two plain exchanges, which adaptive execution splits at a hot root.
    """
    ship(edges)
    slim = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    now = cut_lineage(slim.mapInArrow(_forest, "a long, b long"))
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    for _ in range(max_rounds):
        both = now.union(now.select("b", "a"))
        least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.distinct())
        # Every row now points down (a > b): the small star of a has its smaller neighbours only.
        least = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        )
        now = cut_lineage(small.select("e.a", F.col("e.m").alias("b")).filter("a <> b").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        before = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
