"""A stored metric partitioning for exact vector search by cosine similarity.

``build_vector_index`` scales vectors to length one, where the cosine falls as the distance grows,
and gives each to its nearest pivot; pivots are a bounded sample by hash. Rows lie in folders by
cell with their distance to the pivot. A table of cells keeps pivot, rows, least and greatest distance.

``search_cells`` finds for each query a bound first: the distance to the k-th best vector of the
nearest cells that hold k rows. By the triangle inequality no vector of a cell is nearer than the
query's distance to the pivot less the cell's radius, so only cells within the bound are read at all;
inside a cell rows whose own distance to the pivot differs by more than the bound are skipped before
any product. Results are those of ``search.search_vector``.

Vectors that are null, empty or not finite are left out, as they match nothing; lengths are never mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.search import _RESULT, _Best, _chunks, _slices, _top_k, _union, _unit, vector_fault
from folioflow.session import cut_lineage, join_path, ship_package, spread_small

CELL_ROWS, MAX_CELLS = 4096, 1024
#: Rounding of a distance between vectors of length one.
SLACK = 1e-7
_ROW = "cell int, dim int, id bigint, vector array<double>, away double"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of length one (or zero vectors), from exact differences of near ones too."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def build_vector_index(
    vectors: DataFrame, path: str, *, id_col: str = "vec_id", vector_col: str = "embedding", cell_rows: int = CELL_ROWS
) -> str:
    """Store the cells of ``vectors`` below ``path``: ``rows`` (by cell) and ``cells``."""
    spark = vectors.sparkSession
    ship_package(spark)
    usable = vectors.filter(vector_fault(vector_col).isNull())
    usable = usable.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = spread_small(usable.withColumn("dim", F.size("vector")))
    sizes = usable.groupBy("dim").agg(F.count("*").alias("n")).collect()  # a row per length
    pivots: dict[int, np.ndarray] = {}
    first = 0
    offsets: dict[int, int] = {}
    for dim, n in sorted(tuple(r) for r in sizes):
        cells = int(min(MAX_CELLS, max(1, n // cell_rows)))
        every = max(1, n // (2 * cells))
        some = usable.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("id"), F.lit(every)) == 0)).limit(cells)
        rows = some.collect() or usable.filter(F.col("dim") == dim).limit(1).collect()
        pivots[dim], offsets[dim] = _unit(np.array([r["vector"] for r in rows])), first
        first += len(rows)
    shared = spark.sparkContext.broadcast((pivots, offsets))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, offsets = shared.value
        for batch in _slices(batches):
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                unit = _unit(part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                away = _distances(unit, pivots[dim])
                near = away.argmin(1)
                lists = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * int(dim), unit.ravel())
                cell = pa.array((offsets[dim] + near).astype(np.int32))
                columns = [cell, part.column("dim"), part.column("id"), lists, pa.array(away[np.arange(len(near)), near])]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "dim", "id", "vector", "away"])

    placed = usable.select("id", "vector", "dim").mapInArrow(place, _ROW)
    placed.hint("rebalance", "cell").sortWithinPartitions("cell", "away").write.mode("overwrite").partitionBy("cell").parquet(join_path(path, "rows"))
    shared.destroy()
    flat = [(offsets[d] + i, int(d), v.tolist()) for d in pivots for i, v in enumerate(pivots[d])]
    pivot_rows = spark.createDataFrame(flat, "cell int, dim int, pivot array<double>")
    stored = spark.read.schema(_ROW).parquet(join_path(path, "rows"))
    sizes = stored.groupBy("cell").agg(F.count("*").alias("n"), F.min("away").alias("least"), F.max("away").alias("most"))
    pivot_rows.join(sizes, "cell").write.mode("overwrite").parquet(join_path(path, "cells"))
    return path


class Tally:
    """Rows of one search: in the index, in the cells read, and compared with a query (per query)."""

    def __init__(self, spark: SparkSession):
        self.stored = 0
        self.read, self.compared = (spark.sparkContext.accumulator(0) for _ in range(2))


def search_cells(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int = 10,
    *,
    query_id: str = "query_id",
    query_vector: str = "embedding",
    tally: Tally | None = None,
) -> DataFrame:
    """Exact k nearest vectors per query, from a stored index: ``query_id, doc_id, score, rank``.

    ``tally`` counts the rows that were read and compared; hits are then worked out at once.
    """
    ship_package(spark)
    cells = spark.read.parquet(join_path(path, "cells")).orderBy("cell").collect()  # MAX_CELLS per length at most
    usable = queries.filter(vector_fault(query_vector).isNull()).select(query_id, F.col(query_vector).alias("_vector"))
    usable = usable.withColumn("_dim", F.size("_vector"))
    stored = spark.read.schema(_ROW).parquet(join_path(path, "rows"))
    found = []
    for dim in sorted({c["dim"] for c in cells}):
        own = [c for c in cells if c["dim"] == dim]
        numbers = np.array([c["cell"] for c in own])
        pivots = np.array([c["pivot"] for c in own])
        n, least, most = (np.array([c[x] for c in own]) for x in ("n", "least", "most"))
        if tally:
            tally.stored += int(n.sum())
        for chunk in _chunks(usable.filter(F.col("_dim") == dim), query_id):
            rows = chunk.select(query_id, "_vector").collect()
            if not rows:
                continue
            names = np.array([r[0] for r in rows], np.int64)
            matrix = _unit(np.array([r[1] for r in rows], np.float64))
            away = _distances(matrix, pivots)
            order = np.argsort(away, 1, kind="stable")
            # The nearest cells that hold k rows together give the first bound.
            wanted = np.zeros(away.shape, bool)
            for q in range(len(rows)):
                enough = int(np.searchsorted(np.cumsum(n[order[q]]), k)) + 1
                wanted[q, order[q][:enough]] = True
            start = cut_lineage(_visit(stored, numbers, wanted, names, matrix, away, np.full(len(rows), np.inf), k, tally))
            kth = _top_k(start, k).filter(F.col("rank") == k).select("query_id", "score").collect()
            reach = np.full(len(rows), np.inf)
            place = {int(q): i for i, q in enumerate(names)}
            for q, score in kth:
                reach[place[q]] = np.sqrt(max(0.0, 2 - 2 * score)) + SLACK
            bound = np.maximum(np.maximum(away - most[None], least[None] - away), 0)
            more = (bound <= reach[:, None] + SLACK) & ~wanted
            found += [start, _visit(stored, numbers, more, names, matrix, away, reach, k, tally)]
    hits = _top_k(_union(found, spark), k)
    return cut_lineage(hits) if tally else hits


def _visit(stored, numbers, wanted, names, matrix, away, reach, k: int, tally: Tally | None) -> DataFrame:
    """The k best of each task and query in the cells that ``wanted`` (queries x cells) names."""
    spark = stored.sparkSession
    read = numbers[wanted.any(0)].tolist()
    shared = spark.sparkContext.broadcast((dict(zip(numbers.tolist(), range(len(numbers)), strict=True)), wanted, names, matrix, away, reach))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, wanted, names, matrix, away, reach = shared.value
        best = _Best(len(names), k)
        for batch in _slices(batches):
            at = np.array([place[c] for c in batch.column("cell").to_pylist()], np.int64)
            own = batch.column("away").to_numpy()
            unit = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            open_ = wanted[:, at] & (np.abs(away[:, at] - own[None]) <= reach[:, None] + SLACK)
            rows = np.flatnonzero(open_.any(0))
            if tally:
                tally.read.add(batch.num_rows)
                tally.compared.add(int(open_.sum()))
            if len(rows):
                score = np.where(open_[:, rows], matrix @ unit[rows].T, -np.inf)
                best.add(score, batch.column("id").to_numpy()[rows])
        yield best.batch(names)

    # Cell numbers are few and prune folders of the scan.
    return stored.filter(F.col("cell").isin(read)).select("cell", "id", "vector", "away").mapInArrow(search, _RESULT)
