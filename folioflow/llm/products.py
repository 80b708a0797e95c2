"""Exact top-k inner products: norm-sorted vectors, rotated partial sums, Cauchy-Schwarz bounds.

1. Vectors become whole numbers and are written in the order of their lengths, longest first.
   A rotation by the singular vectors of a bounded sample (``SAMPLE`` rows or ``SAMPLE_BYTES``)
   moves most of any product into the leading coordinates; it changes no result.
2. Each query gets a threshold first: its k-th best product with ``HEAD`` of the longest vectors.
3. Queries go to all vectors in blocks of at most ``QUERY_BYTES`` (one broadcast, one written table
   each). A task meets its vectors longest first: a query whose length times the longest vector
   left cannot reach its threshold leaves. For the others the sum over the leading coordinates
   plus the product of what is left of both lengths (Cauchy-Schwarz) bounds the product; pairs
   that may reach the threshold are multiplied in whole numbers, and thresholds rise with the
   k best found so far.
4. The k best of each query and task meet in one ranked window, k rows per query and task.

Work is queries times vectors at worst; what a task holds does not grow with the input.

Defined results: a null vector and one with null or non-finite components takes no part; shorter
vectors count as filled up with zeros; rows with a query's id are its own row and never among its
results; a null id is a candidate, after all others at equal scores, and no query; repeated query
rows have a list each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import ship
from folioflow.llm.vectors import matrix, whole_numbers
from folioflow.session import cut_lineage

TOP, SCALE, EVERY = 10, 1024, 100
SAMPLE, HEAD, SAMPLE_BYTES, QUERY_BYTES = 8192, 8192, 16 << 20, 8 << 20
BLOCK = 1024
SLACK = 1e-9
LAST = np.iinfo(np.int64).max  # stands for a null id


def rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors of the sample, largest singular value first."""
    x = sample.astype(np.float64)
    values, vectors = np.linalg.eigh(x.T @ x)
    return vectors[:, np.argsort(-values, kind="stable")]


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _rest(turned: np.ndarray, lead: int) -> np.ndarray:
    return _norms(turned[:, lead:])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, in whole numbers."""
    return np.einsum("ij,ij->i", a, b)


class Search:
    """The ``k`` best of each of some queries among the vectors met so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, least: np.ndarray, turn: np.ndarray, k: int) -> None:
        order = np.argsort(-_norms(x.astype(np.float64)), kind="stable")
        self.number, self.ids, self.x, self.k = order, ids[order], x[order], k
        self.turn, self.lead = turn, max(1, x.shape[1] // 4)
        self.turned = self.x.astype(np.float64) @ turn
        self.norm, self.rest = _norms(self.turned), _rest(self.turned, self.lead)
        self.least = least[order].astype(np.float64)  # no row below it is among the k best
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), LAST)
        self.full = np.zeros(len(ids), np.int64)
        self.compared = 0

    def add(self, ids: np.ndarray, y: np.ndarray) -> None:
        turned = y.astype(np.float64) @ self.turn
        norm, rest = _norms(turned), _rest(turned, self.lead)
        for i in range(0, len(self.ids), BLOCK):
            reach = self.norm[i : i + BLOCK] * norm.max(initial=0) * (1 + SLACK) + SLACK
            live = i + np.flatnonzero(reach >= self.least[i : i + BLOCK])
            if len(live):
                bound = self.turned[live, : self.lead] @ turned[:, : self.lead].T + np.outer(self.rest[live], rest)
                slack = SLACK * (1 + np.outer(self.norm[live], norm))
                p, q = np.nonzero(bound + slack >= self.least[live][:, None])
                self._take(live[p], q, ids, y)

    def _take(self, p: np.ndarray, q: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
        self.compared += len(p)
        parts = [products(self.x[p[i : i + 65536]], y[q[i : i + 65536]]) for i in range(0, len(p), 65536)]
        score = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        keep = (score >= self.least[p]) & (self.ids[p] != ids[q])
        p, score, found = p[keep], score[keep], ids[q[keep]]
        if not len(p):
            return
        own = np.unique(p)
        held = np.arange(self.k)[None] < self.full[own][:, None]
        p = np.concatenate((p, np.repeat(own, self.full[own])))
        score = np.concatenate((score, self.score[own][held]))
        found = np.concatenate((found, self.found[own][held]))
        order = np.lexsort((found, -score, p))
        p, score, found = p[order], score[order], found[order]
        rank = np.arange(len(p)) - np.searchsorted(p, p)
        best = rank < self.k
        p, rank = p[best], rank[best]
        self.score[p, rank], self.found[p, rank] = score[best], found[best]
        self.full[own] = np.bincount(p, minlength=len(self.ids))[own]
        done = own[self.full[own] == self.k]
        self.least[done] = np.maximum(self.least[done], self.score[done, self.k - 1])

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query (its place in the input), id and score of each row held."""
        held = np.arange(self.k)[None] < self.full[:, None]
        return np.repeat(self.number, self.full), self.found[held], self.score[held]


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def sorted_vectors(table: DataFrame, is_query: Column, vec: str, vec_id: str, scale: int) -> tuple[DataFrame, int]:
    """``vec_id, vec, norm, query, deal`` by falling norm, as a written table, and the vectors' length."""
    slim = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("query"))
    rows, dims = whole_numbers(slim, "vec", scale)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    # Copies have one norm: the second key lets them fall into several ranges.
    rows = rows.withColumns({"norm": norm, "deal": F.xxhash64(F.monotonically_increasing_id())})
    rows = rows.repartitionByRange(F.desc("norm"), "deal").sortWithinPartitions(F.desc("norm"), "deal")
    return cut_lineage(rows), dims


def thresholds(queries: DataFrame, head: pa.Table, dims: int, turn: np.ndarray, k: int) -> DataFrame:
    """``vec_id, vec, deal, least``: the k-th best product of each query with the rows of ``head``."""
    shared = queries.sparkSession.sparkContext.broadcast((_ids(head.column("vec_id")), matrix(head.column("vec"), dims), turn))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, y, turn = shared.value
        for batch in batches:
            x = matrix(batch.column("vec"), dims)
            found = Search(_ids(batch.column("vec_id")), x, np.full(len(x), -np.inf), turn, k)
            for i in range(0, len(ids), BLOCK):
                found.add(ids[i : i + BLOCK], y[i : i + BLOCK])
            least = np.full(len(x), np.nan)
            least[found.number] = found.least
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "vec", "deal")), pa.array(least)], ["vec_id", "vec", "deal", "least"]
            )

    out = cut_lineage(queries.select("vec_id", "vec", "deal").mapInArrow(run, "vec_id long, vec array<long>, deal long, least double"))
    shared.destroy()
    return out


def search_block(vectors: DataFrame, block: pa.Table, dims: int, turn: np.ndarray, k: int) -> DataFrame:
    """``deal, query_id, vec_id, score``: the k best of each task for each query of ``block``, as a written table."""
    ids, deal = _ids(block.column("vec_id")), block.column("deal").to_numpy()
    shared = vectors.sparkSession.sparkContext.broadcast((ids, deal, matrix(block.column("vec"), dims), block.column("least").to_numpy(), turn))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, deal, x, least, turn = shared.value
        found = Search(ids, x, least, turn, k)
        for batch in batches:
            own, y = _ids(batch.column("vec_id")), matrix(batch.column("vec"), dims)
            for i in range(0, len(own), BLOCK):
                found.add(own[i : i + BLOCK], y[i : i + BLOCK])
        at, vec_id, score = found.results()
        yield pa.RecordBatch.from_arrays(
            [pa.array(deal[at]), pa.array(ids[at]), pa.array(vec_id, mask=vec_id == LAST), pa.array(score)],
            ["deal", "query_id", "vec_id", "score"],
        )

    out = cut_lineage(vectors.select("vec_id", "vec").mapInArrow(run, "deal long, query_id long, vec_id long, score long"))
    shared.destroy()
    return out


def top_products(
    table: DataFrame,
    is_query: Column | None = None,
    vec: str = "embedding",
    vec_id: str = "vec_id",
    k: int = TOP,
    scale: int = SCALE,
    head: int = HEAD,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each query row (all, if fewer).

    Queries are the rows where ``is_query`` holds; by default those whose id is divisible by ``EVERY``.
    """
    ship(table)
    own = F.col(vec_id)
    is_query = (own.isNotNull() & (own % EVERY == 0)) if is_query is None else is_query & own.isNotNull()
    vectors, dims = sorted_vectors(table, is_query, vec, vec_id, scale)
    n, asked, cut = vectors.agg(
        F.count("*"), F.count_if("query"), F.percentile_approx("norm", F.lit(max(0.0, 1 - head / max(1, vectors.count()))), F.lit(1000))
    ).first()
    if not asked:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    room = max(64, SAMPLE_BYTES // (8 * max(1, dims)))
    every = max(1, n // min(SAMPLE, room))
    sample = vectors.filter(F.pmod("deal", F.lit(every)) == 0).select("vec").limit(min(SAMPLE, room)).toArrow()
    turn = rotation(matrix(sample.column("vec"), dims))
    longest = vectors.filter(F.col("norm") >= cut).select("vec_id", "vec").limit(min(head, room)).toArrow()
    queries = thresholds(vectors.filter("query"), longest, dims, turn, k)
    blocks = -(-asked * 24 * max(1, dims) // query_bytes)
    block = F.pmod(F.xxhash64("deal"), F.lit(blocks))
    found = [search_block(vectors, queries.filter(block == b).toArrow(), dims, turn, k) for b in range(blocks)]
    rank = F.row_number().over(Window.partitionBy("query_id", "deal").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    best = reduce(DataFrame.union, found).withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
