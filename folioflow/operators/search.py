"""Full-text and vector search over whole tables.

Both score inside the scan tasks and keep only the best k rows per query there, so
what is shuffled is k rows per query and task, however large the table and however
common a word is. The query side is bounded: queries are taken in chunks of at most
``MAX_QUERIES`` (and ``MAX_TERMS`` distinct words), one broadcast each; more queries
mean more chunks, never a bigger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.ordering import rank_rows
from folioflow.session import cut_lineage, ship_package, spread_small

MAX_QUERIES = 1000
MAX_TERMS = 20_000
SLICE = 512
_RESULT = "query_id bigint, doc_id bigint, score double"


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


class _Best:
    """Best k (score, id) per query seen so far; ties go to the smaller id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.scores = np.full((n_queries, 0), -np.inf)
        self.ids = np.zeros((n_queries, 0), dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: queries x rows, -inf where a row is no hit."""
        every = np.hstack([self.scores, scores])
        names = np.hstack([self.ids, np.broadcast_to(ids, (scores.shape[0], len(ids)))])
        top = np.lexsort((names, -every), axis=-1)[:, : self.k]
        self.scores, self.ids = np.take_along_axis(every, top, 1), np.take_along_axis(names, top, 1)

    def batch(self, query_ids: np.ndarray) -> pa.RecordBatch:
        hit = np.isfinite(self.scores)
        rows, _ = np.nonzero(hit)
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[rows]), pa.array(self.ids[hit]), pa.array(self.scores[hit])],
            names=["query_id", "doc_id", "score"],
        )


def _chunks(queries: DataFrame, id_col: str) -> Iterator[DataFrame]:
    n = queries.count()
    parts = -(-n // MAX_QUERIES)
    if parts <= 1:
        yield queries
        return
    # Positions, not hashes: a chunk never has more rows than it may, whatever the ids are.
    kept = cut_lineage(rank_rows(queries.withColumn("_all", F.lit(0)), ["_all"], [id_col], "_place"))
    for part in range(parts):
        yield kept.filter(F.floor((F.col("_place") - 1) / MAX_QUERIES) == part).select(*queries.columns)


def _top_k(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _union(parts: list[DataFrame], spark) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], _RESULT)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def search_vector(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "embedding",
) -> DataFrame:
    """Exact k nearest vectors per query by cosine similarity.

    Queries are compared with vectors of their own length; unusable ones on either side
    (see ``vector_fault``) match nothing.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    usable = queries.filter(vector_fault(query_vector).isNull()).select(query_id, F.col(query_vector).alias("_vector"))
    usable = usable.withColumn("_dim", F.size("_vector"))
    every = vectors.filter(vector_fault(vector_col).isNull())
    every = spread_small(every.select(F.col(id_col).cast("bigint"), F.col(vector_col).cast("array<double>").alias("_vector")))
    found = []
    lengths = [r[0] for r in usable.select("_dim").distinct().collect()]
    for dim, chunk in ((d, c) for d in sorted(lengths) for c in _chunks(usable.filter(F.col("_dim") == d), query_id)):
        table = every.filter(F.size("_vector") == dim)
        rows = chunk.select(query_id, "_vector").collect()
        if not rows:
            continue
        names = np.array([r[0] for r in rows], dtype=np.int64)
        shared = spark.sparkContext.broadcast((names, _unit(np.array([r[1] for r in rows], dtype=np.float64))))

        def score(batches, shared=shared):
            names, matrix = shared.value
            best = _Best(len(names), k)
            for batch in _slices(batches):
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                unit = _unit(flat.reshape(batch.num_rows, -1))
                best.add(matrix @ unit.T, batch.column(0).to_numpy())
            yield best.batch(names)

        found.append(table.mapInArrow(score, _RESULT))
    return _top_k(_union(found, spark), k)


def vector_fault(vector: Column | str) -> Column:
    """Why a vector cannot be compared: ``null``, ``empty`` or ``not finite``; null when it can."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(v.isNull(), "null").when(F.size(v) == 0, "empty").when(~fine, "not finite")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``SLICE`` rows, whatever the session's Arrow batch size is."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms == 0, 1.0, norms)


def document_frequency(words: DataFrame, terms: DataFrame) -> DataFrame:
    """Number of rows of ``words`` each of the (bounded) terms occurs in; combined map-side."""
    words = words.select(F.explode(F.array_distinct("words")).alias("term"))
    return words.join(F.broadcast(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def search_text(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id: str = "query_id",
    query_text: str = "text",
) -> DataFrame:
    """Exact top-k documents per query by tf-idf over whole texts.

    Score: the sum of ``(1 + ln tf) * ln(N / df)`` over the distinct query words the
    document holds. Documents that share no word, or only words all documents hold,
    are no hits.
    """
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.count()
    table = spread_small(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")))
    table = table.select("id", tokens("text").alias("words"))
    found = []
    wanted = queries.select(F.col(query_id).cast("bigint"), F.array_distinct(tokens(query_text)).alias("words"))
    for chunk in _chunks(wanted, query_id):
        for rows in _by_terms(chunk.collect()):
            terms = sorted({t for r in rows for t in r[1]})
            if not terms:
                continue
            counts = document_frequency(table, spark.createDataFrame([(t,) for t in terms], "term string"))
            df = {r["term"]: r["df"] for r in counts.collect()}  # at most MAX_TERMS rows
            weights = np.zeros((len(terms), len(rows)))
            place = {t: i for i, t in enumerate(terms)}
            for q, row in enumerate(rows):
                for t in row[1]:
                    if t in df:
                        weights[place[t], q] = np.log(total / df[t])
            names = np.array([r[0] for r in rows], dtype=np.int64)
            shared = spark.sparkContext.broadcast((names, terms, weights))
            found.append(table.mapInArrow(_text_scorer(shared, k), _RESULT))
    return _top_k(_union(found, spark), k)


def _by_terms(rows: list) -> Iterator[list]:
    """Split collected queries so that no part has more than ``MAX_TERMS`` words (one query at least)."""
    part, size = [], 0
    for row in rows:
        if part and size + len(row[1]) > MAX_TERMS:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row[1])
    if part:
        yield part


def _text_scorer(shared, k: int):
    def score(batches):
        names, terms, weights = shared.value
        vocabulary, best = pa.array(terms, pa.string()), _Best(len(names), k)
        for batch in _slices(batches):
            n, words = batch.num_rows, batch.column(1)
            place = pc.index_in(words.flatten(), value_set=vocabulary)
            rows = pc.list_parent_indices(words).to_numpy()
            known = place.is_valid().to_numpy(zero_copy_only=False)
            cell = rows[known] * len(terms) + place.drop_null().to_numpy()
            at, tf = np.unique(cell, return_counts=True)
            matrix = np.zeros(n * len(terms))
            matrix[at] = 1.0 + np.log(tf)
            points = (matrix.reshape(n, len(terms)) @ weights).T
            best.add(np.where(points > 0, points, -np.inf), batch.column(0).to_numpy())
        yield best.batch(names)

    return score
