"""A stored inverted index for full-text search.

``build_text_index`` cuts the documents into shards by the hash of their id, so that no shard and
no list of a word inside one grows with the table, and stores one row per word, shard and block of
``BLOCK`` documents: the first id, the gaps to the following ids, how often the word occurs in each,
and the block's highest count. Rows lie in folders by the hash of the word, sorted by word.

``search_index`` reads the folders and row groups of its words only, and sends the blocks, still
packed, to one group per shard. There a query takes its words by falling weight. Once the words that
are left cannot lift a new document to the k best so far, only documents met already count, and a
block is unpacked only if such a document can be in it; before that, a block whose highest count is
too small brings no new document either. Scores are those of ``search.search_text``.

Documents with a null id are left out; ids have to be unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.search import _RESULT, _by_terms, _chunks, _top_k, _union, tokens
from folioflow.session import join_path, ship_package, spread_small
from folioflow.streaming.state import BUCKET, bucket_of, stored_buckets, write_buckets

SHARD_DOCS, BLOCK = 16_384, 512
SLICE = 512
SLACK = 1e-9
_TABLES = {
    "blocks": "term string, shard int, first bigint, last bigint, gaps array<bigint>, tfs array<int>, max_tf int, _bucket int",
    "terms": "term string, df bigint, max_tf int, _bucket int",
}


def _postings(words: DataFrame) -> DataFrame:
    """``term, id, tf``: each word of a document once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                own = part.column("words")
                coded = pc.dictionary_encode(own.flatten())
                n = max(1, len(coded.dictionary))
                cells = pc.list_parent_indices(own).to_numpy() * n + coded.indices.to_numpy()
                cells, tf = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(cells % n)), part.column("id").take(pa.array(cells // n)), pa.array(tf.astype(np.int32))],
                    ["term", "id", "tf"],
                )

    return words.mapInArrow(count, "term string, id bigint, tf int")


def build_text_index(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int | None = None,
    shard_docs: int = SHARD_DOCS,
    block: int = BLOCK,
) -> str:
    """Store the index of ``docs`` below ``path``: ``blocks``, ``terms`` (with df) and ``meta``."""
    spark = docs.sparkSession
    ship_package(spark)
    buckets = stored_buckets(spark, path, buckets)
    root = join_path(path, f"buckets={buckets}")
    total, known = docs.agg(F.count("*"), F.count(id_col)).first()
    shards = max(1, -(-known // shard_docs))
    rows = spread_small(docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")))
    postings = _postings(rows.select("id", tokens("text").alias("words")).filter(F.size("words") > 0))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    lists = postings.groupBy("term", shard.alias("shard")).agg(F.sort_array(F.collect_list(F.struct("id", "tf"))).alias("p"))
    starts = F.sequence(F.lit(1), F.size("p"), F.lit(block))
    cut = lists.select("term", "shard", "p", F.explode(starts).alias("at")).withColumn("p", F.slice("p", F.col("at"), F.lit(block)))
    ids = F.transform("p", lambda x: x["id"])
    packed = cut.select(
        "term",
        "shard",
        F.get(ids, F.lit(0)).alias("first"),
        F.element_at(ids, -1).alias("last"),
        F.transform(ids, lambda x, i: x - F.get(ids, F.greatest(i - 1, F.lit(0)))).alias("gaps"),
        F.transform("p", lambda x: x["tf"]).alias("tfs"),
        F.array_max(F.transform("p", lambda x: x["tf"])).alias("max_tf"),
        bucket_of(["term"], buckets).alias(BUCKET),
    )
    blocks = join_path(root, "blocks")
    packed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "term").write.mode("overwrite").partitionBy(BUCKET).parquet(blocks)
    stored = spark.read.schema(_TABLES["blocks"]).parquet(blocks)
    frequency = stored.groupBy("term", BUCKET).agg(F.sum(F.size("tfs")).alias("df"), F.max("max_tf").alias("max_tf"))
    write_buckets(frequency, join_path(root, "terms"))
    spark.range(1).select(F.lit(total).cast("long").alias("total")).write.mode("overwrite").parquet(join_path(root, "meta"))
    return path


def postings_of(spark: SparkSession, path: str, table: str, terms: list[str]) -> DataFrame:
    """Rows of ``blocks`` or ``terms`` for these words; folders and row groups of others are not read."""
    buckets = stored_buckets(spark, path)
    rows = spark.read.schema(_TABLES[table]).parquet(join_path(path, f"buckets={buckets}", table))
    words = spark.createDataFrame([(t,) for t in terms], "term string")
    folders = [r[0] for r in words.select(bucket_of(["term"], buckets)).distinct().collect()]
    return rows.filter(F.col(BUCKET).isin(folders) & F.col("term").isin(terms))


class _Query:
    """The k best documents of one shard for one query."""

    def __init__(self, k: int):
        self.k, self.least = k, 0.0
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0)
        self.opened = 0

    def add(self, blocks: list[tuple[int, int, int, int]], unpack, weight: float, rest: float) -> None:
        """Take a word's blocks (first id, last id, number, highest count); later words add ``rest`` at most."""
        for first, last, number, most in blocks:
            bound = (weight * (1 + np.log(most)) + rest) * (1 + SLACK)
            new = bound >= self.least
            held = np.searchsorted(self.ids, first), np.searchsorted(self.ids, last, "right")
            if not new and held[0] == held[1]:
                continue
            self.opened += 1
            gaps, tfs = unpack(number)
            ids = first + np.cumsum(gaps)
            points = weight * (1 + np.log(tfs))
            place = np.searchsorted(self.ids, ids)
            known = np.zeros(len(ids), bool)
            inside = place < len(self.ids)
            known[inside] = self.ids[place[inside]] == ids[inside]
            self.scores[place[known]] += points[known]
            if new and not known.all():
                order = np.concatenate((self.ids, ids[~known]))
                at = np.argsort(order, kind="stable")
                self.ids, self.scores = order[at], np.concatenate((self.scores, points[~known]))[at]
        if len(self.scores) >= self.k:
            self.least = max(self.least, np.partition(self.scores, -self.k)[-self.k])

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids, -self.scores))[: self.k]
        return self.ids[order], self.scores[order]


def _score_shard(table: pa.Table, queries: list[tuple[int, list[str]]], weights: dict[str, tuple[float, int]], k: int) -> tuple[list, int]:
    """Hits of one shard, and how many blocks were unpacked."""
    lists: dict[str, list] = {}
    columns = [table.column(c).to_pylist() for c in ("term", "first", "last")]
    gaps, tfs = (table.column(c).combine_chunks() for c in ("gaps", "tfs"))
    most = table.column("max_tf").to_pylist()
    for i, (term, first, last) in enumerate(zip(*columns, strict=True)):
        lists.setdefault(term, []).append((first, last, i, most[i]))
    hits, opened = [], 0

    def unpack(i: int) -> tuple[np.ndarray, np.ndarray]:
        return gaps[i].values.to_numpy(), tfs[i].values.to_numpy()

    for query_id, words in queries:
        own = sorted(((weights[w], w) for w in words if w in lists and weights.get(w, (0.0, 0))[0] > 0), reverse=True)
        bounds = [w * (1 + np.log(max(b[3] for b in lists[t]))) for (w, _), t in own]
        query = _Query(k)
        for n, ((weight, _), term) in enumerate(own):
            query.add(sorted(lists[term]), unpack, weight, sum(bounds[n + 1 :]))
        opened += query.opened
        hits += [(query_id, int(i), float(s)) for i, s in zip(*query.best(), strict=True)]
    return hits, opened


def _shard_scorer(shared, k: int):
    def score(table: pa.Table) -> pa.Table:
        hits, _ = _score_shard(table, *shared.value, k)
        columns = list(zip(*hits, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "doc_id", "score"])

    return score


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 10, *, query_id: str = "query_id", query_text: str = "text"
) -> DataFrame:
    """Exact top-k documents per query, from a stored index: ``query_id, doc_id, score, rank``."""
    ship_package(spark)
    buckets = stored_buckets(spark, path)
    total = spark.read.parquet(join_path(path, f"buckets={buckets}", "meta")).first()["total"]
    wanted = queries.select(F.col(query_id).cast("bigint"), F.array_distinct(tokens(query_text)).alias("words"))
    found = []
    for chunk in _chunks(wanted, query_id):
        for rows in _by_terms(chunk.collect()):
            terms = sorted({t for r in rows for t in r[1]})
            if not terms:
                continue
            known = postings_of(spark, path, "terms", terms).collect()  # a row per word
            weights = {r["term"]: (float(np.log(total / r["df"])), r["df"]) for r in known}
            shared = spark.sparkContext.broadcast(([(r[0], r[1]) for r in rows], weights))

            blocks = postings_of(spark, path, "blocks", terms).drop(BUCKET)
            found.append(blocks.groupBy("shard").applyInArrow(_shard_scorer(shared, k), _RESULT))
    return _top_k(_union(found, spark), k)
