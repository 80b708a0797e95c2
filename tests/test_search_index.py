"""Stored search indexes against the full scan, and what they leave unread."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from folioflow.operators.search import search_text, search_vector
from folioflow.operators.text_index import _score_shard, build_text_index, postings_of, search_index
from folioflow.operators.vector_index import Tally, build_vector_index, search_cells

DOCS = "doc_id long, text string"


def words(rng, n):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(n))


def hits(frame):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 6)) for r in frame.collect())


def test_text_index_equals_the_scan(spark, tmp_path):
    rng = random.Random(4)
    texts = [words(rng, rng.randint(0, 200)) for _ in range(600)] + ["", " ", "w1 w1 w1", "Ünï code w2", "w3 " * 4000]
    docs = spark.createDataFrame([(i * 7 - 50, t) for i, t in enumerate(texts)] + [(9999, None)], DOCS).repartition(4)
    queries = spark.createDataFrame([(q, words(rng, 1 + q % 9)) for q in range(40)] + [(90, "nowhere"), (91, ""), (92, "ünï")], "query_id long, text string")
    path = build_text_index(docs, str(tmp_path / "index"), shard_docs=200, block=16)
    for k in (1, 10):
        assert hits(search_index(spark, path, queries, k)) == hits(search_text(docs, queries, k))
    # Another search reads the postings of its words, in their folders alone.
    own = postings_of(spark, path, "blocks", ["w2", "nowhere"])
    assert {r.term for r in own.select("term").distinct().collect()} == {"w2"}
    every = spark.read.parquet(f"{tmp_path}/index/buckets=8/blocks")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and "PushedFilters: [In(term" in plan
    assert own.count() < every.count() / 20
    assert every.filter(F.size("tfs") > 16).isEmpty() and every.filter("shard > 3").isEmpty()


def test_text_index_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([(None, "w1 w2"), (1, None)], DOCS)
    path = build_text_index(empty, str(tmp_path / "index"))
    queries = spark.createDataFrame([(1, "w1")], "query_id long, text string")
    assert hits(search_index(spark, path, queries)) == []


def test_blocks_without_a_chance_stay_packed():
    import pyarrow as pa

    rare = [("rare", 0, 4000, [0, 4000], [9, 9], 9)]
    common = [("common", i * 100, i * 100 + 99, [0] + [1] * 99, [1] * 100, 1) for i in range(100)]
    names = ("term", "first", "last", "gaps", "tfs", "max_tf")
    table = pa.table({n: [r[i] for r in rare + common] for i, n in enumerate(names)})
    found, opened = _score_shard(table, [(1, ["rare", "common"])], {"rare": (8.0, 2), "common": (0.5, 10_000)}, 2)
    assert [h[:2] for h in found] == [(1, 0), (1, 4000)] and found[0][2] == 8 * (1 + math.log(9)) + 0.5
    assert opened == 3  # the rare word's block, and the two common ones that hold its documents


def test_vector_cells_equal_the_scan_and_skip_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(20, 16))
    rows = [(i, (centers[i % 20] + 0.05 * rng.normal(size=16)).tolist()) for i in range(4000)]
    rows += [(5000, None), (5001, []), (5002, [math.nan] * 16), (5003, [1.0, 2.0, 3.0]), (5004, [0.0] * 16), (5005, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    asked = [(q, rows[q * 17][1]) for q in range(12)] + [(100, [3.0, 2.0, 1.0]), (101, [0.0] * 16), (102, None), (103, [1.0] * 5)]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    path = build_vector_index(vectors, str(tmp_path / "cells"), cell_rows=100)
    tally = Tally(spark)
    got = search_cells(spark, path, queries, 5, tally=tally)
    assert hits(got) == hits(search_vector(vectors, queries, 5))
    assert tally.stored == 4003

    tally = Tally(spark)
    near = queries.filter("query_id < 12")
    assert hits(search_cells(spark, path, near, 5, tally=tally)) == hits(search_vector(vectors, near, 5))
    # Twelve of twenty groups are asked for: other cells stay unread, and few rows of those are compared.
    assert tally.read.value < 2 * 4003 and tally.compared.value < 0.25 * 12 * 4000


def test_vector_index_of_nothing(spark, tmp_path):
    vectors = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<double>")
    path = build_vector_index(vectors, str(tmp_path / "cells"))
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert hits(search_cells(spark, path, queries)) == []
