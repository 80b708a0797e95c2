"""Top products against all inner products in whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import products

ROWS = "vec_id long, embedding array<double>, label int, rank int, score long, norm double"


def table(n=500, dims=24, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dims)) * rng.gamma(1, 1, (n, 1))
    x[50:120] = x[100]  # ties
    return [(i, v.tolist(), 1, 7, 7, 7.0) for i, v in enumerate(x)]


AWKWARD = [
    (600, None, 1, None, None, None),
    (700, [0.1, math.nan], 1, None, None, None),
    (800, [None] * 24, None, None, None, None),
    (900, [], 1, None, None, None),
    (1000, [3.0, -2.0], None, None, None, None),
    (None, [0.5] * 24, 2, None, None, None),
    (100, [0.25] * 24, 2, None, None, None),  # an id that occurs twice
    (1100, [-0.0] * 24, 2, None, None, None),
    (1200, [1e30, -1e30], 2, None, None, None),  # cut to what sums of products allow
]


def plain(rows, k=10, scale=1024, every=100):
    kept = [(i, v) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v in kept), default=0)
    most = int(2**30 / math.sqrt(max(1, dims)))
    kept = [(i, [max(-most, min(most, math.floor(scale * x))) for x in v]) for i, v in kept]
    out = []
    for q, v in kept:
        if q is not None and q % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), i is None, i or 0) for i, w in kept if i is None or i != q]
            out += [(q, r + 1, None if gone else i, -s) for r, (s, gone, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("more", [{}, {"head": 16, "query_bytes": 1024}, {"k": 700}], ids=["one block", "blocks", "more than rows"])
def test_equal_to_all_products(spark, more):
    rows = table() + AWKWARD + table()[200:202]
    got = products.top_products(spark.createDataFrame(rows, ROWS).repartition(5), **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, k=more.get("k", 10))


def test_own_queries_and_no_queries(spark):
    rows = table(130, 6)
    frame = spark.createDataFrame(rows, ROWS)
    got = products.top_products(frame, F.col("vec_id") % 7 == 3, k=4)
    want = [x for x in plain(rows, 4, every=1) if x[0] % 7 == 3]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert products.top_products(frame, F.col("vec_id") < 0).collect() == []
    assert products.top_products(frame.limit(0)).collect() == []


def test_bounds_skip_most_products():
    """Lengths that differ much, and coordinates of which a few hold most: few pairs are multiplied."""
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(4000, 32)) * rng.gamma(0.3, 1, (4000, 1)) * (0.5 ** np.arange(32)) * 1000).astype(np.int64)
    x = x[np.argsort(-np.linalg.norm(x, axis=1))]
    turn = products.rotation(x[::7])
    assert np.allclose(turn @ turn.T, np.eye(32))
    found = products.Search(np.arange(50), x[:50], np.full(50, -np.inf), turn, 10)
    for i in range(0, 4000, 256):
        found.add(np.arange(i, min(4000, i + 256)), x[i : i + 256])
    assert found.compared < 0.1 * 50 * 4000
    at, ids, score = found.results()
    every = x[:50] @ x.T
    every[np.arange(50), np.arange(50)] = -(1 << 60)
    for q in range(50):
        order = np.lexsort((np.arange(4000), -every[q]))[:10]
        assert ids[at == q].tolist() == order.tolist()
        assert score[at == q].tolist() == every[q][order].tolist()
