"""Embedding links against all pairs in double precision."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from folioflow.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=400, dim=10):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[i % 12] + rng.normal(size=dim) * rng.choice([0.02, 0.08, 0.3])
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3 if i % 10 else 0))
    rows += [(n + i, rows[5][1], rows[5][2]) for i in range(30)]  # copies
    rows += [(n + 50 + i, [2 * x for x in rows[6][1]], rows[6][2]) for i in range(3)]
    return rows


def brute(rows):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.98:
                links[a].add(b)
    out = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        out[k] = len(links[k]), min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
    return out


@pytest.mark.parametrize("block, list_rows", [(4096, 512), (7, 10)])
def test_links_and_components(spark, monkeypatch, block, list_rows):
    monkeypatch.setattr(embeddings.link_classes, "__defaults__", (embeddings.LEAST, block))
    monkeypatch.setattr(embeddings.train, "__defaults__", (embeddings.SAMPLE, list_rows))
    rows = vectors()
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 10, [nan] * 10, [inf] + [1.0] * 9, [None] + [1.0] * 9, [1.0], [2.0], [1.0, 0.0, 0.0], [1e-30] * 10, [3e38] * 10]
    rows += [(900 + k, v, 1) for k, v in enumerate(odd)] + [(950, rows[0][1], None), (951, rows[0][1], None)]
    want = brute(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.vec_id: r for r in embeddings.near_vectors(table.withColumn("cid", table.vec_id).withColumn("m", table.label)).collect()}
    assert len(got) == len(rows)
    for k, (i, _, _) in enumerate(rows):
        assert (got[i].n_links, got[i].component_id) == want[k], rows[k]
        assert got[i].kept == (got[i].component_id == i)


def test_repeated_rows_and_null_ids(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 0), (1, v, 0), (None, v, 0), (None, [5.0, -1.0], 0), (2, [5.0, 5.0], 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(1, 2, 1, True)] * 2 + [(None, 2, 1, None), (None, 0, None, None), (2, 0, 2, True)], key=str)


def test_unseen_length_is_searched_whole(spark):
    rows = [(i, [1.0, float(i)] if i < 5 else [1.0, 2.0, float(i)], 0) for i in range(10)]
    table = spark.createDataFrame(rows, SCHEMA)
    keys, own = embeddings.vector_classes(table, "embedding", "label", "vec_id")
    models = embeddings.train(own.filter("dim = 2"))
    found = embeddings.link_classes(own, models).filter("b is null").collect()
    want = brute(rows)
    ids = {r.cid: r.least for r in own.collect()}
    assert {ids[r.a]: r.n for r in found} == {rows[k][0]: n for k, (n, _) in want.items() if n}


def test_no_code_is_dropped_that_could_be_a_link():
    rng = np.random.default_rng(3)
    x = embeddings.unit(rng.normal(size=(500, 20)))
    near = embeddings.unit(x + rng.normal(size=x.shape) * 0.02)
    model = embeddings.Quantiser(x, 8)
    radius = math.sqrt(0.04)
    home, _ = model.probes(near, radius)
    codes, error = model.encode(near, home)
    _, mask = model.probes(x, radius)
    for k in range(500):
        if x[k] @ near[k] >= 0.98:
            assert mask[k, home[k]]
            assert model.lookup(x[k : k + 1], home[k], codes[k : k + 1])[0, 0] <= radius + error[k] + 1e-6


def test_empty(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    random.seed(0)
    assert embeddings.near_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect()[0].kept
