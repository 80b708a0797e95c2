"""SimHash components against all pairs."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
import xxhash
from llm.helpers import DOCS, broadcast_explodes, documents, texts
from pyspark.sql import functions as F

from folioflow.llm import simhash
from folioflow.llm.common import _forest, components, hash_sample
from folioflow.session import cut_lineage


def naive(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(items, near):
    """Component label of each item: the smallest one reachable."""
    label = {i: i for i in items}
    changed = True
    while changed:
        changed = False
        for a in items:
            for b in items:
                if near(a, b) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprints_and_components(spark):
    values = [t for t in texts() if t is None or len(t) < 10_000]
    got = simhash.simhash_components(documents(spark, values, extra=True)).collect()
    assert len(got) == len(values) + 4
    fps = {i: naive(t) for i, t in enumerate(values)}
    label = smallest(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    for r in got:
        if r.doc_id is not None:
            assert r.fp & (2**64 - 1) == fps[r.doc_id]
            assert r.component == label[r.doc_id]


@pytest.mark.parametrize("hot", [4096, 3])
def test_pairs_equal_all_pairs(spark, hot):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:  # neighbours at every distance, and many that share a half
        for k in (1, 2, 3, 4, 5):
            fps.add(b ^ sum(1 << x for x in rng.sample(range(64), k)))
        fps.add((b & 0xFFFFFFFF) | rng.getrandbits(32) << 32)
    fps |= {base[0] ^ (1 << k) for k in range(64)} | {(base[1] & ~0xFFFFFFFF) | rng.getrandbits(32) for _ in range(20)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    found = simhash.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long"), hot=hot)
    got = {(r.a, r.b) for r in found.collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert got == want and want


@pytest.mark.parametrize("hot", [4096, 3])
def test_exploded_keys_are_not_broadcast(spark, hot):
    rng = random.Random(6)
    rows = [(rng.getrandbits(62),) for _ in range(50)] + [(7 << 32 | i,) for i in range(20)]
    fps = cut_lineage(spark.createDataFrame(rows, "fp long"))  # a written table: its size is known and small
    assert broadcast_explodes(fps.alias("i").join(simhash._segments(fps).alias("p"), "fp"))
    assert broadcast_explodes(simhash.near_pairs(fps, hot=hot)) == []


def test_one_of_each_group_stays(spark):
    values = texts(2, 30)
    docs = documents(spark, values, extra=True)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    best = {r.component for r in simhash.simhash_components(docs).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(i for i in best if i is not None)
    assert len(ids) == len(best)


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert simhash.simhash_components(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    order = list(range(1, 400))
    rng.shuffle(order)
    chain = list(zip(order, order[1:], strict=False))
    star = [(1000 + i, 5000) for i in range(300)]
    edges = spark.createDataFrame(chain + star + [(9000, 9000)], "a long, b long").repartition(16)
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 1 for i in range(1, 400)} | {1000 + i: 1000 for i in range(300)} | {5000: 1000}


def test_forest_in_pieces_keeps_components():
    rng = random.Random(8)
    edges = [(a, b) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(260)) if a != b]
    batches = [pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in edges[i : i + 10]]) for i in range(0, len(edges), 10)]
    whole, cut = (
        [(r["a"], r["b"]) for out in _forest(iter(batches), most) for r in out.to_pylist()] for most in (10**6, 25)
    )
    nodes = {x for e in edges for x in e}
    label = lambda pairs: smallest(nodes, lambda a, b, p={*pairs, *((b, a) for a, b in pairs)}: (a, b) in p)
    assert label(edges) == label(whole) == label(cut)
    assert len(whole) < len(edges)


def test_star_under_one_root(spark):
    n = 300_000
    leaves = spark.range(1, n + 1, 1, 16).selectExpr("id as a", "0L as b")
    chain = spark.range(0, 8, 1, 2).selectExpr("-id - 1 as a", "-id as b")  # the root has smaller ones below it
    found = components(leaves.union(chain)).groupBy("root").count().collect()
    assert [(r.root, r["count"]) for r in found] == [(-8, n + 9)]


def test_sample_by_hash(spark):
    rows = spark.range(0, 50_000, 1, 8)
    key = F.xxhash64("id")
    for n in (100, 60_000):
        want = [r.id for r in rows.orderBy(key, "id").limit(n).collect()]
        got = hash_sample(rows, key, 50_000, n, "id")
        assert [r.id for r in got.collect()] == want
