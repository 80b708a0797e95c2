"""Targets by water filling, and what pivotal rounding promises."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from llm.helpers import DOCS, documents, texts

from folioflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped: set = set()
    while True:
        free = [s for s in order if s not in capped]
        level = max(0.0, share * sum(sizes.values()) - sum(cap * sizes[s] for s in capped)) / (sum(weight[s] for s in free) or 1)
        new = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not new:
            return {s: cap * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= new


def rows_of(spark):
    values = texts(4, 80)
    rows = [(i, t, "en", ["b", "a", "é", None, "B", "tiny"][i % 6 if i % 7 else 1], None) for i, t in enumerate(values)]
    rows += [rows[3]] * 5 + [(None, "one two three", None, "a", None), (None, None, None, None, None), (7, "", None, "void", None)]
    return rows


def test_plan(spark):
    rows = rows_of(spark)
    plan = mixing.plan_mix(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    size = [len(WORD.findall(t or "")) for _, t, *_ in rows]
    sizes = defaultdict(int)
    for (_, _, _, s, _), n in zip(rows, size, strict=True):
        sizes[s] += n
    assert Counter((r.doc_id, r.source, r.size) for r in plan) == Counter((r[0], r[3], n) for r, n in zip(rows, size, strict=True))
    target, taken, largest = wanted(dict(sizes)), defaultdict(int), defaultdict(int)
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert not r.size or int(rate) <= r.copies <= min(2, int(rate + 1))
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]


def test_reduction_tree_of_small_buckets(spark):
    """Several levels of buckets: counts and words still come out right."""
    units = [("s", i, i * 7, float(1 + i % 50), 0.3) for i in range(500)]
    frame = spark.createDataFrame(units, "source string, k1 long, k2 long, w double, f double")
    counts = spark.createDataFrame([("s", 500)], "cs string, n long")
    got = {r.k1: r.f for r in mixing.round_units(frame, counts, bucket=4).collect()}
    assert len(got) == 500 and set(got.values()) <= {0.0, 1.0}
    assert abs(sum(got[i] * w for _, i, _, w, _ in units) - 0.3 * sum(u[3] for u in units)) <= 50
    assert 110 <= sum(got.values()) <= 190


def test_reruns_agree_whatever_the_partitions(spark):
    rows = rows_of(spark)
    runs = [
        Counter((r.doc_id, r.source, r.size, r.copies) for r in mixing.plan_mix(spark.createDataFrame(rows, DOCS).repartition(n)).collect())
        for n in (1, 5)
    ]
    assert runs[0] == runs[1]


def test_mixed_corpus_follows_the_plan(spark):
    docs = documents(spark, texts(6, 40), extra=True)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    plan = Counter()
    for r in mixing.plan_mix(docs).collect():
        plan[(r.doc_id, r.source, r.size)] += r.copies
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in mixed.collect())
    assert got == +plan


def test_empty_and_wordless(spark):
    assert mixing.plan_mix(spark.createDataFrame([], DOCS)).count() == 0
    void = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "a", None)], DOCS)
    assert [(r.size, r.target, r.copies) for r in mixing.plan_mix(void).collect()] == [(0, 0.0, 1)] * 2
