"""Language-model scores against exact counts, and the filter's promises."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.helpers import DOCS, documents, texts

from folioflow.llm import lm
from folioflow.llm.common import crc_fold


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


def words(text):
    return [*(text or "").encode().lower().split(), None]


@pytest.mark.parametrize("max_table", [2_000_000, 30, 0])
def test_base_scores_are_exact(spark, max_table):
    values = texts(7, 40)
    docs = documents(spark, values, extra=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = Counter(w for i, t in rows if fold(i) != 2 for w in words(t))
    total = sum(counts.values())
    want = Counter()
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in w)
        want[i, len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)] += 1
    got = lm.score_texts(docs, crc_fold("doc_id", 7) != 2, bits=1 << 20, max_table=max_table).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_model_prefers_what_it_was_trained_on(spark):
    values = texts(9, 60)[:60]
    shuffled = [" ".join(sorted(v.split(), key=lambda w: zlib.crc32(w.encode()))) for v in values]
    rows = [(i, t, None, None, None) for i, t in enumerate([*values, *shuffled])]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.score / r.n_tokens for r in lm.score_texts(docs, docs["doc_id"] < 60, bits=1 << 22).collect()}
    assert sum(got[i] for i in range(60)) > sum(got[i] for i in range(60, 120))


def test_score_is_the_models_probability(spark):
    """Recount with exact levels: only false hits of the filter may differ, and it is nearly empty."""
    values = ["a b a b c", "a b", "d", "a b a b a b c c", None]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(values)], DOCS)
    got = {r.doc_id: r.score for r in lm.score_texts(docs, docs["doc_id"] >= 0, bits=1 << 20).collect()}
    single, pair = Counter(), Counter()
    for t in values:
        w = words(t)
        single.update(w)
        pair.update(zip([None, *w], w, strict=False))
    total = sum(single.values())

    def level(c, least=1):
        if c < least:
            return 0.0
        q = 1 + math.floor(math.log(c) / math.log(lm.BASE) + 1e-9)
        return (lm.BASE ** (q - 1) + lm.BASE**q) / 2

    for i, t in enumerate(values):
        score = 0.0
        for before, w in zip([None, *words(t)], words(t), strict=False):
            floor = (level(single[w]) + 1) / (total + len(single) + 1)
            follow = min(level(pair[before, w], lm.PAIR_CUTOFF) / level(single[before]), 1.0)
            score += math.log10(lm.MIX * follow + (1 - lm.MIX) * floor)
        assert got[i] == pytest.approx(score)


def test_filter_never_lowers_a_count(spark):
    keys = lm.mixed(np.arange(1, 3001, dtype=np.uint64), 9)
    counts = np.arange(1, 3001)
    bits, buckets = 1 << 20, 32
    order = np.argsort(keys)
    rows = [
        (0, b, keys[order][m].tobytes(), counts[order][m].astype(np.int64).tobytes())
        for b in range(buckets)
        if (m := lm.bucket_of(keys[order], buckets) == b).any()
    ]
    frame = spark.createDataFrame([(k, b, bytearray(x), bytearray(y)) for k, b, x, y in rows], "kind int, bucket int, keys binary, counts binary")
    filter_ = lm.build_filter(frame, (1, 1), buckets, bits)
    want = (lm.BASE ** (lm.level(counts) - 1.0) + lm.BASE ** lm.level(counts)) / 2
    assert (lm.lookup(filter_, keys, buckets) >= want).all()
    missing = lm.lookup(filter_, lm.mixed(np.arange(10_000, 20_000, dtype=np.uint64), 9), buckets)
    assert (missing > 0).mean() < 0.02
    assert lm._least_levels([[0, 100, 0], [0, 10_000, 10]], 8000) == (1, 2)


def test_no_training_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", None, None, None), (2, None, None, None, None)], DOCS)
    got = {r.doc_id: tuple(r)[1:] for r in lm.score_texts(docs, docs["doc_id"] < 0, bits=1 << 16).collect()}
    assert got == {1: (3, 0, 0, 0.0, 0.0), 2: (1, 0, 0, 0.0, 0.0)}
    assert lm.score_texts(docs.limit(0), docs["doc_id"] > 0, bits=1 << 16).count() == 0


@pytest.mark.parametrize("part_bits", [1 << 40, 1 << 17])
def test_filter_grows_with_the_entries(spark, monkeypatch, part_bits):
    """More pairs seen once than a filter of the least size holds: none is lost, in one part or in many."""
    monkeypatch.setattr(lm, "FILTER_BITS", 1 << 14)
    values = [" ".join(f"w{(i * 7919 + k * (i + 3)) % 4001}" for k in range(60)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([*values, None])], DOCS)
    got = {r.doc_id: r.score for r in lm.score_texts(docs, docs["doc_id"] >= 0, part_bits=part_bits).collect()}
    single, pair = Counter(), Counter()
    for t in [*values, None]:
        w = words(t)
        single.update(w)
        pair.update(zip([None, *w], w, strict=False))
    total, n = sum(single.values()), len(single)
    worth = lambda c: (lm.BASE ** (q := math.floor(math.log(c) / math.log(lm.BASE) + 1e-9)) + lm.BASE ** (q + 1)) / 2
    for i, t in enumerate([*values, None]):
        steps = list(zip([None, *words(t)], words(t), strict=False))
        terms = [lm.MIX * min(worth(pair[s]) / worth(single[s[0]]), 1) + (1 - lm.MIX) * (worth(single[s[1]]) + 1) / (total + n + 1) for s in steps]
        # A false hit raises a count by a level or two; a lost pair would cost more than a power of ten.
        assert abs(got[i] - sum(map(math.log10, terms))) / len(steps) < 0.03


def test_parts_give_the_same_scores(spark):
    docs = documents(spark, texts(5, 30))
    train = crc_fold("doc_id", 7) != 2
    one, many = ({(r.doc_id, r.n_tokens, round(r.score, 9)) for r in lm.score_texts(docs, train, part_bits=b).collect()} for b in (1 << 40, 1 << 26))
    assert one == many
