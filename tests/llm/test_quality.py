"""The additive model: held-out accuracy, additivity, and awkward inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm.helpers import DOCS, documents, texts

from folioflow.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def test_fit_finds_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:4000], y[:4000])
    assert ((model.score(x[4000:]) >= 0.5) == (y[4000:] == 1)).mean() > 0.93
    assert any({a, b} == {0, 1} for a, b, _ in model.pairs)


def test_score_is_a_sum_of_table_cells():
    rng = np.random.default_rng(2)
    x = rng.random((500, 3))
    model = quality.fit(x, (x[:, 0] + x[:, 1] > 1).astype(float))
    row = x[7]
    total = model.base + sum(t[int((c < v).sum())] for t, c, v in zip(model.tables, model.cuts, row, strict=True))
    total += sum(t[int((model.coarse[a] < row[a]).sum()), int((model.coarse[b] < row[b]).sum())] for a, b, t in model.pairs)
    assert model.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice("river stone light paper green water north clock".split()) + str(rng.randint(0, 999)) for _ in range(rng.randint(30, 90))]
        bad = i % 4 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 8 else [words[0]] * 50
        rows.append((i, " ".join(words), "en", f"src{i % 3}", None))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    import zlib

    rows, labels = corpus()
    # Labels of the held-out third are turned round: a model that saw them would be worse.
    given = [(i, q if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - q, t) for i, q, t in labels]
    scored = quality.score_quality(spark.createDataFrame(rows, DOCS), spark.createDataFrame(given, LABELS)).collect()
    wrong = [r.doc_id for r in scored if (r.score >= 0.5) != (r.doc_id % 4 != 0)]
    assert len(scored) == 400 and len(wrong) <= 4 and all(0 <= r.score <= 1 for r in scored)


def test_rejected_rows_go_and_the_rest_is_untouched(spark):
    rows, labels = corpus()
    rows += [(1000, None, None, None, None), (None, rows[1][1], None, None, 5), rows[1]]
    docs = spark.createDataFrame(rows, DOCS)
    kept = quality.keep_quality(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 2 and None in ids
    assert sum(i is not None and i < 400 and i % 4 == 0 for i in ids) <= 3 and sum(i is not None and i % 4 > 0 for i in ids) >= 295


def test_awkward_inputs(spark):
    docs = documents(spark, texts(1, 10), extra=True)
    for labels in ([], [(None, 1, 0), (1, None, 0)], [(1, 1, 0), (2, 1, 0)]):
        known = spark.createDataFrame(labels, LABELS)
        assert {r.score for r in quality.score_quality(docs, known).collect()} == {1.0}
        assert quality.keep_quality(docs, known).count() == docs.count()
    assert quality.score_quality(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0
    twice = spark.createDataFrame([(i, q, 0) for i in range(10) for q in (0, 1)] + [(i, 1, 0) for i in range(10, 16)], LABELS)
    assert quality.score_quality(docs, twice).count() == docs.count()
