"""Text statistics against plain Python, and what a learned list does."""

from __future__ import annotations

import random
import re
from collections import Counter

from llm.helpers import DOCS, documents, texts
from pyspark.sql import functions as F

from folioflow.llm import rulelist

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stats(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    rng = random.Random(2)
    short = ["".join(rng.choice(["a ", "b ", "c ", "\n", "#", "  ", "|", "é ", "\x0b", "\x85", "ab"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    values = [*short, *texts(5, 20), "same line\nsame line\n \nsame line", "a b c d a b c d a", "x\n\n\n", "u v w " * 3000]
    got = rulelist.text_stats(documents(spark, values, extra=True))
    assert "text" not in got.columns and "a.b" in got.columns
    for r in got.select("doc_id", *rulelist.STATS).collect():
        if r.doc_id is not None:
            assert tuple(r)[1:] == stats(values[r.doc_id]), values[r.doc_id][:80]


def labelled(n=600):
    """Bad documents carry many symbols, or short words in short texts."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        bad = i % 3 == 0
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 10**6)) for _ in range(rng.randint(60, 200))]
        if bad:
            words = [w + "#*$" for w in words]
        rows.append((i, " ".join(words), None, None, None))
    return rows, [(i, int(i % 3 > 0), 0) for i in range(n)]


def test_learned_list_separates(spark):
    rows, labels = labelled()
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    out = rulelist.judge_quality(docs, known).collect()
    assert all(r.kept == (r.doc_id % 3 > 0) for r in out) and not any(r.base_failed for r in out)


def test_rules_are_ordered_conditions(spark):
    rows, labels = labelled(300)
    stats_ = rulelist.text_stats(spark.createDataFrame(rows, DOCS))
    known = stats_.join(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id")
    rules = rulelist.learn_rules(known)
    assert rules and all(1 <= len(r) <= rulelist.MAX_CONDITIONS for r in rules)
    caught = [r.quality for r in known.filter(rulelist.verdict(rules) == "reject").select("quality").collect()]
    assert set(caught) == {0} and len(caught) >= 95


def test_base_rule_and_missing_labels(spark):
    values = ["a b c " * 30, " ".join(str(i) for i in range(49)), " ".join(str(i) for i in range(50)), None, ""]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(values)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    void = spark.createDataFrame([(None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    for known in (none, void):
        out = {r.doc_id: (r.base_failed, r.kept) for r in rulelist.judge_quality(docs, known).collect()}
        assert out == {0: (True, False), 1: (True, False), 2: (False, True), 3: (True, False), 4: (True, False)}
    assert rulelist.judge_quality(docs.limit(0), none).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", None, None, None)], DOCS)
    plan = rulelist.text_stats(docs).select(F.sum("n_repeat_words"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
