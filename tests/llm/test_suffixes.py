"""Removed bytes against a set of all 50-byte strings, and the parts of the merge sort."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from llm.helpers import DOCS, documents, texts

from folioflow.llm import suffixes


def brute(rows):
    """Removed flags by row from ``(id, text)``; equal ids do not cut each other."""
    first: dict[bytes, int] = {}
    cut = [[(t or "").encode()[k : k + 50] for k in range(len((t or "").encode()) - 49)] for _, t in rows]
    for (i, _), windows in zip(rows, cut, strict=True):
        for w in windows if i is not None else ():
            first[w] = min(i, first.get(w, i))
    out = []
    for (i, t), windows in zip(rows, cut, strict=True):
        gone = np.zeros(len((t or "").encode()), bool)
        for k, w in enumerate(windows):
            if i is not None and first[w] < i:
                gone[k : k + 50] = True
        out.append(gone)
    return out


def check(spark, docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = defaultdict(list)
    for (i, t), gone in zip(rows, brute(rows), strict=True):
        data = (t or "").encode()
        want[i].append((len(data), np.frombuffer(data, np.uint8)[~gone].tobytes(), int((np.diff(np.concatenate(([0], gone))) == 1).sum())))
    got = defaultdict(list)
    for r in suffixes.remove_repeats(docs, **options).collect():
        got[r.doc_id].append((r.n_bytes, bytes(r.kept), len(r.removed)))
        assert sum(s.end - s.start for s in r.removed) == r.n_bytes - len(r.kept)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return sum(len(k[1]) != k[0] for v in want.values() for k in v)


def passages(seed=1):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (49, 50, 51, 60, 90, 200, 800)]
    values = []
    for _ in range(60):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 70))) for _ in range(4)]
        parts.insert(rng.randint(0, 4), rng.choice(shared))
        piece = rng.choice(shared)
        parts.insert(rng.randint(0, 4), piece[rng.randint(0, 20) : len(piece) - rng.randint(0, 20)])
        values.append("".join(parts))
    return values + ["aaaa" * 100, "aaaa" * 50, "ab" * 60, "ba" * 80]


@pytest.mark.parametrize("options", [{}, {"hot_rows": 2}, {"bits": 1 << 14}])
def test_removed_bytes(spark, options):
    options = {"bits": 1 << 20, **options}
    assert check(spark, documents(spark, passages(), extra=True), **options) > 20


def test_many_runs(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 700)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 1500)
    values = [t for t in texts(3, 30) if t is None or len(t) < 3000]
    assert check(spark, documents(spark, passages(2) + values), bits=1 << 20) > 20


def test_empty_and_short(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], DOCS), bits=1 << 16).count() == 0
    docs = spark.createDataFrame([(2, "x" * 49, None, None, None), (1, "x" * 49, None, None, None)], DOCS)
    assert check(spark, docs, bits=1 << 16) == 0


def test_front_coding_round_trip():
    rng = random.Random(1)
    entries = sorted({bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 80))) for _ in range(500)})
    back = list(suffixes.decode(*suffixes.front_code(entries)))
    assert [e for e, _ in back] == entries
    for (a, _), (b, n) in zip(back, back[1:], strict=False):
        assert a[:n] == b[:n] and a[: n + 1] != b[: n + 1]


@pytest.mark.parametrize("n_runs", [1, 2, 3, 7, 16])
def test_loser_tree_merges_and_knows_prefixes(n_runs):
    rng = random.Random(n_runs)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 60))}) for _ in range(n_runs)]
    coded = [suffixes.decode(*suffixes.front_code(r)) if r else iter(()) for r in runs]
    out = list(suffixes.merge_runs(coded))
    assert [e for e, _, _ in out] == sorted(e for r in runs for e in r)
    for (a, _, _), (b, _, known) in zip(out, out[1:], strict=False):
        common = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert known == common


def test_equal_windows_have_equal_anchors():
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcd") for _ in range(400))
    left, right = (bytes(rng.choice(b"xyz") for _ in range(90)) for _ in range(2))
    lengths = np.array([400, 580])
    found = defaultdict(dict)
    data = np.frombuffer(text + left + text + right, np.uint8)
    for s, e, p, _, row in zip(*suffixes.find_entries(data, lengths), strict=True):
        for w in range(s, e + 1):
            found[row][w - (490 if row else 0)] = p - w
    assert all(found[1][w] == found[0][w] for w in range(351))
    assert set(found[0]) == set(range(351)) and set(found[1]) == set(range(-90, 441))
