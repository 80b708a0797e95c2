"""The burst trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioflow.llm import tries
from folioflow.llm.queries import op13_prefix_trie

TURNS = "conv_id long, turn long, role string, text string, n_convs string, pos string, ids string"


def rebuilt(rows, graft):
    convs = defaultdict(list)
    known = [(c, t, r or "", x or "") for c, t, r, x, *_ in rows if c is not None]
    for c, _, r, x in sorted(known, key=lambda v: (v[0], v[1] is not None, v[1] or 0)):
        convs[c].append((r, x))
    if not graft:
        return convs
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # as in SQL, also below zero
        out[c] = convs.get(base, [])[:h] + convs[c][h:]
    return out


def plain(convs):
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += not kids[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=3, n=60):
    rng, rows = random.Random(seed), []
    for c in range(n):
        kind = rng.choice("abc")
        for t in range(rng.choice([1, 2, 3, 5, 9, 17, 17, 33, 40])):
            text = {"a": "same", "b": f"ü{t}", "c": f"{rng.randint(0, 2)}"}[kind]
            rows.append((c, t, "user" if t % 2 else None, text if rng.random() > 0.03 else None, None, "x", "y"))
    rows += [(None, 1, "a", "b", None, None, None), (7, None, "q", "z", None, None, None), (-3, 4, None, None, None, None, None)]
    rows += [rows[2], rows[2]]
    rows += [(1000, t, "u", "same" if t < 20 else f"{t}", None, None, None) for t in range(130)]
    return rows


LIMITS = [
    {},
    {"most_turns": 30, "most_rows": 4},
    {"segment": 4, "most_turns": 1000, "most_rows": 1000},
    {"segment": 8, "most_turns": 20, "most_rows": 6},
]


@pytest.mark.parametrize("limits", LIMITS, ids=["one container", "bursts", "segments", "both"])
def test_nodes_equal_all_prefixes(spark, limits):
    rows = conversations()
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    got = tries.prefix_trie(*tries.turn_ids(frame), **limits)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rebuilt(rows, False))


def test_query_with_copies_and_pieces(spark, tmp_path, monkeypatch):
    """The registered query; most conversations are copies, so that lists of ends come in several pieces."""
    monkeypatch.setattr(tries, "PIECE", 40)
    monkeypatch.setattr(tries, "LEAST_ROWS", 10)
    monkeypatch.setattr(tries, "LEAST_TURNS", 40)
    rows = conversations(5, 40)
    rows += [(2000 + 5 * i, t, "user", f"copy {t}", None, None, None) for i in range(300) for t in range(3)]
    rows += [(3501 + 5 * i, t, "user", f"copy {t}", None, None, None) for i in range(50) for t in range(2)]  # bases are absent
    spark.createDataFrame(rows, TURNS).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op13_prefix_trie(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rebuilt(rows, True))


def test_conversation_without_turns(spark):
    """A conversation of one turn whose base is absent and whose first turns are replaced has none left."""
    rows = [(c, 0, "user", "hello", None, None, None) for c in range(1, 5)]
    frame = spark.createDataFrame(rows, TURNS)
    take = F.lit(3).cast("long")
    turns, convs = tries.graft(*tries.turn_ids(frame), F.col("conv") - F.col("conv") % 5, take, 8)
    digest = hashlib.sha256(b"1,2,3,4").hexdigest()
    assert list(map(tuple, tries.prefix_trie(turns, convs).collect())) == [(1, 0, None, 4, 0, 1, 0, digest)]


def test_empty_table(spark):
    frame = spark.createDataFrame([], TURNS)
    assert tries.conversation_trie(frame).collect() == []
    assert tries.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", None, None, None)], TURNS)).columns == tries.COLUMNS
