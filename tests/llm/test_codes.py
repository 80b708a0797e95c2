"""Vector codes against plain clustering of all parts, and the metric trees against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from folioflow.llm import codes

ROWS = "vec_id long, embedding array<double>, label int, code string, vec string"


def vectors(n=400, dims=32, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dims)).round(3)
    x[10:60] = x[10]  # copies
    return [(i, v.tolist(), i % 3 or None, "x", "y") for i, v in enumerate(x)]


AWKWARD = [
    (900, None, 1, "x", "y"),
    (901, [0.1] * 31 + [math.nan], 1, "x", "y"),
    (902, [0.1] * 31 + [None], 1, "x", "y"),
    (903, [math.inf] * 32, None, None, None),
    (904, [], 1, None, None),
    (905, [0.5, -0.5], None, None, None),
    (None, [0.25] * 32, 2, None, None),
    (5, [0.75] * 32, 2, None, None),
]


def plain(rows, parts, entries, rounds, scale):
    """The same by comparing every part with every entry."""
    kept = [(i, v, label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v, _ in kept), default=0)
    width = -(-dims // parts)
    whole = [([math.floor(scale * x) for x in v] + [0] * (parts * width))[: parts * width] for _, v, _ in kept]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, whole[k]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, v: min(range(len(books[p])), key=lambda e: (distance(v, books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for v in cut:
                own.setdefault(near(p, v[p]), []).append(v[p])
            for e, members in own.items():
                books[p][e] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = [[near(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(distance(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(cut, coded, strict=True)]
    total = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        total[label] = total.get(label, 0) + e
    out = [(i, "".join(f"{e:02x}" for e in c), err, total[label], digest) for (i, _, label), c, err in zip(kept, coded, errors, strict=True)]
    return sorted(out, key=str)


def coded(spark, rows, **more):
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    got = codes.compress_vectors(frame, **more).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize(
    "rows, more",
    [
        (vectors() + AWKWARD, {"parts": 8, "entries": 20, "chunk": 100}),
        (vectors(60, 10) + AWKWARD[:1], {"parts": 4, "entries": 64}),  # 10 / 4: the last part is filled up
        (vectors(30, 8) * 3, {"parts": 2, "entries": 16, "chunk": 7}),  # repeated rows
        ([(i, [], 1, "x", "y") for i in range(3)], {"parts": 4, "entries": 2}),
        (AWKWARD[:4], {}),
    ],
    ids=["awkward", "uneven", "repeated", "no components", "no usable row"],
)
def test_codes_equal_plain_clustering(spark, rows, more):
    full = {"parts": codes.PARTS, "entries": codes.ENTRIES, **{k: v for k, v in more.items() if k != "chunk"}}
    assert coded(spark, rows, **more) == plain(rows, full["parts"], full["entries"], codes.ROUNDS, codes.SCALE)


def test_empty_table(spark):
    assert coded(spark, []) == []


@pytest.mark.parametrize("spread", [3, 300, 2**26])
def test_trees_hold_all_points_and_assign_exactly(spread):
    rng = np.random.default_rng(spread)
    points = rng.integers(-spread, spread, (700, 4))
    points[:80] = points[0]
    tree = codes.Tree.build(points)
    assert sorted(tree.place.tolist()) == list(range(700))
    assert (tree.points == points[tree.place]).all()
    for (left, right, i, j), total, radius in zip(tree.nodes.tolist(), tree.sums, tree.radius, strict=True):
        own = tree.points[i:j]
        assert (own.sum(0) == total).all()
        assert np.sqrt(((own - total / len(own)) ** 2).sum(1)).max() <= radius * (1 + 1e-9) + 1e-9
        if left >= 0:
            assert (tree.nodes[left, 2], tree.nodes[left, 3], tree.nodes[right, 2], tree.nodes[right, 3]) == (i, tree.nodes[left, 3], tree.nodes[left, 3], j)
    book = np.concatenate((points[100:140], points[100:110]))  # entries that occur twice: the first owns
    owner, sums, counts = tree.assign(book)
    want = ((tree.points[:, None] - book[None]) ** 2).sum(-1).argmin(1)
    assert (owner == want).all()
    assert (counts == np.bincount(want, minlength=50)).all()
    assert all((sums[e] == tree.points[want == e].sum(0)).all() for e in range(50))


def test_balls_are_wholly_owned_without_looking_at_their_points():
    """Far apart groups: every ball below a group goes to one entry, no leaf is opened."""
    rng = np.random.default_rng(4)
    groups = rng.integers(-100_000, 100_000, (8, 4))
    points = np.concatenate([g + rng.integers(-5, 6, (200, 4)) for g in groups])
    tree = codes.Tree.build(points)
    tree.points = np.zeros_like(tree.points)  # a look at a point would give the wrong entry
    owner, _, counts = tree.assign(groups)
    assert counts.tolist() == [200] * 8
    assert (owner == np.repeat(np.arange(8), 200)[tree.place]).all()


def test_stolen_points_are_nearest_to_their_anchor():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 3))
    owner = codes.anchors(x, 20)
    pivots = [int(np.flatnonzero(owner == a)[0]) for a in range(20)]
    assert len(set(pivots)) == 20 == owner.max() + 1
    assert (codes.anchors(np.zeros((9, 2)), 3) == 0).all()
