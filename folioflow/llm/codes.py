"""Vector code compression: codebooks per part, fitted over metric trees of the parts.

A vector of whole numbers is cut into ``parts`` equal parts, each with a codebook of its own.
Rows are taken in chunks of ``CHUNK``; for each chunk and part a metric tree is built once by
the anchors hierarchy, middle out: about the square root of n anchors, each new one the point
farthest from its anchor, steal the points nearer to them (points within half the distance
between two anchors are not looked at); anchors are merged bottom-up by the smallest ball
around a pair, and each is divided in the same way below. A ball caches the sum and number of
its points, its centre and its radius. Trees are a written table, one row per chunk and part.

A round walks all balls of a level at once with the list of entries their parents left: an
entry goes when the ball lies wholly on the near side of the plane between it and the entry
nearest to the centre. A ball with one entry left is wholly owned: its cached sum and number
count for that entry. Only points of leaves that several entries may own are compared one by
one, in whole numbers, ties to the lower index. Tasks send one row per part and entry.

The broadcast codebooks hold ``entries`` whole numbers per component whatever the input; the
first ones come from rows below a bound on ``vec_id`` that one pass finds.

Defined results: a null vector and one with null or non-finite components has no row; shorter
vectors count as filled up with zeros, as does a length that ``parts`` does not divide; a null
``vec_id`` comes after all others where codebooks begin, equal ids in the order of their
vectors; with fewer rows than ``entries`` a codebook is as short; repeated rows count as often
as they occur; null labels are one label; a sum of errors beyond 64 bits is null; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import ship
from folioflow.llm.vectors import matrix, whole_numbers
from folioflow.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
CHUNK, LEAF = 2048, 16
SLACK = 1e-9
TREE = "chunk long, part int, points binary, place binary, nodes binary, sums binary, radius binary"


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(-1))


def anchors(x: np.ndarray, most: int) -> np.ndarray:
    """The anchor (0, 1, ...) that owns each point; ``most`` anchors, fewer if no two points differ any more."""
    owner, dist = np.zeros(len(x), np.int64), _norms(x - x[0])
    pivots = [0]
    while len(pivots) < most:
        new = int(dist.argmax())  # the farthest point of the anchor with the largest radius
        if dist[new] == 0:
            break
        apart = _norms(x[pivots] - x[new])
        open_ = np.flatnonzero(dist >= apart[owner] / 2)
        to_new = _norms(x[open_] - x[new])
        moved = to_new < dist[open_]
        owner[open_[moved]], dist[open_[moved]] = len(pivots), to_new[moved]
        pivots.append(new)
    return owner


class Tree:
    """A metric tree over the parts ``points`` (whole numbers); ``place`` is each point's row in its chunk.

    Balls are numbered from the root, 0; ``nodes`` holds left child, right child (-1: leaf), first and
    last point; the points of a ball stand together.
    """

    def __init__(self, points, place, nodes, sums, radius) -> None:
        self.points, self.place, self.nodes, self.sums, self.radius = points, place, nodes, sums, radius
        self.n = nodes[:, 3] - nodes[:, 2]

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> Tree:
        x = points.astype(np.float64)
        children: list[tuple[int, int]] = []
        held: list[np.ndarray | None] = []
        balls: list[tuple[np.ndarray, float, int]] = []  # centre, radius around it, points: for merging only

        def ball(idx, left, right, centre, radius, n) -> int:
            held.append(idx)
            children.append((left, right))
            balls.append((centre, radius, n))
            return len(children) - 1

        def grow(idx: np.ndarray) -> int:
            own = x[idx]
            owner = anchors(own, int(np.ceil(np.sqrt(len(idx))))) if len(idx) > leaf else np.zeros(len(idx), np.int64)
            if not owner.any():
                centre = own.mean(0)
                return ball(idx, -1, -1, centre, float(_norms(own - centre).max(initial=0)), len(idx))
            order = np.argsort(owner, kind="stable")
            return merge([grow(part) for part in np.split(idx[order], np.flatnonzero(np.diff(owner[order])) + 1)])

        def merge(tops: list[int]) -> int:
            c = np.stack([balls[t][0] for t in tops])
            r = np.array([balls[t][1] for t in tops])

            def around(i: int) -> np.ndarray:
                out = np.maximum(np.maximum((_norms(c - c[i]) + r + r[i]) / 2, r), r[i])
                out[i] = np.inf
                return out

            size = np.stack([around(i) for i in range(len(tops))])
            for _ in range(len(tops) - 1):
                i, j = divmod(int(size.argmin()), len(tops))
                (ci, ri, ni), (cj, rj, nj) = balls[tops[i]], balls[tops[j]]
                centre = (ci * ni + cj * nj) / (ni + nj)
                radius = max(_norms(centre - ci) + ri, _norms(centre - cj) + rj)
                tops[i] = ball(None, tops[i], tops[j], centre, float(radius), ni + nj)
                c[i], r[i] = centre, radius
                gone = np.isinf(size[i])
                gone[j] = True
                row = around(i)
                row[gone] = np.inf
                size[i], size[:, i] = row, row
                size[j], size[:, j] = np.inf, np.inf
            return len(children) - 1

        root = grow(np.arange(len(x))) if len(x) else ball(np.zeros(0, np.int64), -1, -1, np.zeros(x.shape[1]), 0.0, 0)
        # Number balls from the root and lay their points out side by side, leaf by leaf.
        number, order, at = {}, [], 0
        nodes = np.zeros((len(children), 4), np.int32)
        stack, path = [root], []
        while stack:
            t = stack.pop()
            number[t] = len(number)
            path.append(t)
            left, right = children[t]
            if left < 0:
                order.append(held[t])
                nodes[number[t], 2:] = at, at + len(held[t])
                at += len(held[t])
            else:
                stack += [right, left]
        for t in reversed(path):
            left, right = children[t]
            nodes[number[t], :2] = (-1, -1) if left < 0 else (number[left], number[right])
            if left >= 0:
                nodes[number[t], 2:] = nodes[number[left], 2], nodes[number[right], 3]
        place = np.concatenate(order).astype(np.int32)
        laid = points[place]
        running = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(laid, 0)))
        sums = running[nodes[:, 3]] - running[nodes[:, 2]]
        centre = sums / np.maximum(nodes[:, 3] - nodes[:, 2], 1)[:, None]
        radius = np.array([_norms(laid[a:b] - centre[i]).max(initial=0) for i, (a, b) in enumerate(nodes[:, 2:].tolist())])
        return cls(laid, place, nodes, sums, radius)

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry of each point, and the sum and number of points of each entry."""
        k, width = book.shape
        owner = np.zeros(len(self.points), np.int64)
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        entries = book.astype(np.float64)
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(-1))
        first = np.array([not (book[:i] == book[i]).all(1).any() for i in range(k)])
        scale = 1 + (entries**2).sum(1).max(initial=0) + (self.points.astype(np.float64) ** 2).sum(1).max(initial=0)
        at, lists = np.zeros(1, np.int64), first[None]  # an entry equal to an earlier one owns nothing
        open_leaves, open_lists = [], []
        while len(at):
            centre = self.sums[at] / np.maximum(self.n[at], 1)[:, None]
            d = np.where(lists, ((centre[:, None] - entries[None]) ** 2).sum(-1), np.inf)
            best = d.argmin(1)
            near = d[np.arange(len(at)), best][:, None]
            lists = lists & (d - near <= 2 * apart[best] * self.radius[at][:, None] + SLACK * scale)
            whole = lists.sum(1) == 1
            np.add.at(sums, best[whole], self.sums[at[whole]])
            np.add.at(counts, best[whole], self.n[at[whole]])
            for b, (i, j) in zip(best[whole].tolist(), self.nodes[at[whole], 2:].tolist(), strict=True):
                owner[i:j] = b
            is_leaf = self.nodes[at, 0] < 0
            open_leaves.append(at[~whole & is_leaf])
            open_lists.append(lists[~whole & is_leaf])
            down = ~whole & ~is_leaf
            at, lists = self.nodes[at[down], :2].astype(np.int64).ravel(), np.repeat(lists[down], 2, 0)
        leaves, lists = np.concatenate(open_leaves), np.concatenate(open_lists)
        n = self.n[leaves]
        which = np.repeat(np.arange(len(leaves)), n)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.nodes[leaves, 2][which]
        for i in range(0, len(rows), 4096):
            some = rows[i : i + 4096]
            x = self.points[some].astype(np.int64)
            d = np.zeros((len(some), k), np.int64)
            for m in range(width):
                d += (x[:, m, None] - book[None, :, m]) ** 2
            d[~lists[which[i : i + 4096]]] = np.iinfo(np.int64).max
            best = d.argmin(1)
            owner[some] = best
            np.add.at(sums, best, x)
            counts += np.bincount(best, minlength=k)
        return owner, sums, counts


def _small(points: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if np.abs(points).max(initial=0) <= np.iinfo(kind).max:
            return points.astype(kind)
    return points


def _stored(chunk: int, part: int, tree: Tree) -> dict:
    return {
        "chunk": chunk,
        "part": part,
        "points": _small(tree.points).tobytes(),
        "place": tree.place.tobytes(),
        "nodes": tree.nodes.tobytes(),
        "sums": tree.sums.tobytes(),
        "radius": tree.radius.tobytes(),
    }


def _loaded(row: dict, width: int) -> Tree:
    place = np.frombuffer(row["place"], np.int32)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}.get(len(row["points"]) // max(1, len(place) * width), np.int64)
    points = np.frombuffer(row["points"], kind).reshape(len(place), width)
    nodes = np.frombuffer(row["nodes"], np.int32).reshape(-1, 4)
    sums = np.frombuffer(row["sums"], np.int64).reshape(len(nodes), width)
    return Tree(points, place, nodes, sums, np.frombuffer(row["radius"]))


def plant(rows: DataFrame, dims: int, parts: int, width: int, chunk: int = CHUNK) -> DataFrame:
    """Trees of all chunks and parts; part 0 also carries the ids and labels of the chunk's rows."""
    kinds = dict(rows.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 33
        waiting: list[pa.RecordBatch] = []

        def out(table: pa.Table, chunk_id: int) -> pa.RecordBatch:
            x = np.zeros((len(table), parts * width), np.int64)
            x[:, :dims] = matrix(table.column("vec"), dims)
            trees = [_stored(chunk_id, p, Tree.build(x[:, p * width : (p + 1) * width])) for p in range(parts)]
            own = [[table.column(c).to_pylist()] + [None] * (parts - 1) for c in ("vec_id", "label")]
            made = pa.RecordBatch.from_pylist(trees, pa.schema([(c, _ARROW.get(c, pa.binary())) for c in _NAMES]))
            lists = [pa.array(v, pa.list_(table.schema.field(c).type)) for v, c in zip(own, ("vec_id", "label"), strict=True)]
            return pa.RecordBatch.from_arrays([*made.columns, *lists], [*_NAMES, "vec_ids", "labels"])

        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= chunk:
                table = pa.Table.from_batches(waiting)
                yield out(table.slice(0, chunk), serial)
                serial += 1
                waiting = table.slice(chunk).to_batches()
        if sum(b.num_rows for b in waiting):
            yield out(pa.Table.from_batches(waiting), serial)

    return rows.mapInArrow(run, f"{TREE}, vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>")


_NAMES = [c.split()[0] for c in TREE.split(", ")]
_ARROW = {"chunk": pa.int64(), "part": pa.int32()}


def first_books(rows: DataFrame, dims: int, parts: int, width: int, entries: int) -> np.ndarray:
    """``[part, entry, position]``: the parts of the ``entries`` smallest rows by id."""
    # Ids first: what one task gathers is a number per task and entry; then the few rows up to the last one.
    least = cut_lineage(rows.select("vec_id").orderBy(F.asc_nulls_last("vec_id")).limit(entries))
    top, n, ids = least.agg(F.max("vec_id"), F.count("*"), F.count("vec_id")).first()
    some = rows if ids < n or n < entries else rows.filter(F.col("vec_id") <= top)
    found = cut_lineage(some.select("vec_id", "vec").orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries))
    found = found.orderBy(F.asc_nulls_last("vec_id"), "vec").toArrow()
    x = np.zeros((len(found), parts * width), np.int64)
    x[:, :dims] = matrix(found.column("vec"), dims)
    return np.ascontiguousarray(x.reshape(len(found), parts, width).transpose(1, 0, 2))


def refit(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of its points' mean; unused entries stay."""
    parts, k, width = books.shape
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                _, s, c = _loaded(row, width).assign(shared.value[row["part"]])
                sums[row["part"]] += s
                counts[row["part"]] += c
        p, e = np.nonzero(counts)
        held = np.concatenate((counts[p, e][:, None], sums[p, e]), 1)
        flat = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * (width + 1), held.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), flat], ["part", "entry", "held"])

    partial = trees.select(*_NAMES).mapInArrow(run, "part int, entry int, held array<long>")
    added = [F.sum(F.get("held", F.lit(i))).alias(f"s{i}") for i in range(width + 1)]
    new = books.copy()
    for p, e, n, *sums in partial.groupBy("part", "entry").agg(*added).collect():  # a row per entry at most
        new[p, e] = [s // n for s in sums]
    shared.destroy()
    return new


def encode(trees: DataFrame, books: np.ndarray, labels: str) -> DataFrame:
    """``vec_id, label, code, error`` of every row, by a last assignment."""
    parts, _, width = books.shape
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for row in batch.select(_NAMES).to_pylist():
                tree, book = _loaded(row, width), shared.value[row["part"]]
                owner, _, _ = tree.assign(book)
                code, error = np.zeros(len(owner), np.uint8), np.zeros(len(owner), np.int64)
                code[tree.place] = owner
                error[tree.place] = ((tree.points.astype(np.int64) - book[owner]) ** 2).sum(1)
                codes.append(code.tobytes())
                errors.append(error.tobytes())
            columns = [batch.column("chunk"), batch.column("part"), pa.array(codes, pa.binary()), pa.array(errors, pa.binary())]
            columns += [batch.column("vec_ids"), batch.column("labels")]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "part", "codes", "errors", "vec_ids", "labels"])

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        codes = np.stack([np.frombuffer(c, np.uint8) for c in table.column("codes").to_pylist()], 1)
        errors = sum(np.frombuffer(e, np.int64) for e in table.column("errors").to_pylist())
        ids, names = (table.column(c).combine_chunks()[0].values for c in ("vec_ids", "labels"))
        text = codes.tobytes().hex()
        size = 2 * parts
        return pa.table(
            {
                "vec_id": ids,
                "label": names,
                "code": pa.array([text[i : i + size] for i in range(0, len(text), size)], pa.string()),
                "error": pa.array(errors, pa.int64()),
            }
        )

    kinds = dict(trees.dtypes)
    ids = kinds["vec_ids"][6:-1]
    schema = f"chunk long, part int, codes binary, errors binary, vec_ids {kinds['vec_ids']}, labels {kinds['labels']}"
    return trees.mapInArrow(run, schema).groupBy("chunk").applyInArrow(joined, f"vec_id {ids}, label {labels}, code string, error long")


def compress_vectors(
    table: DataFrame,
    vec: str = "embedding",
    label: str = "label",
    vec_id: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    chunk: int = CHUNK,
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every usable row.

    ``entries`` is 256 at most: a code is two hexadecimal digits per part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries has to be 1 to 256")
    ship(table)
    slim = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vec).alias("vec"))
    rows, dims = whole_numbers(slim, "vec", scale)
    width = -(-dims // parts)
    books = first_books(rows, dims, parts, width, entries)
    trees = cut_lineage(plant(rows, dims, parts, width, chunk))
    for _ in range(rounds):
        books = refit(trees, books)
    coded = cut_lineage(encode(trees, books, dict(slim.dtypes)["label"]))
    sums = cut_lineage(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    return out.withColumn("codebooks_sha256", F.lit(digest))
