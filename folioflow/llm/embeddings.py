"""Embedding near-duplicates by product quantisation, exact in its links.

Equal vectors of a label are one class. A coarse quantiser (k-means on a bounded sample)
assigns every class to an inverted list; what is left of the vector after its list's
centre is coded by product quantisation. A class searches its own list and every list whose
border with its own is not farther than the radius, since a vector beyond that border can
be no link. Inside a list, a table lookup per subspace gives the distance to each code;
a code is dropped only if that distance exceeds the radius by more than the code's own
error, so no link is lost; the rest is ranked by exact cosine in double precision.

Lists are cut into blocks of ``BLOCK`` classes, searched apart, whatever their number. Blocks
return link counts and a spanning forest of their links, not all pairs.

Defined results: a vector that is null, zero, empty or holds null or non-finite numbers, and
a vector with a null label, links with nothing and is its own component; vectors of
different lengths never link; repeated rows are copies; a null id is never a component
id unless all ids of the component are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import components, hash_sample, ship
from folioflow.session import cut_lineage

LEAST = 0.98
SAMPLE, LISTS, SUBSPACES, CODES, ROUNDS = 20_000, 1024, 8, 64, 12
LIST_ROWS, BLOCK, CHUNK = 512, 4096, 512
SLACK = 1e-6


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


def kmeans(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


class Quantiser:
    """Coarse centres and residual codebooks for vectors of one length."""

    def __init__(self, x: np.ndarray, lists: int) -> None:
        self.centres = kmeans(x, lists)
        self.dim = x.shape[1]
        self.width = -(-self.dim // SUBSPACES)
        rest = self._split(x - self.centres[_squares(x, self.centres).argmin(1)])
        self.books = [kmeans(rest[:, m], CODES, m) for m in range(SUBSPACES)]

    def _split(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), SUBSPACES * self.width))
        out[:, : self.dim] = x
        return out.reshape(len(x), SUBSPACES, self.width)

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and the exact distance of each vector to what its code stands for."""
        rest = self._split(x - self.centres[own])
        codes = np.stack([_squares(rest[:, m], b).argmin(1) for m, b in enumerate(self.books)], 1)
        gone = np.stack([rest[:, m] - b[codes[:, m]] for m, b in enumerate(self.books)], 1)
        return codes.astype(np.uint8), np.sqrt((gone**2).sum((1, 2)))

    def lookup(self, x: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of ``x`` to coded vectors of one list, summed from tables."""
        rest = self._split(x - self.centres[centre])
        total = np.zeros((len(x), len(codes)))
        for m, book in enumerate(self.books):
            total += _squares(rest[:, m], book)[:, codes[:, m]]
        return np.sqrt(total)

    def probes(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Own list, and a mask of all lists that can hold a vector within ``radius``."""
        d = _squares(x, self.centres)
        own = d.argmin(1)
        apart = np.sqrt(_squares(self.centres[own], self.centres))
        # Distance from x to the plane halfway between its own centre and another one.
        plane = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * apart, 1e-12)
        mask = plane <= radius + SLACK
        mask[np.arange(len(x)), own] = True
        return own, mask


def _vectors(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.asarray(v, np.float64) for v in column.to_pylist()]


def vector_classes(table: DataFrame, vec: str, label: str, vec_id: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the keys of their class, and valid classes: ``cid, label, vec, dim, least, m``."""
    v = F.col(vec)
    good = v.isNotNull() & F.col(label).isNotNull() & (F.size(v) > 0)
    # Bounded in both directions: the squares of such numbers neither overflow nor vanish as doubles.
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(good & fine & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = table.select(
        F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), v.cast("array<double>").alias("vec"), good.alias("good")
    )
    rows = rows.withColumns({"k1": F.xxhash64("label", "vec"), "k2": F.xxhash64(F.lit(7), "vec", "label")})
    own = rows.filter("good").groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.min("vec_id").alias("least"), F.count("*").alias("m")
    )
    own = cut_lineage(own.withColumn("dim", F.size("vec")).withColumn("cid", F.monotonically_increasing_id()))
    return rows.select("vec_id", "good", "k1", "k2"), own


def train(own: DataFrame, sample: int = SAMPLE, list_rows: int = LIST_ROWS) -> dict[int, Quantiser]:
    """A quantiser for each vector length of the sample (at most ``sample`` classes, by hash)."""
    n, labels = own.agg(F.count("*"), F.approx_count_distinct("label")).first()
    lists = int(min(LISTS, max(1, round(n / max(1, labels) / list_rows))))
    some = hash_sample(own, F.xxhash64("k1"), n, sample, "cid").select("dim", "vec").toArrow()
    dims = some.column("dim").to_numpy()
    vectors = _vectors(some.column("vec"))
    return {
        int(d): Quantiser(unit(np.stack([v for v, x in zip(vectors, dims, strict=True) if x == d])), lists) for d in np.unique(dims)
    }


def link_classes(own: DataFrame, models: dict[int, Quantiser], least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """``(a, b, n)``: for each class the number ``n`` of linked rows (b null), and forest edges a-b (n 0)."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
    spark = own.sparkSession
    shared = spark.sparkContext.broadcast(models)

    def model_of(dim: int) -> Quantiser:
        # A length that the sample has not seen is searched whole: one list, codes without use.
        return shared.value.get(dim) or Quantiser(np.zeros((1, dim)), 1)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vectors = batch.column("dim").to_numpy(), _vectors(batch.column("vec"))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit(np.stack([vectors[i] for i in at]))
                model = model_of(int(d))
                home, mask = model.probes(x, radius)
                codes, error = model.encode(x, home)
                lists = [np.flatnonzero(row).astype(np.int32) for row in mask]
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(c) for c in ("cid", "label", "dim", "vec", "m")),
                        pa.array(home.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error),
                        pa.array(lists, pa.list_(pa.int32())),
                    ],
                    ["cid", "label", "dim", "vec", "m", "home", "code", "error", "lists"],
                )

    schema = "cid long, label string, dim int, vec array<double>, m long, home int, code binary, error double, lists array<int>"
    coded = cut_lineage(own.select("cid", "label", "dim", "vec", "m").mapInArrow(assign, schema))
    cell = ["label", "dim", "list"]
    sizes = coded.groupBy("label", "dim", F.col("home").alias("list")).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = cut_lineage(sizes)
    index = coded.withColumn("list", F.col("home")).join(sizes, cell)
    index = index.withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    probes = coded.withColumn("list", F.explode("lists")).join(sizes, cell)
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A list that very many classes search is searched by parts of them as well.
    names = [*cell, "block", "cid", "vec", "m", "code", "error"]
    parts = F.greatest(F.lit(1), F.ceil(F.col("asked") / (4 * block))).cast("int")
    asked = cut_lineage(probes.groupBy(*cell, "block").agg(F.count("*").alias("asked")).select(*cell, "block", parts.alias("parts")))
    index = index.select(*names, F.lit(True).alias("stored")).join(asked, [*cell, "block"])
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    probes = probes.select(*names, F.lit(False).alias("stored")).join(asked, [*cell, "block"])
    probes = probes.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "cid"), "parts").cast("int"))

    def search(table: pa.Table) -> pa.Table:
        stored = table.column("stored").to_numpy(zero_copy_only=False)
        empty = {"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())}
        if not stored.any() or stored.all():
            return pa.table(empty)
        model = model_of(table.column("dim")[0].as_py())
        ids, m = table.column("cid").to_numpy(), table.column("m").to_numpy()
        x = unit(np.stack(_vectors(table.column("vec"))))
        codes = np.frombuffer(b"".join(table.filter(pa.array(stored)).column("code").to_pylist()), np.uint8).reshape(-1, SUBSPACES)
        bound = radius + table.column("error").to_numpy()[stored] + SLACK
        y, y_ids, y_m, centre = x[stored], ids[stored], m[stored], table.column("list")[0].as_py()
        asking = np.flatnonzero(~stored)
        a, b, counts = [], [], []
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for i in range(0, len(asking), CHUNK):
            at = asking[i : i + CHUNK]
            p, q = np.nonzero(model.lookup(x[at], centre, codes) <= bound)
            cosine = np.einsum("ij,ij->i", x[at][p], y[q])
            hit = (cosine >= least) & (ids[at][p] != y_ids[q])
            p, q = p[hit], q[hit]
            linked = np.bincount(p, y_m[q], len(at)).astype(np.int64)
            for k in np.flatnonzero(linked):
                counts.append((int(ids[at][k]), int(linked[k])))
            for s, t in zip(ids[at][p].tolist(), y_ids[q].tolist(), strict=True):
                s, t = root(s), root(t)
                if s != t:
                    parent[max(s, t)] = min(s, t)
        for v in parent:
            if (r := root(v)) != v:
                a.append(v)
                b.append(r)
        return pa.table(
            {
                "a": pa.array(a + [c for c, _ in counts], pa.int64()),
                "b": pa.array(b + [None] * len(counts), pa.int64()),
                "n": pa.array([0] * len(a) + [n for _, n in counts], pa.int64()),
            }
        )

    columns = [*names, "stored", "part"]
    both = index.select(*columns).unionByName(probes.select(*columns))
    return both.groupBy(*cell, "block", "part").applyInArrow(search, "a long, b long, n long")


def near_vectors(
    table: DataFrame, vec: str = "embedding", label: str = "label", vec_id: str = "vec_id", least: float = LEAST
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    ship(table)
    rows, own = vector_classes(table, vec, label, vec_id)
    found = cut_lineage(link_classes(own, train(own), least))
    roots = components(found.filter("b is not null").select("a", "b"))
    more = found.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("more"))
    placed = own.select("k1", "k2", "cid", "least", "m").join(more, "cid", "left")
    placed = placed.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    placed = placed.withColumn("root", F.coalesce("root", "cid"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component"))
    placed = placed.join(smallest, "root").select(
        "k1", "k2", (F.col("m") - 1 + F.coalesce("more", F.lit(0))).alias("links"), "component", F.lit(True).alias("good")
    )
    out = rows.join(placed, ["k1", "k2", "good"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
