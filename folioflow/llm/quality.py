"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and so have a few pairs of
features. The tables grow in cycles: in turn, every feature gets a shallow tree fitted to
the current residuals, shrunk and added to its table; then the pairs with the strongest
remaining interaction do. A score is the sum of the table cells a text falls into.

Training takes at most ``MAX_LABELLED`` labelled rows (those with the smallest hashes), as
a few numbers each; scoring covers every whole text.

Defined results: null and empty texts have zero features and get a score like any other;
unlabelled rows train nothing; a doc_id labelled twice counts with its lowest label;
without labels of both kinds every score is 1 (nothing is rejected); repeated rows get equal
scores; extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from folioflow.llm.common import crc_fold, hash_sample, ship
from folioflow.session import cut_lineage

MAX_LABELLED = 20_000
BINS, PAIR_BINS, CYCLES, PAIR_CYCLES, PAIRS, RATE = 32, 8, 40, 20, 6, 0.15
FEATURES = (
    "log_words", "mean_word", "distinct_words", "symbols", "upper", "bars", "marks", "digits", "line_words", "distinct_lines", "stops"
)
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_SYMBOL = np.frombuffer(b"#*$%&<>", np.uint8)


def features(text: str | None) -> list[float]:
    """Shares and means of one text, all zero without a word."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = max(1, len(data) - int(seen[_SPACE].sum()))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)),
        chars / n,
        len(set(words)) / n,
        float(seen[_SYMBOL].sum()) / chars,
        float(seen[65:91].sum()) / chars,
        float(seen[124]) / n,
        float(seen[33]) / n,
        float(seen[48:58].sum()) / chars,
        float(np.log1p(n / len(lines))),
        len(set(lines)) / len(lines),
        float(seen[44] + seen[46]) / n,
    ]


def feature_column(text: str) -> Column:
    @arrow_udf("array<double>")
    def udf(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return udf(F.col(f"`{text}`"))


@dataclass
class Additive:
    """Tables of a fitted model: ``cuts`` by feature, ``tables`` by feature, ``pairs`` of features with theirs."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, f], "left")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.coarse[a], x[:, a], "left"), np.searchsorted(self.coarse[b], x[:, b], "left")]
        return 1 / (1 + np.exp(-total))


def _leaf(g, h):
    return g / (h + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Best cut of the bins ``lo..hi`` and what it gains."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo : hi - 1]), np.cumsum(h[lo : hi - 1])
    gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
    gains = _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs)
    at = int(np.argmax(gains))
    return float(gains[at]), lo + at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values by bin of a tree of depth two."""
    _, mid = _split(g, h, 0, len(g))
    edges = {0, len(g), mid}
    for lo, hi in ((0, mid), (mid, len(g))):
        gain, cut = _split(g, h, lo, hi)
        if gain > 0:
            edges.add(cut)
    out, order = np.zeros(len(g)), sorted(edges)
    for lo, hi in zip(order, order[1:], strict=False):
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a pair's cells into four quadrants: its gain and leaf values."""
    best, out = 0.0, np.zeros(g.shape)
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            quads = []
            for c in (gc, hc):
                a, left, top = c[i, j], c[-1, j], c[i, -1]
                quads.append((a, top - a, left - a, c[-1, -1] - top - left + a))
            gain = sum(_gain(x, y) for x, y in zip(*quads, strict=True)) - _gain(gc[-1, -1], hc[-1, -1])
            if gain > best:
                best, values = gain, [_leaf(x, y) for x, y in zip(*quads, strict=True)]
                out = np.zeros(g.shape)
                out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Additive | None:
    """The model of label 1; None unless both labels occur."""
    positive = int(y.sum())
    if positive in (0, len(y)):
        return None
    grid = lambda n: [np.unique(np.quantile(x[:, f], np.arange(1, n) / n)) for f in range(x.shape[1])]
    cuts, coarse = grid(BINS), grid(PAIR_BINS)
    bins = [np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]
    wide = [np.searchsorted(c, x[:, f], "left") for f, c in enumerate(coarse)]
    base = float(np.log(positive / (len(y) - positive)))
    raw = np.full(len(y), base)
    tables = [np.zeros(len(c) + 1) for c in cuts]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(CYCLES):
        for f, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(*(np.bincount(b, v, len(tables[f])) for v in (g, h)))
            tables[f] += step
            raw += step[b]

    def cells(a: int, b: int, v: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(wide[a] * shape[1] + wide[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    every = [(a, b) for a in range(x.shape[1]) for b in range(a)]
    chosen = sorted(every, key=lambda p: -_cross(cells(*p, g), cells(*p, h))[0])[:PAIRS]
    pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for a, b in chosen]
    for _ in range(PAIR_CYCLES):
        for a, b, table in pairs:
            g, h = slopes()
            step = RATE * _cross(cells(a, b, g), cells(a, b, h))[1]
            table += step
            raw += step[wide[a], wide[b]]
    return Additive(base, cuts, tables, coarse, pairs)


def score_column(column: str | Column, model: Additive | None) -> Column:
    """Scores of a feature array; 1 without a model."""
    if model is None:
        return F.lit(1.0)

    @arrow_udf("double")
    def udf(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(rows.flatten().to_numpy().reshape(len(rows), len(FEATURES))))

    return udf(column)


def train(known: DataFrame, labels: DataFrame, doc_id: str = "doc_id", fold: int | None = 1) -> Additive | None:
    """A model from ``known(doc_id, x)`` and the labels; rows of ``fold`` (of three) are left out.

    The sample is settled on ids alone: at most ``MAX_LABELLED`` of the labelled ids that ``known``
    has, and for an id with several rows its least features.
    """
    own = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_llm_y"))
    own = own.withColumnRenamed("doc_id", "_llm_id")
    if fold is not None:
        own = own.filter(crc_fold("_llm_id", 3) != fold)
    present = known.select(F.col(doc_id).alias("_llm_id")).distinct()
    own = cut_lineage(own.join(present, "_llm_id", "left_semi"))
    picked = hash_sample(own, F.xxhash64("_llm_id"), own.count(), MAX_LABELLED, "_llm_id")
    rows = known.join(F.broadcast(picked), F.col(doc_id) == F.col("_llm_id"))
    some = rows.groupBy("_llm_id", "_llm_y").agg(F.min("x").alias("x")).orderBy("_llm_id").toPandas()
    if some.empty:
        return None
    return fit(np.stack(some["x"].to_numpy()), (some["_llm_y"] == 1).to_numpy(np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``score`` of every text, one pass over the texts."""
    ship(docs)
    known = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), feature_column(text).alias("x")))
    return known.select("doc_id", score_column("x", train(known, labels)).alias("score"))


def keep_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more; texts stay in their partitions."""
    ship(docs)
    known = docs.select(F.col(doc_id).alias("doc_id"), feature_column(text).alias("x"))
    model = train(known, labels)
    if model is None:
        return docs
    return docs.filter(score_column(feature_column(text), model) >= least)
