"""Language-model scoring with a log-frequency Bloom filter.

Training counts words and pairs of neighbouring words. A count ``c`` is quantised to the
level ``1 + floor(log_base c)``, and the filter holds an n-gram once for each level up to
its own; a lookup probes level after level until one is missing, so an error never lowers
a count. The filter has ``FILL_BITS`` bits for each entry counted (``FILTER_BITS`` at least),
so it grows with the corpus and keeps every n-gram. It is cut into segments by hash, and each
segment is built by the task that has the final counts of its n-grams. Workers get it by
broadcast; a filter above ``PART_BITS`` is sent in parts of whole segments one after another,
and the levels found so far travel with the texts (two bytes per token).

Counting: each slice of a partition sends its sorted distinct hashes with counts, cut by
hash into buckets, so a word costs one entry per slice however frequent it is. Only a caller
who fixes ``bits`` loses n-grams: the least count level kept then grows until the entries fit.

The base score needs exact counts. Words of the upper count levels, ``MAX_TABLE`` at most,
are broadcast with their counts; tokens of other words are joined with the full counts.

Words are compared by 64-bit hashes. Defined results: a null or empty text is the end token
alone; repeated rows count and score as often as they occur; without training rows N and V
are 0 and every base score is 0; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import ship, slices
from folioflow.session import cut_lineage

FILTER_BITS, PROBES, BASE, FILL_BITS = 1 << 28, 3, 1.5, 8
#: Bits of the filter that one broadcast takes at most.
PART_BITS = 1 << 29
PAIR_CUTOFF, MAX_TABLE = 1, 1_000_000
LEVELS = 1 + int(math.log(2**40, BASE))
#: Bytes of text worked on at once: larger slices repeat fewer n-grams when counting, scoring needs no more.
SLICE_BYTES, SCORE_BYTES = 4 << 20, 1 << 20
MIX = 0.7
END = xxhash.xxh64_intdigest(b"\n", 42)  # no word holds a line break
_U = np.uint64


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, each text closed by ``END``, and the tokens per text."""
    digest = xxhash.xxh64_intdigest
    each = [[digest(w, 42) for w in (t or "").encode().lower().split()] for t in texts]
    flat = np.fromiter((h for doc in each for h in (*doc, END)), _U, sum(map(len, each)) + len(each))
    return flat, np.array([len(doc) + 1 for doc in each], np.int64)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ (x >> _U(33)) ^ _U(salt)) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def pairs_of(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it; ``END`` stands before a text."""
    before = np.concatenate(([_U(END)], flat[:-1])) if len(flat) else flat
    return mixed(before, 1) + flat * _U(0x9E3779B97F4A7C15)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    return (1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9)).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def count_ngrams(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """``(kind, bucket, keys, counts)``: kind 0 words, 1 pairs; final counts, one row per kind and bucket."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                flat, lengths = tokens(part.column("text").to_pylist())
                for kind, keys in enumerate((flat, pairs_of(flat, lengths))):
                    keys, counts = np.unique(keys, return_counts=True)
                    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
                    spans = [(b, cuts[b], cuts[b + 1]) for b in range(buckets) if cuts[b] < cuts[b + 1]]
                    counts = counts.astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([kind] * len(spans), pa.int32()),
                            pa.array([b for b, _, _ in spans], pa.int32()),
                            pa.array([keys[i:j].tobytes() for _, i, j in spans], pa.binary()),
                            # Counts of a slice fit four bytes; most are one, which compresses well.
                            pa.array([counts[i:j].astype(np.uint32).tobytes() for _, i, j in spans], pa.binary()),
                        ],
                        ["kind", "bucket", "keys", "counts"],
                    )

    def merge(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), _U)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32).astype(np.int64)
        keys, counts = _summed(keys, counts)
        if kind := table.column("kind")[0].as_py():
            keep = counts >= PAIR_CUTOFF
            keys, counts = keys[keep], counts[keep]
        bucket = table.column("bucket")[0].as_py()
        held = np.bincount(np.minimum(level(counts), LEVELS), minlength=LEVELS + 1)
        return pa.table(
            {
                "kind": pa.array([kind], pa.int32()),
                "bucket": pa.array([bucket], pa.int32()),
                "keys": pa.array([keys.tobytes()], pa.binary()),
                "counts": pa.array([counts.tobytes()], pa.binary()),
                "n": pa.array([len(keys)], pa.int64()),
                "total": pa.array([int(counts.sum())], pa.int64()),
                "held": pa.array([held.tolist()], pa.list_(pa.int64())),
            }
        )

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "kind int, bucket int, keys binary, counts binary")
    schema = "kind int, bucket int, keys binary, counts binary, n long, total long, held array<long>"
    return parts.groupBy("kind", "bucket").applyInArrow(merge, schema)


def _places(keys: np.ndarray, levels: np.ndarray, buckets: int, bits: int) -> list[np.ndarray]:
    """Bit positions of (n-gram, level) entries, all inside the segment of the n-gram's bucket."""
    size = bits // buckets
    base = bucket_of(keys, buckets) * size
    x = mixed(keys + levels.astype(_U) * _U(0x9E3779B97F4A7C15), 2)
    step = mixed(x, 3) | _U(1)
    return [base + ((x + _U(i) * step) % _U(size)).astype(np.int64) for i in range(PROBES)]


def filter_bits(held: list[list[int]], buckets: int) -> int:
    """Bits that hold all counted (n-gram, level) entries, in whole bytes per segment."""
    entries = sum(q * n for levels in held for q, n in enumerate(levels))
    return buckets * 8 * -(-max(FILTER_BITS, FILL_BITS * entries) // (8 * buckets))


def build_filter(
    counts: DataFrame, least: tuple[int, int], buckets: int, bits: int, first: int = 0, width: int | None = None
) -> np.ndarray:
    """The bytes of ``width`` segments from ``first`` on (of all by default), joined on the driver.

    Each task fills whole segments; ``bits`` is the size of all of them.
    """
    size, width = bits // buckets, buckets if width is None else width
    if width < buckets:
        counts = counts.filter(F.col("bucket").between(first, first + width - 1))

    def fill(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        segment = np.zeros(size, bool)
        for kind, k, c in zip(*(table.column(x).to_pylist() for x in ("kind", "keys", "counts")), strict=True):
            keys, top = np.frombuffer(k, _U), level(np.frombuffer(c, np.int64))
            top[top < least[kind]] = 0
            for q in range(1, int(top.max(initial=0)) + 1):
                here = keys[top >= q]
                for place in _places(here, np.full(len(here), q), buckets, bits):
                    segment[place - bucket * size] = True
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": pa.array([np.packbits(segment).tobytes()], pa.binary())})

    out = np.zeros(width * size // 8, np.uint8)
    for bucket, part in counts.groupBy("bucket").applyInArrow(fill, "bucket int, bits binary").collect():
        at = (bucket - first) * size // 8
        out[at : at + size // 8] = np.frombuffer(part, np.uint8)
    return out


def found_levels(part: np.ndarray, keys: np.ndarray, buckets: int, first: int, width: int) -> np.ndarray:
    """Levels by repeated membership probes; 0 where nothing is stored or the segment is not in ``part``."""
    size, own = 8 * len(part) // width, bucket_of(keys, buckets)
    found, alive, q = np.zeros(len(keys), np.uint8), np.flatnonzero((own >= first) & (own < first + width)), 1
    while len(alive) and q <= LEVELS:
        here = keys[alive]
        held = np.ones(len(alive), bool)
        for place in _places(here, np.full(len(alive), q), buckets, size * buckets):
            place = place - first * size
            held &= (part[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        alive = alive[held]
        found[alive] = q
        q += 1
    return found


def estimate(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for."""
    return np.where(levels > 0, (BASE ** (levels - 1.0) + BASE ** levels.astype(float)) / 2, 0.0)


def lookup(filter_: np.ndarray, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Estimated counts, 0 where nothing is stored, from a whole filter."""
    return estimate(found_levels(filter_, keys, buckets, 0, buckets))


def _probe(part: np.ndarray, flat: np.ndarray, lengths: np.ndarray, known: list, buckets: int, first: int, width: int):
    """Levels of each token and of each pair: those in ``part``, and those ``known`` per text from other parts."""
    out = []
    for keys in (flat, pairs_of(flat, lengths)):
        once, back = np.unique(keys, return_inverse=True)
        out.append(found_levels(part, once, buckets, first, width)[back])
    if known and known[0] is not None:
        ends = np.cumsum(lengths)
        for k, (start, end) in enumerate(zip(ends - lengths, ends, strict=True)):
            old = np.frombuffer(known[k], np.uint8).reshape(2, -1)
            for new, of in zip(out, old, strict=True):
                new[start:end] = np.maximum(new[start:end], of)
    return out


def _least_levels(held: list[list[int]], bits: int) -> tuple[int, int]:
    """Least level kept of words and pairs, so that the filter's entries fit its bits."""
    least = [1, 1]
    entries = lambda k: sum(q * n for q, n in enumerate(held[k]) if q >= least[k])
    while FILL_BITS * (entries(0) + entries(1)) > bits:
        worst = max((0, 1), key=entries)
        least[worst] += 1
    return least[0], least[1]


def _add_levels(texts: DataFrame, part: np.ndarray, buckets: int, first: int, width: int) -> DataFrame:
    """``texts(doc_id, text, levels)`` with the levels that ``part`` holds, as a written table."""
    shared = texts.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SCORE_BYTES):
                flat, lengths = tokens(rows.column("text").to_pylist())
                single, both = _probe(shared.value, flat, lengths, rows.column("levels").to_pylist(), buckets, first, width)
                ends = np.cumsum(lengths)
                held = [single[i:j].tobytes() + both[i:j].tobytes() for i, j in zip(ends - lengths, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("text"), pa.array(held, pa.binary())], ["doc_id", "text", "levels"]
                )

    out = cut_lineage(texts.mapInArrow(run, "doc_id long, text string, levels binary"))
    shared.destroy()
    return out


def score_texts(
    docs: DataFrame,
    training: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    bits: int | None = None,
    max_table: int = MAX_TABLE,
    part_bits: int = PART_BITS,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    Rows where ``training`` holds are counted. The filter is as large as its entries need
    unless ``bits`` fixes its size.
    """
    ship(docs)
    spark = docs.sparkSession
    buckets = 1 << max(5, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length() - 1)
    if bits:
        buckets = min(buckets, bits // 512)
    counts = cut_lineage(count_ngrams(docs.filter(training), text, buckets))
    sums = counts.groupBy("kind").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), *[F.sum(F.get("held", F.lit(q))).alias(f"h{q}") for q in range(LEVELS + 1)]
    )
    by_kind = {r["kind"]: r for r in sums.collect()}
    held = [[by_kind[k][f"h{q}"] if k in by_kind else 0 for q in range(LEVELS + 1)] for k in (0, 1)]
    total, distinct = (by_kind[0]["total"], by_kind[0]["n"]) if 0 in by_kind else (0, 0)
    least = _least_levels(held, bits) if bits else (1, 1)
    bits = bits or filter_bits(held, buckets)
    width = min(buckets, max(1, part_bits * buckets // bits))

    # Levels from the top down whose words fit the table; `rest` levels are joined.
    rest = LEVELS
    while rest and sum(held[0][rest:]) <= max_table:
        rest -= 1
    words = counts.filter("kind = 0")

    def rows(top: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, c in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                    keys, n = np.frombuffer(k, np.int64), np.frombuffer(c, np.int64)
                    keep = (level(n) > rest) == top
                    yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(n[keep])], ["h", "c"])

        return words.select("keys", "counts").mapInArrow(run, "h long, c long")

    table = rows(True).toArrow()  # at most max_table rows
    known_keys = table.column("h").to_numpy().view(_U)
    order = np.argsort(known_keys)
    denominator = math.log10(total + distinct + 1)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("binary").alias("levels"))
    for first in range(0, buckets - width, width):  # all parts but the last
        texts = _add_levels(texts, build_filter(counts, least, buckets, bits, first, width), buckets, first, width)
    first = (buckets - 1) // width * width
    width = buckets - first
    filter_ = build_filter(counts, least, buckets, bits, first, width)
    shared = spark.sparkContext.broadcast((filter_, known_keys[order], table.column("c").to_numpy()[order]))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what counting has left in this worker
        bloom, keys, known = shared.value
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                flat, lengths = tokens(part.column("text").to_pylist())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                of = lambda v: np.add.reduceat(v, starts) if len(starts) else v
                once, back = np.unique(flat, return_inverse=True)
                at = np.minimum(np.searchsorted(keys, once), max(0, len(keys) - 1))
                exact = np.where(keys[at] == once, known[at], 0) if len(keys) else np.zeros(len(once), np.int64)
                stored = part.column("levels").to_pylist()
                single, both = map(estimate, _probe(bloom, flat, lengths, stored, buckets, first, width))
                before = np.concatenate((single[-1:], single[:-1]))  # every text ends with END
                floor = (single + 1) / (total + distinct + 1)
                follow = np.where(before > 0, np.minimum(both / np.maximum(before, 1e-9), 1.0), 0.0)
                chance = np.where(before > 0, MIX * follow + (1 - MIX) * floor, floor)
                base = np.log10(exact + 1.0) - denominator
                # Words outside the table: their counts come from the join, unless all words are in it.
                open_ = (exact == 0)[back] if rest else np.zeros(len(flat), bool)
                owner = np.repeat(np.arange(len(lengths)), lengths)[open_]
                cuts = np.searchsorted(owner, np.arange(len(lengths) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(lengths),
                        pa.array(of((exact > 0)[back].astype(np.int64))),
                        pa.array(of(base[back])),
                        pa.array(of(np.log10(chance))),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat[open_].view(np.int64))),
                    ],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score", "open"],
                )

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, open array<long>"
    scored = texts.mapInArrow(score, schema)
    final = ["doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"]
    if not rest:
        return scored.select(*final)
    scored = cut_lineage(scored.withColumn("row", F.monotonically_increasing_id()))
    tail = scored.select("row", F.explode("open").alias("h")).groupBy("row", "h").agg(F.count("*").alias("tf"))
    tail = tail.join(rows(False), "h").groupBy("row")
    tail = tail.agg(F.sum("tf").alias("more_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("more"))
    whole = scored.drop("open").join(tail, "row", "left").withColumns(
        {
            "n_known": F.col("n_known") + F.coalesce("more_known", F.lit(0)),
            "base_score": F.col("base_score") + F.coalesce("more", F.lit(0.0)),
        }
    )
    return whole.select(*final)
