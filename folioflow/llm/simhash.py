"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two 32-bit segments. Two fingerprints within 3 bits differ by at most
one bit in one of them, so each fingerprint is stored under both of its segments and looks
up the Hamming ball of radius one around each; every match is verified over all 64 bits.
Only distinct fingerprints take part, so groups of copies of any size cost one row.

Defined results: a null or empty text has fingerprint zero, which links like any other; a
text of fewer than ``width`` words is one shingle; repeated rows and ids share their class;
a null id never becomes a component id unless all ids of the component are null; an empty
table gives an empty result. Columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from folioflow.llm.common import components, row_key, ship
from folioflow.session import cut_lineage

WIDTH, SEED, RADIUS = 3, 42, 3
#: A segment value that more fingerprints share is looked up together with 16 more bits.
HOT_SEGMENT = 4096
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def simhash(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in range(at, min(n, at + BLOCK))]
        ones += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint(column: str, width: int = WIDTH):
    @arrow_udf("long")
    def udf(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t.as_py(), width) for t in texts], pa.int64())

    return udf(F.col(column))


def _segments(fps: DataFrame) -> DataFrame:
    """Index rows: ``seg`` (0 low, 1 high), its 32 bits as ``v``."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    both = F.array(F.struct(F.lit(0).alias("seg"), low.alias("v")), F.struct(F.lit(1).alias("seg"), high.alias("v")))
    return fps.select("fp", F.explode(both).alias("s")).select("fp", "s.seg", "s.v")


def _ball(value, bits: int, either: bool = False):
    """A value and its neighbours with one set bit cleared; with ``either`` all that differ in one bit.

    Of two values that differ in one bit, one has it set: clearing is enough to meet, as
    long as each of the two may be the one that asks.
    """
    masks = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    if not either:
        masks = F.filter(masks, lambda m: value.bitwiseAND(m) != 0)
    return F.concat(F.array(value), F.transform(masks, lambda m: value.bitwiseXOR(m)))


def _in_part(part: int, value):
    return F.struct(F.lit(part).alias("part"), value.alias("w"))


def _finer(rows: DataFrame, probe: bool) -> DataFrame:
    """Add 16 bits of the other segment to a hot key: one of its halves differs by one bit at most."""
    other = F.when(F.col("seg") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    halves = [other.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(other, 16)]
    near = [_ball(h, 16, either=True) if probe else F.array(h) for h in halves]  # who asks is settled by now
    keys = F.concat(*[F.transform(n, partial(_in_part, part)) for part, n in enumerate(near)])
    return rows.withColumn("k", F.explode(keys)).select("fp", "seg", "v", "k.part", "k.w")


def near_pairs(fps: DataFrame, radius: int = RADIUS, hot: int = HOT_SEGMENT) -> DataFrame:
    """Pairs ``(a, b)`` of the distinct fingerprints ``fp`` that differ in at most ``radius`` (0 to 3) bits.

    A segment value shared by more than ``hot`` fingerprints would compare them all with
    each other. Those values get longer keys: at most three bits differ in the rest, so one
    16-bit half of it differs in one bit at most, and a longer key holds 65,536 of the
    distinct fingerprints at most.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two segments of ball radius one cover at most 3 bits")
    index = _segments(fps)
    probes = index.withColumn("v", F.explode(_ball(F.col("v"), 32)))
    close = F.bit_count(F.col("i.fp").bitwiseXOR(F.col("p.fp"))) <= radius
    crowded = cut_lineage(index.groupBy("seg", "v").count().filter(F.col("count") > hot).select("seg", "v"))
    keys, more = ["seg", "v"], []
    if not crowded.isEmpty():
        parts = [_finer(side.join(crowded, keys, "left_semi"), side is probes) for side in (index, probes)]
        more = [(*parts, ["seg", "v", "part", "w"])]
        index, probes = (side.join(crowded, keys, "left_anti") for side in (index, probes))
    found = None
    for left, right, on in [(index, probes, keys), *more]:
        same = [F.col(f"i.{k}") == F.col(f"p.{k}") for k in on]
        # Both sides come out of an explode, which the optimizer takes for one row each: it would broadcast them.
        pairs = left.alias("i").join(right.alias("p").hint("merge"), [*same, F.col("i.fp") != F.col("p.fp"), close])
        pairs = pairs.select(F.least("i.fp", "p.fp").alias("a"), F.greatest("i.fp", "p.fp").alias("b"))
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def classes(rows: DataFrame, radius: int = RADIUS, hot: int = HOT_SEGMENT) -> DataFrame:
    """``rows(fp, id)`` to one row per fingerprint: ``fp``, ``root`` (a fingerprint), ``component`` (smallest id)."""
    own = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("id")))
    roots = components(near_pairs(own.select("fp"), radius, hot))
    placed = own.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "id", F.coalesce("root", "fp").alias("root"))
    linked = roots.select("root").distinct()
    # A fingerprint without a link is its own component; only linked ones are aggregated.
    least = placed.join(linked, "root", "left_semi").groupBy("root").agg(F.min("id").alias("component"))
    return placed.join(least, "root", "left").select("fp", "root", F.coalesce("component", "id").alias("component"))


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component`` of every row."""
    ship(docs)
    rows = cut_lineage(docs.select(F.col(doc_id).alias("id"), fingerprint(text).alias("fp")))
    found = rows.join(classes(rows, radius).select("fp", "component"), "fp")
    return found.select(F.col("id").alias("doc_id"), "fp", "component")


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row of each component stays: the smallest id, the smallest row key among equal ids."""
    ship(docs)
    keyed = row_key(docs)
    rows = cut_lineage(keyed.select(F.col(doc_id).alias("id"), "_llm_k1", "_llm_k2", fingerprint(text).alias("fp")))
    rank = F.struct(F.col("id").isNull().alias("void"), "id", "_llm_k1", "_llm_k2")
    best = rows.groupBy("fp").agg(F.min(rank).alias("best"))
    roots = classes(rows, radius).select("fp", "root")
    winners = best.join(roots, "fp").groupBy("root").agg(F.min("best").alias("w")).select("w._llm_k1", "w._llm_k2")
    kept = keyed.join(winners, ["_llm_k1", "_llm_k2"], "left_semi")
    # Rows equal in every column lie in one partition of that join: the first one stays.
    return kept.dropDuplicates(["_llm_k1", "_llm_k2"]).select(*[f"`{c}`" for c in docs.columns])
