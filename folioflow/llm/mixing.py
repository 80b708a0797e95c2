"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source wants ``target / size of the source`` copies. The whole part is
certain. The fractional parts are rounded in pairs: words move from one document to the
other, in a random direction that keeps every expectation, until one of them is integral;
the words of a pair never change, so a source misses its target by less than one
document. Pairs are formed inside small buckets of a source; each bucket leaves at most
one fractional document, and these residuals form the buckets of the next level, down to
one bucket per source. Nothing is collected but one level's count.

Defined results: a null text has size 0; documents without words take no part and are
kept once; the null source is a source of its own, last in order; equal rows are one
unit with a number of copies; equal sizes and ids are told apart by a hash of the row;
an empty table gives an empty result. Input columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import n_words, row_key
from folioflow.session import cut_lineage

WEIGHTS, SHARE, MAX_COPIES = (3, 1, 2), 1.5, 2
#: Units that one pairing expression holds.
BUCKET = 128
UNIT = "struct<k1:bigint,k2:bigint,w:double,f:double>"
DONE = "array<struct<k1:bigint,k2:bigint,f:double>>"


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> DataFrame:
    """``sizes(source, source_size)`` with ``target``: shares by weight, filled up to ``cap`` times the size.

    The order of the sources is made by a range partitioning, so no task sees them all;
    the excess of capped sources is shared again until a round caps none.
    """
    keyed = sizes.select("source", F.col("source").isNull().alias("void"), "source_size", "n")
    parts = keyed.repartitionByRange("void", "source").withColumn("part", F.spark_partition_id())
    parts = cut_lineage(parts)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count("*").alias("m"))  # one row per partition
    offsets = offsets.select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("skip"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("void", "source")) - 1 + F.col("skip")
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = parts.join(F.broadcast(offsets), "part").withColumn("weight", F.get(table, F.pmod(rank, F.lit(len(weights))).cast("int")))
    rows = cut_lineage(rows.select("source", "source_size", "n", "weight", (F.col("source_size") * cap).alias("most")))
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    full = F.lit(False)
    while True:
        free = F.when(~full, F.col("weight"))
        used, w = rows.agg(F.sum(F.when(full, F.col("most"))), F.sum(free)).first()
        if not w:
            break
        level = max(0.0, total - (used or 0)) / w
        above = ~full & (F.col("weight") * level > F.col("most"))
        if not rows.filter(above).limit(1).count():
            break
        full = F.col("weight") * level > F.col("most")
        # A source capped once stays capped: the level only grows.
    target = F.least(F.col("most"), F.col("weight") * level).cast("double")
    return rows.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(0.0)).drop("weight", "most")


def _pair(a: str, b: str, u: str) -> str:
    """SQL of one pivotal step between the units ``a`` and ``b``, given a uniform number."""
    gain, loss = f"least((1-{a}.f)*{a}.w, {b}.f*{b}.w)", f"least({a}.f*{a}.w, (1-{b}.f)*{b}.w)"
    moved = f"if({u}*({gain}+{loss}) < {loss}, {gain}, -{loss})"
    snap = lambda x: f"(case when {x} < 1e-9 then 0D when {x} > 1-1e-9 then 1D else {x} end)"
    fa, fb = snap(f"({a}.f + {moved}/{a}.w)"), snap(f"({b}.f - {moved}/{b}.w)")
    return f"struct({fa} as fa, {fb} as fb)"


def _round_bucket(seed: int) -> Column:
    """Pairs of the array ``units``: ``done`` (integral units) and ``cur`` (the residual, or null)."""
    u = f"(pmod(xxhash64({seed}L, a.cur.k1, a.cur.k2, x.k1, x.k2), 1048576) + 0.5D) / 1048576D"
    none = f"cast(null as {UNIT})"
    keep = lambda k, f: f"struct({k}.k1, {k}.k2, r.{f} as f)"
    rest = lambda k, f: f"named_struct('k1',{k}.k1,'k2',{k}.k2,'w',{k}.w,'f',r.{f})"
    step = f"""transform(array({_pair('a.cur', 'x', u)}), r -> named_struct(
        'done', concat(a.done,
            if(r.fa in (0D,1D), array({keep('a.cur', 'fa')}), cast(array() as {DONE})),
            if(r.fb in (0D,1D), array({keep('x', 'fb')}), cast(array() as {DONE}))),
        'cur', case when r.fa not in (0D,1D) then {rest('a.cur', 'fa')} when r.fb not in (0D,1D) then {rest('x', 'fb')} else {none} end))[0]"""
    return F.expr(
        f"""aggregate(units, named_struct('done', cast(array() as {DONE}), 'cur', {none}),
            (a, x) -> cast(if(a.cur is null, named_struct('done', a.done, 'cur', x), {step})
                as struct<done:{DONE},cur:{UNIT}>))"""
    )


def round_units(units: DataFrame, counts: DataFrame, seed: int = 0, bucket: int = BUCKET) -> DataFrame:
    """Units ``(source, k1, k2, w, f)`` with ``0 < f < 1`` to ``(source, k1, k2, f)`` with f 0 or 1."""
    now, done, level = units.join(counts, F.col("source").eqNullSafe(F.col("cs"))).drop("cs"), None, 0
    while True:
        n_buckets = F.ceil(F.col("n") / bucket)
        spot = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "k1", "k2"), n_buckets)
        grouped = now.groupBy("source", "n", spot.alias("spot")).agg(
            # Large documents first: small ones then round them off, and a small one is left over.
            F.expr("transform(sort_array(collect_list(struct(w, k1, k2, f)), false), x -> struct(x.k1, x.k2, x.w, x.f))").alias("units")
        )
        grouped = grouped.withColumn("units", F.col("units").cast(f"array<{UNIT}>"))
        rounded = cut_lineage(grouped.select("source", "n", _round_bucket(seed + level).alias("r")))
        part = rounded.select("source", F.explode("r.done").alias("d")).select("source", "d.k1", "d.k2", "d.f")
        done = part if done is None else done.union(part)
        rest = rounded.filter("r.cur is not null").select("source", "r.cur.*", F.ceil(F.col("n") / bucket).alias("n"))
        if (rounded.agg(F.max("n")).first()[0] or 0) <= bucket:
            coin = (F.pmod(F.xxhash64(F.lit(seed + 99), "k1", "k2"), F.lit(1048576)) + 0.5) / 1048576
            last = rest.select("source", "k1", "k2", (coin < F.col("f")).cast("double").alias("f"))
            return done.union(last)
        now, level = rest, level + 1


def plan_mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    seed: int = 0,
) -> DataFrame:
    """One narrow row per document: its row key, size, source size, target and copies."""
    keyed = row_key(docs)
    sized = keyed.select("_llm_k1", "_llm_k2", F.col(source).alias("source"), n_words(text).alias("size"), *_carried(docs, text, source))
    sized = cut_lineage(sized)
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    targets = cut_lineage(source_targets(sums, weights, share))
    per = targets.select(F.col("source").alias("ts"), "source_size", "target", F.col("n").alias("tn"))
    rows = sized.join(per, F.col("source").eqNullSafe(F.col("ts"))).drop("ts")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("sure", F.floor(rate + 1e-9)).withColumn("frac", F.greatest(rate - F.col("sure"), F.lit(0.0)))
    open_rows = rows.filter("size > 0 and frac > 1e-9")
    # Equal rows are one unit: the whole part of their common fraction is certain too.
    units = open_rows.groupBy("source", F.col("_llm_k1").alias("k1"), F.col("_llm_k2").alias("k2"), "size", "frac").agg(F.count("*").alias("m"))
    units = units.withColumn("more", F.floor(F.col("m") * F.col("frac") + 1e-9)).withColumn("f", F.col("m") * F.col("frac") - F.col("more"))
    units = cut_lineage(units)
    counts = targets.select(F.col("source").alias("cs"), F.greatest("n", F.lit(1)).alias("n"))
    loose = units.filter("f > 1e-9").select("source", "k1", "k2", F.col("size").cast("double").alias("w"), "f")
    rounded = round_units(loose, counts, seed).select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), F.col("f").alias("extra"))
    # Units come out of an explode here, which the optimizer sizes too low: they are not for a broadcast.
    plan = units.join(rounded.hint("merge"), (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left")
    plan = plan.select("k1", "k2", "m", (F.col("more") + F.coalesce("extra", F.lit(0.0))).cast("long").alias("extra"))
    rows = rows.join(plan, (F.col("_llm_k1") == F.col("k1")) & (F.col("_llm_k2") == F.col("k2")), "left")
    # Of m equal rows, the first ones get the extra copies.
    nth = F.row_number().over(Window.partitionBy("_llm_k1", "_llm_k2").orderBy("size"))
    got = F.when(F.coalesce("extra", F.lit(0)) == 0, 0).when(F.col("extra") >= F.col("m"), 1).when(nth <= F.col("extra"), 1).otherwise(0)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("sure") + got).cast("long")
    return rows.withColumn("copies", copies).select(
        "_llm_k1", "_llm_k2", *_carried(docs, text, source), "source", "size", "source_size", "target", "copies"
    )


def _carried(docs: DataFrame, text: str, source: str) -> list[str]:
    """Columns of the plan beside the keys: the id, if there is one."""
    return [c for c in docs.columns if c == "doc_id" and c not in (text, source)]


def mix(docs: DataFrame, text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, seed: int = 0) -> DataFrame:
    """The mixed corpus: every document as often as its plan says, columns unchanged."""
    plan = plan_mix(docs, text, source, weights, share, seed)
    per_key = plan.groupBy("_llm_k1", "_llm_k2").agg(F.sum("copies").alias("_llm_c"), F.count("*").alias("_llm_m"))
    rows = row_key(docs).join(per_key, ["_llm_k1", "_llm_k2"])
    # The copies of equal rows are dealt out evenly; which of them gets more is no difference.
    nth = F.row_number().over(Window.partitionBy("_llm_k1", "_llm_k2").orderBy("_llm_c"))
    own = F.floor((F.col("_llm_c") + F.col("_llm_m") - nth) / F.col("_llm_m"))
    rows = rows.withColumn("_llm_own", own.cast("int")).filter("_llm_own > 0")
    rows = rows.withColumn("_llm_n", F.explode(F.sequence(F.lit(1), F.col("_llm_own"))))
    return rows.select(*[f"`{c}`" for c in docs.columns])
