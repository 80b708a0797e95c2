"""Prefix trie of conversations by burst tries.

Turns get 128-bit ids (hashes of role and text); texts never move. A conversation is a row with
the ids of its turns; one container holds the conversations below the root. A container with more
than its share of turns or conversations bursts: its head becomes a node of the trie and its
conversations go to containers by their next turn id, by the next two ids when such a container
bursts again, then four, so that the number of rounds follows the logarithm of the shared depth.
Each round is a written table that holds only what burst.

Containers that are left are sorted by their turn ids and swept: one pass over a container's
conversations opens and closes nodes along the common prefix with the conversation before, and adds
up what belongs to subtrees. Nodes of burst heads come from aggregates. Each node is owned by its
smallest member, and a conversation owns the lower end of its path, so sums over a subtree are sums
over members: the owner of each container (and each conversation that ended above) adds its values
to all heads on its path, which combine before they are exchanged.

Rows hold ``SEGMENT`` turns at most. Longer conversations go on in further rows, which form tries
of their own below equal beginnings, deepest first; a conversation that shares its beginning with
no other is a chain and is written out without any grouping. So neither a conversation nor a group
of copies with a third of all turns is gathered anywhere. The ids of conversations that end at one
node are put into pieces in order; only their hash reads the pieces one after another, in a stream.

Defined results: rows with a null conversation id are left out; null role or text is empty; a null
turn number comes first; turns with equal numbers stand in the order of their ids, repeated rows are
repeated turns; conversations without turns are members of the root; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import ship, whole
from folioflow.operators.ordering import add_bucket, order_cuts, rank_rows, running_sum
from folioflow.session import cut_lineage

SEGMENT = 1024
#: Most turns and conversations of a container that is swept, and the least a small input uses.
TURNS, ROWS, LEAST_TURNS, LEAST_ROWS = 65_536, 16_384, 512, 64
PIECE = 4096  # conversation ids in one piece of a hashed list
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = [c.split()[0] for c in NODE.split(", ")]
KEY = ["k1", "k2"]


def turn_ids(
    table: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``conv, pos, a, b, n`` of each turn (its place, id and bytes of text), and ``conv, length``."""
    said, what = whole(F.col(role).cast("string")), whole(F.col(text).cast("string"))
    rows = table.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).isNotNull().alias("numbered"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.xxhash64(said, what).alias("a"),
        F.xxhash64(F.lit(7), what, said).alias("b"),
        F.octet_length(what).cast("long").alias("n"),
    ).filter("conv is not null")
    ranked = cut_lineage(rank_rows(rows, ["conv"], ["numbered", "turn", "a", "b", "n"], "pos").drop("numbered", "turn"))
    ranked = ranked.withColumn("pos", F.col("pos") - 1)
    return ranked, cut_lineage(ranked.groupBy("conv").agg(F.count("*").alias("length")))


def graft(turns: DataFrame, convs: DataFrame, base: Column, take: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``take`` turns (``most`` at most) are those of conversation ``base``.

    ``base`` and ``take`` are columns over ``conv``; a base that is absent gives no turns.
    """
    first = turns.filter(F.col("pos") < most).groupBy(F.col("conv").alias("base"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "n"))).alias("first"))
    plan = convs.withColumns({"base": base, "take": take.cast("long")}).join(first, "base", "left")
    got = F.slice(F.coalesce("first", F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,n:bigint>>")), F.lit(1), F.col("take").cast("int"))
    plan = plan.withColumn("first", got).withColumn("given", F.size("first").cast("long"))
    plan = cut_lineage(plan.withColumn("length", F.col("given") + F.greatest(F.lit(0).cast("long"), F.col("length") - F.col("take"))))
    lead = plan.select("conv", F.explode("first").alias("t")).select("conv", "t.pos", "t.a", "t.b", "t.n")
    own = turns.join(plan.select("conv", "take", "given"), "conv").filter("pos >= take")
    own = own.select("conv", (F.col("pos") - F.col("take") + F.col("given")).alias("pos"), "a", "b", "n")
    return lead.unionByName(own), plan.select("conv", "length")


def _segments(turns: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """``conv, s, ids, lens, more``: the turns of a conversation from ``s * size`` on; the last row may be empty."""
    whole_rows = turns.select("conv", F.floor(F.col("pos") / size).alias("s"), F.struct("pos", "a", "b", "n").alias("t"))
    ends = convs.select("conv", F.floor(F.col("length") / size).alias("s"), F.lit(None).cast(whole_rows.schema["t"].dataType).alias("t"))
    rows = whole_rows.unionByName(ends).groupBy("conv", "s").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select(
        "conv",
        "s",
        F.flatten(F.transform("t", lambda t: F.array(t["a"], t["b"]))).alias("ids"),
        F.transform("t", lambda t: t["n"]).alias("lens"),
        F.lit(False).alias("more"),
    )


def _key(depth: Column, salt: int) -> Column:
    """Half of the key of the node that a row's first ``depth`` turns lead to."""
    return F.xxhash64(F.lit(salt), "r1", "r2", depth.cast("int"), F.slice("ids", F.lit(1), (2 * depth).cast("int")))


def _keyed(rows: DataFrame, depth: Column, names: tuple[str, str] = ("k1", "k2")) -> DataFrame:
    return rows.withColumns({names[0]: _key(depth, 1), names[1]: _key(depth, 2)})


def _burst(rows: DataFrame, most_turns: int, most_rows: int) -> DataFrame:
    """Add ``off``: the depth of the container a row ends up in; one more than its length if it ended in a head."""
    settled, pending, step = [], cut_lineage(rows.withColumn("off", F.lit(0))), 1
    left = F.size("lens") - F.col("off")
    while True:
        now = _keyed(pending, F.col("off"))
        held = now.groupBy(*KEY).agg(F.count("*").alias("rows"), F.sum(left).alias("turns"))
        big = cut_lineage(held.filter((F.col("rows") > most_rows) | (F.col("turns") > most_turns)).select(*KEY))
        if big.isEmpty():
            return reduce(DataFrame.unionByName, [*settled, pending])
        settled.append(now.join(big, KEY, "left_anti").drop(*KEY))
        deeper = F.when(left >= step, F.col("off") + step).otherwise(F.size("lens") + 1)
        moved = cut_lineage(now.join(big, KEY, "left_semi").drop(*KEY).withColumn("off", deeper))
        settled.append(moved.filter(left < 0))
        pending, step = moved.filter(left >= 0), 2 * step


SWEPT = NODE + ", off int, p1 long, p2 long"


def _sweep(rows: DataFrame, base: int) -> DataFrame:
    """Nodes of each container; the row of its top has ``off`` and the key of its parent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[] for _ in range(11)]
        key, top = None, None
        parent, owner, n, size, depth, children, leaves, saved, ends = ([] for _ in range(9))
        path: list[int] = []
        open_: list[int] = []

        def add(up: int, length: int, d: int) -> int:
            for values, v in zip((parent, owner, n, size, depth, children, leaves, saved, ends), (up, None, 0, length, d, 0, 0, 0, None), strict=True):
                values.append(v)
            return len(parent) - 1

        def close() -> None:
            for i in range(len(parent) - 1, -1, -1):
                if not children[i]:
                    leaves[i] = 1
                saved[i] += (n[i] - 1) * size[i]
                if i:
                    p = parent[i]
                    owner[p] = owner[i] if owner[p] is None else min(owner[p], owner[i])
                    n[p] += n[i]
                    children[p] += 1
                    leaves[p] += leaves[i]
                    saved[p] += saved[i]
            count = len(parent)
            ups = [None, *(owner[p] for p in parent[1:])]
            digests = [EMPTY if e is None else e.hexdigest() for e in ends]
            rest = [None] * (count - 1)
            new = (owner, depth, ups, n, children, leaves, saved, digests, [top[0], *rest], [top[1], *rest], [top[2], *rest])
            for column, values in zip(columns, new, strict=True):
                column += values
            for values in (parent, owner, n, size, depth, children, leaves, saved, ends):
                values.clear()

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*COLUMNS, "off", "p1", "p2"])
            for c in columns:
                c.clear()
            return out

        for batch in batches:
            names = ("k1", "k2", "off", "p1", "p2", "b0", "conv", "ids", "lens", "more", "b_children", "b_leaves", "b_saved")
            for k1, k2, off, p1, p2, b0, conv, ids, lens, more, bc, bl, bs in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        close()
                    key, top, path = (k1, k2), (off, p1, p2), []
                    open_ = [add(-1, b0, base + off)]
                same = 0
                for x, y in zip(ids, path, strict=False):
                    if x != y:
                        break
                    same += 1
                same //= 2
                del open_[same + 1 :]
                for i in range(same, len(lens)):
                    open_.append(add(open_[-1], lens[i], base + off + i + 1))
                path, at = ids, open_[-1]
                n[at] += 1
                owner[at] = conv if owner[at] is None else min(owner[at], conv)
                children[at] += bc
                leaves[at] += bl
                saved[at] += bs
                if not more:
                    if ends[at] is None:
                        ends[at] = hashlib.sha256(str(conv).encode())
                    else:
                        ends[at].update(f",{conv}".encode())
            if len(columns[0]) > 50_000:
                yield flush()
        if key is not None:
            close()
        yield flush()

    off = F.col("off")
    held = _keyed(_keyed(rows.filter(off <= F.size("lens")), off), F.greatest(off - 1, F.lit(0)), ("p1", "p2"))
    held = held.select(
        *KEY,
        "off",
        F.when(off > 0, F.col("p1")).alias("p1"),
        F.when(off > 0, F.col("p2")).alias("p2"),
        F.when(off > 0, F.get("lens", off - 1)).otherwise(F.lit(0)).alias("b0"),
        "conv",
        F.slice("ids", 2 * off + 1, F.size("ids") - 2 * off).alias("ids"),
        F.slice("lens", off + 1, F.size("lens") - off).alias("lens"),
        "more",
        "b_children",
        "b_leaves",
        "b_saved",
    )
    # Members of a node that end there stand in the order of their ids, before all longer ones.
    held = held.repartition(*KEY).sortWithinPartitions(*KEY, "ids", "conv")
    return held.mapInArrow(run, SWEPT)


def _ends(rows: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of the lists of ``conv`` per key, ascending, read piece by piece."""
    cuts = order_cuts(rows, KEY, ["conv"], PIECE)
    parts = add_bucket(rows, cuts, KEY, ["conv"]).groupBy(*KEY, "_bucket")
    pieces = parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("piece"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        out: list[tuple[int, int, str]] = []
        for batch in batches:
            for k1, k2, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece")), strict=True):
                if (k1, k2) == key:
                    digest.update(b"," + piece.encode())
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256(piece.encode())
        if key is not None:
            out.append((*key, digest.hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], [*KEY, "ends_sha256"])

    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "_bucket").select(*KEY, "piece")
    return ordered.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def _level(rows: DataFrame, base: int, most_turns: int, most_rows: int) -> DataFrame:
    """All nodes below and with the roots ``r1, r2`` of ``rows``, which stand at depth ``base``."""
    placed = _burst(rows, most_turns, most_rows)
    swept = cut_lineage(_sweep(placed, base))
    inner = placed.filter("off > 0")
    if inner.isEmpty():
        return swept.select(*COLUMNS)
    at = F.col("d")
    ended = F.size("lens") < F.col("off")
    steps = inner.select("conv", "r1", "r2", "ids", "lens", "more", F.explode(F.sequence(F.lit(0), F.col("off") - 1)).alias("d"))
    steps = _keyed(_keyed(steps, at), F.greatest(at - 1, F.lit(0)), ("p1", "p2"))
    heads = steps.groupBy(*KEY).agg(
        F.min("d").alias("d"),
        F.count("*").alias("n_convs"),
        F.min("conv").alias("conv_id"),
        F.min(F.when(at > 0, F.get("lens", at - 1)).otherwise(F.lit(0))).alias("size"),
        F.count_if((F.size("lens") == at) & ~F.col("more")).alias("n_end"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )
    heads = cut_lineage(heads)
    value = F.struct("d", ((F.col("n_convs") - 1) * F.col("size")).alias("v"), (F.col("n_end") == F.col("n_convs")).alias("leaf"))
    chains = heads.groupBy(F.col("conv_id").alias("conv")).agg(F.sort_array(F.collect_list(value)).alias("chain"))
    tops = swept.filter("off > 0")
    below = tops.select(F.col("conv_id").alias("conv"), F.col("n_leaves").alias("t_leaves"), F.col("saved_tokens").alias("t_saved"))
    tips = inner.join(below, "conv", "left").filter(ended | F.col("t_leaves").isNotNull()).join(chains, "conv", "left")
    first = F.coalesce(F.get("chain", F.lit(0))["d"], F.col("off"))  # the first depth that this conversation owns
    leaf = (F.element_at("chain", -1)["leaf"]).cast("long")
    zero = F.lit(0).cast("long")
    tips = tips.withColumns(
        {
            "first": F.when(ended & F.col("chain").isNull(), F.col("off") + 1).otherwise(first),
            "leaves": F.when(ended, F.coalesce(leaf, zero) + F.col("b_leaves")).otherwise(F.col("t_leaves")),
            "saved": F.when(ended, F.col("b_saved")).otherwise(F.col("t_saved")),
            "below": F.when(ended, F.col("b_children")).otherwise(zero),
            "last": F.when(ended, F.col("off") - 1).otherwise(F.col("off")),  # the last depth of its path to count as a child
        }
    )
    gifts = tips.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("off") - 1)))
    owned = F.aggregate(
        F.filter(F.coalesce("chain", F.array().cast("array<struct<d:int,v:bigint,leaf:boolean>>")), lambda c: c["d"] >= at), zero, lambda s, c: s + c["v"]
    )
    child = (F.col("first") <= at + 1) & (at + 1 <= F.col("last"))
    gifts = _keyed(gifts, at).select(
        *KEY,
        (child.cast("long") + F.when(at == F.size("lens"), F.col("below")).otherwise(zero)).alias("n_children"),
        "leaves",
        (F.col("saved") + owned).alias("saved"),
    )
    sums = gifts.groupBy(*KEY).agg(
        F.sum("n_children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    stopped = _keyed(inner.filter(ended & ~F.col("more")), F.size("lens")).select(*KEY, "conv")
    full = heads.join(sums, KEY).join(_ends(stopped), KEY, "left")
    full = full.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))).withColumn("depth", (F.col("d") + base).cast("long"))
    full = full.withColumns({p: F.when(F.col("d") > 0, F.col(p)) for p in ("p1", "p2")})
    names = [c for c in COLUMNS if c != "parent_conv_id"]
    orphans = full.select(*names, "p1", "p2").unionByName(tops.select(*names, "p1", "p2"))
    parents = heads.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = orphans.join(parents, ["p1", "p2"], "left").select(*COLUMNS)
    return found.unionByName(swept.filter("off is null or off = 0").select(*COLUMNS))


def _long(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the key of their beginning in ``r1, r2``; those alone below theirs, and the others."""
    full = F.size("lens") == size
    empty = rows.filter((F.col("s") > 0) & (F.size("lens") == 0)).select("conv", (F.col("s") - 1).alias("s"), F.lit(True).alias("exact"))
    keyed = rows.join(empty, ["conv", "s"], "left").withColumn("more", full & F.col("exact").isNull()).drop("exact")
    for salt, name in ((1, "r1"), (2, "r2")):
        mark = F.xxhash64(F.lit(salt), "s", "ids").cast("decimal(38,0)")
        keyed = keyed.withColumn("mark", mark)
        keyed = running_sum(keyed, ["conv"], ["s"], F.col("mark"), "upto")
        before = F.xxhash64("s", (F.col("upto") - F.col("mark")).cast("string"))
        keyed = keyed.withColumn(name, F.when(F.col("s") > 0, before).otherwise(F.lit(0).cast("long"))).drop("mark", "upto")
    keyed = cut_lineage(keyed)
    met = keyed.filter("s > 0").groupBy("s", "r1", "r2").agg(F.min("conv").alias("conv"), F.count("*").alias("n"))
    alone = cut_lineage(met.filter("n = 1").groupBy("conv").agg(F.min("s").alias("since")))
    marked = keyed.join(alone, "conv", "left").withColumn("chain", F.coalesce(F.col("s") >= F.col("since"), F.lit(False)))
    return marked.filter("chain"), marked.filter("not chain").drop("chain", "since")


def prefix_trie(
    turns: DataFrame,
    convs: DataFrame,
    segment: int = SEGMENT,
    most_turns: int | None = None,
    most_rows: int | None = None,
) -> DataFrame:
    """One row per node, from ``turns(conv, pos, a, b, n)`` and ``convs(conv, length)``: columns ``NODE``."""
    ship(turns)
    spark = turns.sparkSession
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(_segments(turns, convs, segment))
    n, total, last = rows.agg(F.count("*"), F.sum(F.size("lens")), F.max("s")).first()
    if not n:
        return spark.createDataFrame([], NODE)
    most_turns = most_turns or min(TURNS, max(LEAST_TURNS, total // parts))
    most_rows = most_rows or min(ROWS, max(LEAST_ROWS, n // parts))
    nodes = []
    if last:
        chains, rows = _long(rows, segment)
        each = chains.select("conv", "s", "more", F.posexplode("lens").alias("i", "size"), F.size("lens").alias("n"))
        end = (F.col("i") == F.col("n") - 1) & ~F.col("more")
        one = F.lit(1).cast("long")
        chain_nodes = each.select(
            F.col("conv").alias("conv_id"),
            (F.col("s") * segment + F.col("i") + 1).alias("depth"),
            F.col("conv").alias("parent_conv_id"),
            one.alias("n_convs"),
            (~end).cast("long").alias("n_children"),
            one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(end, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
        )
        nodes.append(chain_nodes)
        starts = chains.filter("s = since and size(lens) > 0").select(
            "conv", (F.col("s") - 1).alias("s"), one.alias("b_children"), one.alias("b_leaves"), F.lit(0).cast("long").alias("b_saved")
        )
        deepest = rows.agg(F.max("s")).first()[0]
    else:
        rows, deepest, starts = rows.withColumns({r: F.lit(0).cast("long") for r in ("r1", "r2")}), 0, None
    gift = None
    for s in range(deepest, -1, -1):
        own = rows.filter(F.col("s") == s).drop("s")
        given = [g for g in (gift, starts.filter(F.col("s") == s).drop("s") if starts is not None else None) if g is not None]
        zeros = {c: F.lit(0).cast("long") for c in ("b_children", "b_leaves", "b_saved")}
        if given:
            own = own.join(reduce(DataFrame.unionByName, given), "conv", "left").fillna(0, list(zeros))
        else:
            own = own.withColumns(zeros)
        found = cut_lineage(_level(own, s * segment, most_turns, most_rows))
        if s:
            roots = found.filter((F.col("depth") == s * segment) & (F.col("n_children") > 0))
            gift = roots.select(
                F.col("conv_id").alias("conv"),
                F.col("n_children").alias("b_children"),
                F.col("n_leaves").alias("b_leaves"),
                F.col("saved_tokens").alias("b_saved"),
            )
            found = found.filter(F.col("depth") > s * segment)
        nodes.append(found)
    return reduce(DataFrame.unionByName, nodes)


def conversation_trie(
    table: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The prefix trie of a table of conversations as they are."""
    return prefix_trie(*turn_ids(table, conv_id, turn, role, text))
