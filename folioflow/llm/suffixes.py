"""Duplicate passages by a distributed merge sort of front-coded suffix runs.

A byte goes if a string of ``LENGTH`` bytes around it also starts in a document with a
smaller id. Sorting every suffix is not needed: each such string (window) has an anchor, the
start of its ``GRAM`` bytes with the smallest hash, and equal windows have equal anchors.
Consecutive windows with one anchor form an entry: the suffix that starts at the anchor,
followed by what the windows need from its left.

1. Anchors that occur in several rows are found by exchanging sorted runs of their hashes;
   a filter of ``FILTER_BITS`` bits carries them to the tasks (a false hit costs work only).
2. Each task sorts the entries of such anchors into runs, equal ones once with the rows they
   occur in, and sends the runs front-coded by bucket.
3. Buckets are merged by loser trees that keep, for each run, the prefix it has in common
   with the last entry taken: the longer prefix wins without a comparison, and bytes known
   to be equal are not looked at again. The same numbers show where an anchor's entries end.
   Entries of one anchor are compared window by window, which gives each window its least id.
4. The answers become byte ranges of the documents of each run; a join by document cuts them.

An anchor in more than ``HOT_ROWS`` rows would fill one bucket: its windows are entries of
their own, bucketed by all their bytes. Runs hold an entry once, so a passage that very many
documents share costs one entry per run.

Defined results: a null or empty text has no bytes; a text shorter than ``LENGTH`` is never
cut; rows with equal ids do not cut each other; a row with a null id is left whole and
cuts nothing; a cut may split a character, so what is kept is binary; ``id`` and text are
read, other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from folioflow.llm.common import ship, slices, whole

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1  # anchors to choose from in a window
FILTER_BITS, PROBES = 1 << 27, 2
HOT_ROWS = 50_000
SLICE_BYTES, RUN_BYTES = 1 << 20, 8 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_KEPT = _U(0xFFFFFFFFFFFF0000)  # six bytes of a hash are exchanged


def _scrambled(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ (x >> _U(32)) ^ _U(salt)) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


def _joined(first: np.ndarray, n: int, second: np.ndarray, m: int) -> np.ndarray:
    """Hashes of n + m bytes from those of n bytes and of the m bytes that follow."""
    size = len(second) - n
    return first[:size] * _U(pow(_BASE, m, 1 << 64)) + second[n:]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    power, n, out, m, want = data.astype(_U), 1, None, 0, GRAM
    while True:
        if want & 1:
            out, m = (power, n) if out is None else (_joined(out, m, power, n), m + n)
        want >>= 1
        if not want:
            return _scrambled(out)
        power, n = _joined(power, n, power, n), 2 * n


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x, n = np.minimum(x[:-n], x[n:]), 2 * n
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


def find_entries(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last window start, anchor, anchor hash and row of each entry of joined texts."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(_U), none
    hashes = gram_hashes(data)
    mask = _U((1 << int(len(data)).bit_length()) - 1)
    # The low bits hold the position: of equal hashes the leftmost is the anchor.
    least = _sliding_min((hashes & ~mask) | np.arange(len(hashes), dtype=_U), SPAN)
    anchor = (least & mask).astype(np.int64)
    inside = np.ones(len(anchor), bool)
    ends = np.cumsum(lengths)
    for e in ends[:-1].tolist():
        inside[max(0, e - LENGTH + 1) : e] = False
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    stop = np.ones(len(anchor), bool)
    stop[:-1] = (anchor[1:] != anchor[:-1]) | ~inside[1:]
    last = np.flatnonzero(stop & inside)
    at = anchor[first]
    # Anchors have small hashes by choice: mixed again, they spread over all buckets.
    return first, last, at, _scrambled(hashes[at], 3), np.searchsorted(ends, first, "right")


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _bits_of(keys: np.ndarray, buckets: int, bits: int) -> list[np.ndarray]:
    """Filter bits of a hash, all in the segment of its bucket."""
    size = bits // buckets
    x = _scrambled(keys & _KEPT, 5)
    step = _scrambled(x, 6) | _U(1)
    return [_bucket_of(keys, buckets) * size + ((x + _U(i) * step) % _U(size)).astype(np.int64) for i in range(PROBES)]


def _in_filter(filter_: np.ndarray, keys: np.ndarray, buckets: int) -> np.ndarray:
    held = np.ones(len(keys), bool)
    for at in _bits_of(keys, buckets, 8 * len(filter_)):
        held &= (filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return held


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Bytes and row lengths of parts of the batches, of rows that have an id and a window."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            texts = part.column("text").cast(pa.binary())
            sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero((sizes >= LENGTH) & part.column("id").is_valid().to_numpy(zero_copy_only=False))
            if len(keep):
                rows = part.take(pa.array(keep))
                data = np.frombuffer(b"".join(rows.column("text").cast(pa.binary()).to_pylist()), np.uint8)
                yield data, sizes[keep].astype(np.int64), rows


def shared_anchors(rows: DataFrame, buckets: int, bits: int, hot_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Filters of the anchors in several rows, and of those in more than ``hot_rows``."""

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(_bucket_of(keys, buckets), np.arange(buckets + 1))
            spans = [(b, cuts[b], cuts[b + 1]) for b in range(buckets) if cuts[b] < cuts[b + 1]]
            six = keys.view(np.uint8).reshape(-1, 8)[:, 2:]
            # Counts above one are few: they are sent as places and values.
            more = [np.flatnonzero(counts[i:j] > 1).astype(np.uint32) for _, i, j in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in spans], pa.int32()),
                    pa.array([six[i:j].tobytes() for _, i, j in spans], pa.binary()),
                    pa.array([m.tobytes() for m in more], pa.binary()),
                    pa.array([counts[i:j][m].astype(np.uint32).tobytes() for (_, i, j), m in zip(spans, more, strict=True)], pa.binary()),
                ],
                ["bucket", "keys", "at", "more"],
            )

        for data, lengths, _ in _pieces(batches):
            _, _, _, keys, owner = find_entries(data, lengths)
            keys = keys & _KEPT
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            once = np.ones(len(keys), bool)  # a row counts once per anchor
            once[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            held.append(keys[once])
            size += len(data)
            if size >= RUN_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    size = bits // buckets

    def fill(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for k, at, more in zip(*(table.column(c).to_pylist() for c in ("keys", "at", "more")), strict=True):
            six = np.frombuffer(k, np.uint8).reshape(-1, 6)
            eight = np.zeros((len(six), 8), np.uint8)
            eight[:, 2:] = six
            n = np.ones(len(six), np.int64)
            n[np.frombuffer(at, np.uint32)] = np.frombuffer(more, np.uint32)
            keys.append(eight.view(_U)[:, 0])
            counts.append(n)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        bucket = table.column("bucket")[0].as_py()
        out = {"bucket": pa.array([bucket], pa.int32())}
        for name, least in (("shared", 1), ("hot", hot_rows)):
            segment = np.zeros(size, bool)
            for place in _bits_of(keys[counts > least], buckets, bits):
                segment[place - bucket * size] = True
            packed = np.packbits(segment).tobytes() if segment.any() else b""
            out[name] = pa.array([packed], pa.binary())
        return pa.table(out)

    found = rows.mapInArrow(runs, "bucket int, keys binary, at binary, more binary")
    found = found.groupBy("bucket").applyInArrow(fill, "bucket int, shared binary, hot binary")
    filters = np.zeros((2, bits // 8), np.uint8)
    for bucket, *parts in found.collect():  # bits / 8 bytes for each filter
        for own, part in zip(filters, parts, strict=True):
            if part:
                own[bucket * size // 8 : (bucket + 1) * size // 8] = np.frombuffer(part, np.uint8)
    return filters[0], filters[1]


def _packed(values: np.ndarray | bytes) -> bytes:
    data = values if isinstance(values, bytes) else values.tobytes()
    return len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kind=None):
    data = pa.decompress(blob[4:], int.from_bytes(blob[:4], "little"), codec="zstd", asbytes=True)
    return data if kind is None else np.frombuffer(data, kind)


def front_code(entries: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted entries as common prefix lengths, rest lengths and compressed rests."""
    sizes = np.array([len(e) for e in entries])
    wide = np.frombuffer(b"".join(e.ljust(128, b"\0") for e in entries), np.uint8).reshape(-1, 128)
    differ = wide[1:] != wide[:-1]
    common = np.where(differ.any(1), differ.argmax(1), 128)
    common = np.concatenate(([0], np.minimum(np.minimum(common, sizes[1:]), sizes[:-1])))
    rests = b"".join(e[c:] for e, c in zip(entries, common.tolist(), strict=True))
    return _packed(common.astype(np.uint8)), _packed((sizes - common).astype(np.uint8)), _packed(rests)


def decode(common: bytes, sizes: bytes, packed: bytes) -> Iterator[tuple[bytes, int]]:
    """Entries of a run, each with the length it has in common with the one before."""
    rests = _unpacked(packed)
    entry, at = b"", 0
    for c, n in zip(_unpacked(common), _unpacked(sizes), strict=True):
        entry = entry[:c] + rests[at : at + n]
        at += n
        yield entry, c


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """Entries of sorted runs in order: the entry, its run, what it has in common with the last.

    A loser tree: each inner node keeps the loser of its match. ``lcp[r]`` is how much
    the head of run r has in common with the entry taken last, so of two heads the one with
    more in common is the smaller, and heads with as much are compared behind that.
    """
    width = 1
    while width < len(runs):
        width *= 2
    heads: list[bytes | None] = [None] * width
    lcp = [0] * width
    for r, run in enumerate(runs):
        heads[r], lcp[r] = next(run, (None, 0))

    def beats(a: int, b: int) -> bool:
        """Whether a's head comes first; the loser's prefix is then in common with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None
        if lcp[a] != lcp[b]:
            return lcp[a] > lcp[b]
        if x == y:
            lcp[b] = len(x)
            return True
        i, end = lcp[a], min(len(x), len(y))
        while i < end and x[i] == y[i]:
            i += 1
        first = i == len(x) or (i < len(y) and x[i] < y[i])
        lcp[b if first else a] = i
        return first

    losers = [0] * width

    def build(node: int) -> int:
        if node >= width:
            return node - width
        a, b = build(2 * node), build(2 * node + 1)
        win, losers[node] = (a, b) if beats(a, b) else (b, a)
        return win

    win = build(1)
    while heads[win] is not None:
        yield heads[win], win, lcp[win]
        heads[win], lcp[win] = next(runs[win], (None, 0))
        node = (win + width) // 2
        while node:
            if not beats(win, losers[node]):
                win, losers[node] = losers[node], win
            node //= 2


Entry = tuple[bytes, list[tuple[int, int, int, int]]]


def _answers(group: list[Entry]) -> Iterator[tuple[int, int, int, int, int]]:
    """``(run, place, first window, last window, least id)`` where a run has a larger id than the least.

    ``group`` holds all entries of one anchor: each with ``(run, place, least, largest)``.
    """
    if len(group) == 1:
        entry, holders = group[0]
        least = min(h[2] for h in holders)
        last = len(entry) - 1 - LENGTH
        for run, place, _, largest in holders:
            if largest > least:
                yield run, place, 0, last, least
        return
    # Equal windows have their anchor at the same place: one place after the other is looked at.
    # The last byte of an entry tells how much of it stands left of the anchor.
    least = [min(h[2] for h in holders) for _, holders in group]
    ids = [array("q", bytes(8 * (len(entry) - LENGTH))) for entry, _ in group]
    for left in range(SPAN):
        owner: dict[bytes, int] = {}
        at = []
        for k, (entry, _) in enumerate(group):
            i = entry[-1] - left
            if 0 <= i < len(ids[k]):
                window = entry[len(entry) - 1 - left : -1] + entry[: LENGTH - left]
                at.append((k, i, window))
                if owner.get(window, least[k]) >= least[k]:
                    owner[window] = least[k]
        for k, i, window in at:
            ids[k][i] = owner[window]
    for own, (_, holders) in zip(ids, group, strict=True):
        start = 0
        for i in range(1, len(own) + 1):
            if i == len(own) or own[i] != own[start]:
                for run, place, _, largest in holders:
                    if largest > own[start]:
                        yield run, place, start, i - 1, own[start]
                start = i


_COLUMNS = ["bucket", "common", "sizes", "rests", "counts", "rows", "starts", "docs", "keys"]
_KINDS = [pa.int32(), *[pa.binary()] * 8]
RUN_SCHEMA = "bucket int, " + ", ".join(f"{c} binary" for c in _COLUMNS[1:])


class _Run:
    """Entries of one run by bucket, and the rows they stand in."""

    def __init__(self, buckets: int) -> None:
        self.entries: list[dict[bytes, list[int]]] = [{} for _ in range(buckets)]
        self.row, self.start = array("q"), array("q")  # of each occurrence
        self.docs: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.n_rows = self.size = 0

    def add(self, data: np.ndarray, found: tuple[np.ndarray, ...], alone: np.ndarray, lengths: np.ndarray, part: pa.RecordBatch) -> None:
        first, last, anchor, hashes, owner = found
        buckets, base, raw = len(self.entries), len(self.row), data.tobytes()
        self.row.extend((owner + self.n_rows).tolist())
        self.start.extend((first - (np.cumsum(lengths) - lengths)[owner]).tolist())
        where = _bucket_of(hashes, buckets).tolist()
        spots = zip(first.tolist(), last.tolist(), anchor.tolist(), where, alone.tolist(), strict=True)
        for i, (s, e, p, b, w) in enumerate(spots, base):
            entry = raw[p : e + LENGTH] + raw[s:p] + bytes((p - s,))
            if w:
                b = int(_bucket_of(np.array([hash_bytes(entry)], _U), buckets)[0])
            self.entries[b].setdefault(entry, []).append(i)
        self.docs.append(part.column("id").to_numpy())
        self.keys.append(part.column("key").to_numpy())
        self.n_rows += part.num_rows
        self.size += len(data)

    def batch(self) -> pa.RecordBatch:
        """One row per bucket: its entries, and the rows and places they occur at."""
        row, start = np.array(self.row, np.int64), np.array(self.start, np.int64)
        docs, keys = np.concatenate(self.docs), np.concatenate(self.keys)
        lines = []
        for b, entries in enumerate(self.entries):
            if not entries:
                continue
            order = sorted(entries)
            places = [entries[e] for e in order]
            counts = np.array([len(p) for p in places], np.uint32)
            flat = np.fromiter((i for p in places for i in p), np.int64, int(counts.sum()))
            used, rows = np.unique(row[flat], return_inverse=True)
            numbers = (counts, rows.astype(np.uint32), start[flat].astype(np.uint32), docs[used], keys[used])
            lines.append((b, *front_code(order), *map(_packed, numbers)))
        columns = zip(*lines, strict=True) if lines else [[] for _ in _COLUMNS]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _COLUMNS)


def _write_runs(rows: DataFrame, filters, buckets: int) -> DataFrame:
    """Sorted runs of the entries of shared anchors: one row per run and bucket."""

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, hot = filters.value
        run = _Run(buckets)
        for data, lengths, part in _pieces(batches):
            found = find_entries(data, lengths)
            keep = np.flatnonzero(_in_filter(shared, found[3], buckets))
            first, last, anchor, hashes, owner = (x[keep] for x in found)
            alone = np.zeros(len(first), bool)
            if hot is not None:
                # Entries of hot anchors are cut into their windows.
                alone = _in_filter(hot, hashes, buckets)
                n = np.where(alone, last - first + 1, 1)
                again = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
                first, last, anchor, hashes, owner, alone = (x[again] for x in (first, last, anchor, hashes, owner, alone))
                first = first + step
                last = np.where(alone, first, last)
            run.add(data, (first, last, anchor, hashes, owner), alone, lengths, part)
            if run.size >= RUN_BYTES:
                yield run.batch()
                run = _Run(buckets)
        if run.size:
            yield run.batch()

    return rows.mapInArrow(runs, RUN_SCHEMA)


def hash_bytes(entry: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(entry, 11)


def _merge_bucket(table: pa.Table) -> pa.Table:
    """Runs of one bucket to merged byte ranges (start << 32 | end) of their rows."""
    lines = table.to_pylist()
    counts = [_unpacked(x["counts"], np.uint32).astype(np.int64) for x in lines]
    heads = [np.cumsum(n) - n for n in counts]
    rows = [_unpacked(x["rows"], np.uint32).astype(np.int64) for x in lines]
    docs = [_unpacked(x["docs"], np.int64) for x in lines]
    ids = [d[r] for d, r in zip(docs, rows, strict=True)]
    low, high = ([f.reduceat(i, h).tolist() for i, h in zip(ids, heads, strict=True)] for f in (np.minimum, np.maximum))
    place = [-1] * len(lines)
    out: list[array] = [array("q") for _ in lines]
    group: list[Entry] = []

    def close() -> None:
        for run, at, i, j, doc in _answers(group):
            out[run].extend((at, i, j, doc))
        group.clear()

    for entry, run, known in merge_runs([decode(x["common"], x["sizes"], x["rests"]) for x in lines]):
        at = place[run] = place[run] + 1
        holder = (run, at, low[run][at], high[run][at])
        if group and known == len(entry) == len(group[-1][0]):
            group[-1][1].append(holder)
        else:
            if known < GRAM:
                close()
            group.append((entry, [holder]))
    close()
    made = [pa.table({"id": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "spans": pa.array([], pa.list_(pa.int64()))})]
    for run, line in enumerate(lines):
        if not out[run]:
            continue
        at, first, last, doc = np.array(out[run], np.int64).reshape(-1, 4).T
        n = counts[run][at]
        again = np.repeat(np.arange(len(at)), n)
        spot = heads[run][at][again] + np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
        cut = ids[run][spot] > doc[again]
        spot, again = spot[cut], again[cut]
        row, start = rows[run][spot], _unpacked(line["starts"], np.uint32).astype(np.int64)[spot]
        row, spans, cuts = _merged(row, start + first[again], start + last[again] + LENGTH)
        keys = _unpacked(line["keys"], np.int64)
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(spans, pa.int64()))
        made.append(pa.table({"id": pa.array(docs[run][row]), "key": pa.array(keys[row]), "spans": lists}))
    return pa.concat_tables(made)


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping ranges of each row made one: the rows, ``start << 32 | end``, and where each row's begin."""
    # Rows follow each other on one line, so all of them are merged at once.
    order = np.argsort((row << 32) + start, kind="stable")
    start = ((row << 32) + start)[order]
    end = np.maximum.accumulate(((row << 32) + end)[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(end) - 1]))
    start, end = start[new], end[last]
    rows, heads = np.unique(start >> 32, return_index=True)
    spans = ((start & 0xFFFFFFFF) << 32) | (end & 0xFFFFFFFF)
    return rows, spans, np.concatenate((heads, [len(spans)]))


def cut_text(data: bytes, spans: list[int] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of ``data`` without the ranges, and the maximal removed runs."""
    removed: list[tuple[int, int]] = []
    for x in sorted(spans or []):
        start, end = x >> 32, x & 0xFFFFFFFF
        if removed and start <= removed[-1][1]:
            removed[-1] = (removed[-1][0], max(end, removed[-1][1]))
        else:
            removed.append((start, end))
    out, at = [], 0
    for start, end in removed:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]]), removed


def remove_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = FILTER_BITS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``kept`` (bytes that stay) and ``removed`` (byte ranges) of every row."""
    ship(docs)
    spark = docs.sparkSession
    buckets = 1 << max(5, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length() - 1)
    buckets = min(buckets, bits // 512)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole(text)).alias("key"), whole(text).alias("text"))
    shared, hot = shared_anchors(rows.select("id", "text"), buckets, bits, hot_rows)
    filters = spark.sparkContext.broadcast((shared, hot if hot.any() else None))
    runs = _write_runs(rows, filters, buckets)
    spans = runs.groupBy("bucket").applyInArrow(_merge_bucket, "id long, key long, spans array<long>")
    # A text has ranges from many buckets; equal rows may stand in several runs.
    spans = spans.groupBy("id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    @arrow_udf("struct<kept:binary,removed:array<struct<start:int,end:int>>>")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        each = [cut_text(t.as_py().encode(), r.as_py()) for t, r in zip(texts, ranges, strict=True)]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        removed = [[{"start": s, "end": e} for s, e in x] for _, x in each]
        return pa.StructArray.from_arrays([pa.array([k for k, _ in each], pa.binary()), pa.array(removed, kind)], ["kept", "removed"])

    out = rows.join(spans, ["id", "key"], "left").select(
        F.col("id").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), cut("text", "spans").alias("c")
    )
    return out.select("doc_id", "n_bytes", "c.kept", "c.removed")
