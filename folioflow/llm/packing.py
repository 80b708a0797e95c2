"""Hierarchical packing of tokenised documents into sequences of several context sizes.

Each partition packs its own documents in blocks of about ``BLOCK_TOKENS``, so nothing is
shuffled, memory does not depend on the partition, and a lost task repeats one partition.
A document gives full windows of the longest context; its rest goes to the tier of the
smallest context that holds it. Windows of the longest tier are filled first, with the
largest shorter rest that fits and a cut one at the end; what short rests are left fills
windows of their own tiers the same way. Only exactly full windows may be shorter than
the longest context, so a partition pads one sequence at most. The sequences of a block are
dealt to step groups in turns by their attention cost, so that steps cost about the same.

Defined results: a null or empty text is one closing token; repeated rows and ids are
packed as often as they occur; a word of any length is tokenised whole; an empty table gives
no rows. Only ``doc_id`` and ``text`` are read, other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import ship, slices

CONTEXT, TIERS, CLOSE = 2048, (1024, 512, 256, 128, 64), 1
STEP = 32
BLOCK_TOKENS, SLICE_BYTES = 1 << 20, 4 << 20
#: Words whose ids a worker remembers, and the longest of them.
MAX_CACHE, MAX_WORD = 1_000_000, 64
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, context long, step_group long"
)
#: (doc_id, start, ids as little-endian bytes, tokens of the document)
Piece = tuple[int | None, int, bytes, int]


class WordTokenizer:
    """Ids by word: this tokenizer drops white space and case, so ids of words join to ids of the text.

    A word that ends in one comma or full stop after a letter has the ids of both parts. New
    words are encoded many at once, with a token between them that no text here holds.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = next(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special)
        self.mark = self.tokenizer.token_to_id(self.between)
        self.cache: dict[bytes, bytes] = {b"": b""}
        self.ends = {end: self._ids(end.decode()) for end in (b",", b".")}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes."""
        if len(self.cache) > MAX_CACHE:
            self.cache = {b"": b""}
        raw = [t.encode() for t in texts]
        # Special tokens are told by their case, so texts that may hold one are encoded whole.
        split = [[] if b"<|" in t else t.lower().replace(b"\n", b" ").split(b" ") for t in raw]
        words = list(chain.from_iterable(split))
        ids = list(map(self.cache.get, words))
        gaps = [i for i, x in enumerate(ids) if x is None]
        once = self._learn({words[i] for i in gaps})
        for i in gaps:
            w = words[i]
            ids[i] = self.cache[w] if w in self.cache else once[w]
        out, at = [], 0
        for text, t, own in zip(texts, raw, split, strict=True):
            out.append(self._ids(text) if b"<|" in t else b"".join(ids[at : at + len(own)]))
            at += len(own)
        return out

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """Remember the ids of new words; those too long to keep are returned."""
        ended = [w for w in new if w[-1:] in self.ends and b"a" <= w[-2:-1] <= b"z"]
        stems = list((new.difference(ended) | {w[:-1] for w in ended}).difference(self.cache))
        once: dict[bytes, bytes] = {}
        for at in range(0, len(stems), 64 * 256):
            parts = [stems[k : k + 256] for k in range(at, min(len(stems), at + 64 * 256), 256)]
            joined = [self.between.encode().join(p).decode() for p in parts]
            for part, made in zip(parts, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(made.ids, "<u4")
                cuts, flat = (4 * np.flatnonzero(ids == self.mark)).tolist(), ids.tobytes()
                for w, s, e in zip(part, [0, *(c + 4 for c in cuts)], [*cuts, len(flat)], strict=True):
                    (self.cache if len(w) <= MAX_WORD else once)[w] = flat[s:e]
        for w in ended:
            stem = self.cache[w[:-1]] if w[:-1] in self.cache else once[w[:-1]]
            (self.cache if len(w) <= MAX_WORD else once)[w] = stem + self.ends[w[-1:]]
        return once


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer per worker process; its cache serves all tasks there."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Packs pieces; ``blocks`` of sequences come out, each a list of pieces."""

    def __init__(self, context: int = CONTEXT, tiers: tuple[int, ...] = TIERS) -> None:
        self.context, self.tiers = context, tuple(sorted(tiers, reverse=True))
        self.full: list[list[Piece]] = []
        self.pool: list[tuple[int, int, Piece]] = []  # by tokens, then by arrival
        self.arrived = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        whole = n - n % self.context
        for s in range(0, whole, self.context):
            self.full.append([(doc_id, s, ids[4 * s : 4 * (s + self.context)], n)])
        if whole < n:
            self._put((doc_id, whole, ids[4 * whole :], n))
        self.tokens += n

    def _put(self, piece: Piece) -> None:
        self.arrived += 1
        insort(self.pool, (len(piece[2]) // 4, self.arrived, piece))

    def _fill(self, size: int) -> list[Piece]:
        """One window of ``size`` from the pool, which holds as much at least."""
        window, gap = [], size
        while gap:
            at = bisect_right(self.pool, (gap, self.arrived + 1)) - 1
            n, _, piece = self.pool.pop(max(at, 0))
            if n > gap:  # nothing is short enough: cut the shortest
                doc_id, start, ids, total = piece
                self._put((doc_id, start + gap, ids[4 * gap :], total))
                n, piece = gap, (doc_id, start, ids[: 4 * gap], total)
            window.append(piece)
            gap -= n
        return window

    def block(self, last: bool = False) -> list[list[Piece]]:
        """Sequences from what has come; a rest shorter than one context waits, unless it is the last."""
        out, self.full = self.full, []
        left = sum(n for n, _, _ in self.pool)
        # Rests of the longest tier each open a window; short rests fill the gaps.
        while left >= self.context and self.pool[-1][0] > self.context // 2:
            out.append(self._fill(self.context))
            left -= self.context
        for size in self.tiers:
            # Short rests that no gap was left for: windows of their own tier, none above its need.
            while left >= self.context and self.pool[-1][0] > size // 2:
                out.append(self._fill(size))
                left -= size
        while left >= self.context:  # pieces far below the smallest tier: they do not wait either
            size = min(self.tiers, default=self.context)
            out.append(self._fill(size))
            left -= size
        if last:
            for size in self.tiers:
                while left >= size:
                    out.append(self._fill(size))
                    left -= size
            if left:
                out.append([p for _, _, p in self.pool])
                self.pool = []
        self.tokens = 0
        return out


def step_groups(sequences: list[list[Piece]], step: int = STEP) -> list[int]:
    """A group for each sequence: dealt back and forth in order of attention cost."""
    groups = max(1, round(len(sequences) / step))
    cost = [sum(len(p[2]) ** 2 for p in s) for s in sequences]
    out = [0] * len(sequences)
    for place, i in enumerate(sorted(range(len(sequences)), key=lambda i: (-cost[i], i))):
        turn, spot = divmod(place, groups)
        out[i] = groups - 1 - spot if turn % 2 else spot
    return out


def _rows(sequences: list[list[Piece]], first: int, first_group: int, context: int) -> Iterator[pa.RecordBatch]:
    groups = step_groups(sequences)
    columns: list[list] = [[] for _ in range(10)]
    for k, sequence in enumerate(sequences):
        filled = sum(len(p[2]) for p in sequence) // 4
        size = filled if filled & (filled - 1) == 0 else context
        offset = 0
        for doc_id, start, ids, total in sequence:
            n = len(ids) // 4
            row = (doc_id, start, n, ids, total, first + k, offset, filled, size, first_group + groups[k])
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += n
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 6]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
    yield from slices(batch, "ids", SLICE_BYTES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    context: int = CONTEXT,
    tiers: tuple[int, ...] = TIERS,
    close: int = CLOSE,
) -> DataFrame:
    """One row per piece with its ids. Sequence and group ids hold the partition in their upper bits."""
    if any(t & (t - 1) for t in (context, *tiers)):
        raise ValueError("contexts are powers of two: other lengths would be padded")
    ship(docs)
    end = close.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        here = (task.partitionId() if task else 0) << 33
        made = groups = 0
        packer, encode = Packer(context, tiers), tokenizer_at(tokenizer).encode

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made, groups
            if sequences := packer.block(last):
                yield from _rows(sequences, here + made, here + groups, context)
                made += len(sequences)
                groups += max(1, round(len(sequences) / STEP))

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for key, ids in zip(part.column("doc_id").to_pylist(), encode(texts), strict=True):
                    packer.add(key, ids + end)
                    if packer.tokens >= BLOCK_TOKENS:
                        yield from flush(False)
        yield from flush(True)

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, SCHEMA)
