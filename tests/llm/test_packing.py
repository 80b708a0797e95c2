"""Packing: exact round trip of ids, gapless sequences, little padding."""

from __future__ import annotations

import struct
from collections import defaultdict

import public_tokenizers
import pytest
from llm.helpers import DOCS, documents, texts
from tokenizers import Tokenizer

from folioflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def unpack(ids: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


@pytest.mark.parametrize("blocks", [1 << 20, 3000])
def test_round_trip(spark, monkeypatch, blocks):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", blocks)
    values = [*texts(8, 80), "don't it's <|endoftext|> x", "é Å　ệ ̸", "A B\x1cC\x85D"]
    tokenizer = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for i, t in enumerate(values):
        want[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)] += 1
    want[None, tuple(tokenizer.encode("text without id", add_special_tokens=False).ids) + (1,)] += 1
    want[None, (1,)] += 1
    want[0, tuple(tokenizer.encode(values[0], add_special_tokens=False).ids) + (1,)] += 2
    rows = packing.pack(documents(spark, values, extra=True), PATH).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4 > 0
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append((r.start, unpack(r.ids)))
    padding = 0
    for seq in sequences.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == seq[0].sequence_tokens <= seq[0].context <= 2048
        assert seq[0].context in (at, 2048)
        padding += seq[0].context - at
    assert padding <= 3 * 2048  # one sequence in each of three partitions
    tokens = defaultdict(int)
    for (doc, ids), n in want.items():
        tokens[doc, len(ids)] += n * len(ids)
    assert {k: sum(len(ids) for _, ids in v) for k, v in pieces.items()} == dict(tokens)
    for (doc, ids), n in want.items():
        if doc is not None:
            seen = defaultdict(int)
            for start, part in pieces[doc, len(ids)]:
                assert tuple(part) == ids[start : start + len(part)]
                for k in range(start, start + len(part)):
                    seen[k] += 1
            assert seen == {k: n for k in range(len(ids))}


def test_short_documents_fill_their_tiers():
    packer = packing.Packer()
    for i in range(100):
        packer.add(i, b"\x01\0\0\0" * (100 + i))
    out = packer.block(last=True)
    sizes = sorted(sum(len(p[2]) // 4 for p in s) for s in out)
    assert sum(sizes) == sum(100 + i for i in range(100))
    assert sum(1 for s in sizes if s & (s - 1)) <= 1


def test_step_groups_cost_about_the_same():
    sequences = [[(i, 0, b"x" * 4 * n, n)] for i, n in enumerate([2048] * 40 + [128] * 88)]
    groups = packing.step_groups(sequences, step=32)
    cost = [sum(len(s[0][2]) ** 2 for s, g in zip(sequences, groups, strict=True) if g == k) for k in range(4)]
    assert sorted(set(groups)) == [0, 1, 2, 3] and max(cost) < 1.02 * min(cost)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], DOCS), PATH, context=1000)


def test_short_pieces_do_not_wait_for_the_end():
    packer = packing.Packer()
    for i in range(20_000):
        packer.add(i, b"\x01\0\0\0" * (1 + i % 32))
    out = packer.block()
    assert sum(n for n, _, _ in packer.pool) < packing.CONTEXT
    filled = sum(len(p[2]) // 4 for s in [*out, *packer.block(last=True)] for p in s)
    assert filled == sum(1 + i % 32 for i in range(20_000))
