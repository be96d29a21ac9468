"""Packing against a plain best-fit-decreasing loop, and the pieces against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caselight.llm import packing

VOCABULARY = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, g in enumerate(gaps) if g >= length]
        if fitting:
            best = min(fitting, key=lambda i: gaps[i])
            gaps[best] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_sweep_uses_as_many_sequences_as_the_plain_loop(lengths):
    kinds = sorted(set(lengths))
    runs = packing.sweep(kinds, [lengths.count(k) for k in kinds], 40)
    placed = {}
    for length, rank, count, first, offset in runs:
        for i in range(count):
            placed.setdefault(first + i, []).append((offset, length))
    assert sum(r[2] for r in runs) == len(lengths)
    for spans in placed.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 40
    assert len(placed) == best_fit_decreasing(lengths, 40)


def check(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("per_shard", [50, 10**6])
def test_packs_a_hot_length_over_shards_and_blocks(spark, per_shard):
    rng = random.Random(3)
    lengths = [rng.choice([7, 7, 7, rng.randint(1, 100)]) for _ in range(600)]
    rows = [(i // 2, i % 2, n, 5) for i, n in enumerate(lengths)]  # ids repeat, a foreign column clashes
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, shard int")
    found = packing.pack(pieces.drop("shard"), capacity=100, rows_per_shard=per_shard).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in found) == sorted(r[:3] for r in rows)
    used = check(found, 100)
    assert used <= best_fit_decreasing(lengths, 100) + (0 if per_shard > 600 else 12)


def test_token_pieces(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [None, "", "Hello there", "word " * 40, "a" * 900]
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, piece int")
    pieces = packing.token_pieces(rows, VOCABULARY, P.PATTERN, capacity=16, with_ids=True)
    packed = packing.pack(pieces, capacity=16)
    found = packed.collect()
    check(found, 16)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in found if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 16 for r in own[1:]) and own[0].start == 0
        assert sum((np.frombuffer(r.ids, "<u4").tolist() for r in own), []) == ids
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in own)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) // 4 for r in whole) == sum(r.length for r in found)
    assert packing.pack(pieces.limit(0), capacity=16).count() == 0
