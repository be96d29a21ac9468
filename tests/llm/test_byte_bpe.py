"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caselight.llm import byte_bpe

RANKS = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
MODEL = byte_bpe.model_from_ranks(RANKS)
BPE = byte_bpe.ByteBPE(MODEL, P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(BPE.encode(text), dtype="<u4").tolist()


BITS = st.sampled_from([" ", "  ", "\n", "\t", "a", "the", "é", "中文", "😀", "12", "!", "'s", "　", "\x1c", "\r\n", "<|endoftext|>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(BITS, max_size=20).map("".join))
def test_encodes_as_the_reference_library(text):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    assert ids(text) == known.encode_ordinary(text)
    assert BPE.decode(BPE.encode(text)) == text


def test_long_text_without_spaces(reference):
    text = "ab1" * 20_000
    assert ids(text) == reference.encode_ordinary(text)


def test_offsets_cover_split_characters():
    text = "a 𓂀!"
    spans = BPE.offsets(text, BPE.encode(text))
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(0 <= a < b <= len(text) for a, b in spans)
    assert BPE.decode(BPE.encode(text)[:4]) == "a"


def test_table_with_nulls_copies_and_extra_columns(spark, reference):
    texts = [None, "", "the the", "the the", "x" * 5000 + " é", "日本語"]
    rows = spark.createDataFrame([(i, t, i, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int, key int")
    got = {r.doc_id: r for r in byte_bpe.round_trip_digests(rows, MODEL, P.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = reference.encode_ordinary(t or "")
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    encoded = byte_bpe.encode_texts(rows, MODEL, P.PATTERN, with_offsets=True)
    decoded = byte_bpe.decode_ids(encoded, MODEL, P.PATTERN)
    assert {r.doc_id: r.text for r in decoded.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert byte_bpe.round_trip_digests(rows.filter(F.lit(False)), MODEL, P.PATTERN).count() == 0
