"""Token files: exact round trips of planes, files and tables."""

import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caselight.llm import token_file

VOCABULARY = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=80), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, kind):
    ids = np.array(ids, dtype="<u4")
    assert token_file.unshuffle(token_file.shuffle(ids, kind), kind, len(ids)).tolist() == ids.tolist()


class Held(io.BytesIO):
    def size(self):
        return len(self.getbuffer())

    def close(self):
        pass


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_file_round_trip_over_chunk_borders(planes):
    rng = np.random.default_rng(1)
    documents = [(k, rng.integers(0, 50_000, n).astype("<u4")) for k, n in [(None, 3), (-5, 0), (7, 100), (7, 1), (2**40, 64)]]
    out = Held()
    writer = token_file.Writer(out, planes, block=16)
    for key, ids in documents:
        writer.add(key, ids.tobytes())
    writer.close()
    reader = token_file.Reader(out)
    assert [(k, n, c) for k, _, n, c in reader.each()] == [(k, len(i), zlib.crc32(i.tobytes())) for k, i in documents]
    everything = np.concatenate([i for _, i in documents])
    assert reader.ids(0, 10**6).tolist() == everything.tolist()
    assert reader.ids(15, 20).tolist() == everything[15:35].tolist()


def test_empty_file():
    out = Held()
    token_file.Writer(out).close()
    assert list(token_file.Reader(out).each()) == []


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_table_round_trip(spark, planes):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {9: None, 3: "", 12: "Hello there\n\n x", 1: "word " * 4000, 2: "é😀"}
    rows = [(k, t, 0) for k, t in texts.items()] + [(3, "again", 1), (None, "no id", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, part int")
    manifest = token_file.write_token_files(table, VOCABULARY, P.PATTERN, planes=planes, block=512)
    found = sorted(token_file.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 3, 9, 12]
    start, stream = 0, []
    for r in found:
        options = [library.encode(t or "", add_special_tokens=False).ids + [0] for k, t, _ in rows if k == r.doc_id]
        ids = next(o for o in options if zlib.crc32(np.array(o, "<u4").tobytes()) == r.ids_crc32)
        assert (r.start, r.n_tokens) == (start, len(ids))
        start, stream = start + len(ids), stream + ids
    assert token_file.read_range(spark, manifest, 5, 3000) == stream[5:3005]


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert token_file.read_token_files(token_file.write_token_files(table, VOCABULARY, P.PATTERN)).count() == 0
