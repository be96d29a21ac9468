"""The manifest against a plain recomputation of the tree by loops over hashlib."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from caselight.llm import merkle_manifest as mm
from caselight.llm.queries import QUERIES

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, idx int, hash string, steps string"


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: dict, text=None) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] if text is None else text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes: list[str]) -> tuple[str, list[list[list[str]]]]:
    """Top digest and the runs of every level."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        levels.append(runs)
        nodes = [H("".join(r)) for r in runs]
    return nodes[0], levels


def path(levels, place: int) -> list[tuple[list[str], int]]:
    out = []
    for runs in levels:
        out.append((runs[place // 16], place % 16))
        place //= 16
    return out


def plain(rows: list[dict]) -> dict:
    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    sub, paths = {}, {}
    for s in order:
        members = sorted(by_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        top, levels = tree([leaf(r) for r in members])
        sub[s] = top
        for i, r in enumerate(members):
            paths[id(r)] = path(levels, i)
    root, top_levels = tree([sub[s] for s in order])
    out = {}
    for r in rows:
        steps = paths[id(r)] + path(top_levels, order.index(r["source"]))
        proof = H("".join("".join(run[:k] + run[k + 1 :]) for run, k in steps))
        touched = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        now = leaf(r, r["text"].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if touched and r["text"] is not None else None)
        for run, k in steps:
            now = H("".join(run[:k] + [now] + run[k + 1 :]))
        out[r["doc_id"], leaf(r)] = (leaf(r), sub[r["source"]], root, proof, now, now == root)
    return out


def rows_of_fixture() -> list[dict]:
    rows = []
    # A hot source with three levels, a source of one row, a null source, repeats, null fields and empty texts.
    for i in range(300):
        rows.append({"doc_id": i, "source": "hot", "lang": "en", "n_chars": 5, "text": f"Word {i} ÄB"})
    rows.append({"doc_id": 1000, "source": "alone", "lang": None, "n_chars": None, "text": "Only One"})
    for i in range(20):
        rows.append({"doc_id": 2000 + i, "source": None, "lang": "de", "n_chars": 0, "text": "" if i % 2 else None})
    rows.append(dict(rows[3]))
    rows.append({"doc_id": None, "source": "hot", "lang": "en", "n_chars": 1, "text": "X" * 100_000})
    rows.append({"doc_id": 3000, "source": "Zed", "lang": "en", "n_chars": 2, "text": "HI"})
    rows.append({"doc_id": 3001, "source": "é", "lang": "en", "n_chars": 2, "text": "Ho"})
    return rows


def test_against_plain_loops(spark, tmp_path):
    rows = rows_of_fixture()
    frame = spark.createDataFrame([{**r, "idx": 7, "hash": "x", "steps": "y"} for r in rows], SCHEMA)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    want = plain(rows)
    assert len(got) == len(rows)
    for g in got:
        assert (g.leaf, g.subroot, g.root, g.proof_sha256, g.folded_root, g.verified) == want[g.doc_id, g.leaf]
    assert {g.verified for g in got} == {True, False}


def test_single_row_and_empty_table(spark, tmp_path):
    one = [{"doc_id": 1, "source": "a", "lang": "en", "n_chars": 1, "text": "a"}]
    spark.createDataFrame(one, SCHEMA.rsplit(", idx", 1)[0]).write.parquet(str(tmp_path / "one/documents.parquet"))
    got = QUERIES["op11_merkle_manifest"](spark, str(tmp_path / "one")).collect()
    assert [(g.leaf, g.subroot, g.root, g.proof_sha256, g.verified) for g in got] == [(leaf(one[0]),) * 3 + (H(""), True)]
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert QUERIES["op11_merkle_manifest"](spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("height", [1, 2, 3, 4, 5])
def test_layout_addresses_fill_a_complete_tree(height):
    fan = 4
    seen = [mm.veb_address(d, j, height, fan) for d in range(height) for j in range(fan**d)]
    assert sorted(seen) == list(range(len(seen)))
    # The top half is stored first, and every bottom subtree is one contiguous range.
    if height > 1:
        top = height // 2
        assert max(mm.veb_address(d, j, height, fan) for d in range(top) for j in range(fan**d)) == (fan**top - 1) // (fan - 1) - 1


def test_sql_address_equals_arithmetic(spark):
    h, d = 5, 3
    frame = spark.range(16**d).select(F.expr(mm.veb_sql(d, h, "id")).alias("a"), "id")
    assert all(r.a == mm.veb_address(d, r.id, h) for r in frame.collect())
