"""The chosen-path join against comparing all pairs."""

import random
import re

import numpy as np
import pytest

from caselight.llm import minhash_dedup as M
from caselight.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n int, cls string"


def shingle_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def brute(rows):
    """(doc_id, n, component) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((k, len(s), least.get(root(i)) if k is not None else None) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def found(frame, **settings):
    got = M.near_duplicates(frame, **settings).collect()
    assert all(r.kept == (None if r.doc_id is None else r.doc_id == r.component_id) for r in got)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


def edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words]


def corpus(seed=5):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    passage = text(60)
    rows = []
    for _ in range(25):  # groups of near copies, many of them close to the border
        base = text(rng.randrange(20, 160))
        rows += [edited(rng, base, share) for share in (0, 0.01, 0.02, 0.03, 0.05, 0.06)]
    base = text(120)
    rows += [edited(rng, base, 0.03) for _ in range(80)]  # one large group
    rows += [text(60) + passage + text(60) for _ in range(60)]  # a passage that many share
    rows += [["alone"]] * 5 + [["a", "b", "c"]] * 2 + [["a", "b"]]
    return [" ".join(r) for r in rows]


@pytest.mark.parametrize("node_rows", [2048, 16])
def test_equals_comparing_all_pairs(spark, node_rows):
    texts = corpus()
    rows = [(i + 10, t) for i, t in enumerate(texts)]
    rows += [(3, rows[7][1].upper()), (4, None), (5, ""), (6, " \t\n "), (7, "É é É é É"), (8, "é é é é é"), (9, "x" * 50_000), (9, rows[9][1]), (None, rows[0][1])]
    frame = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], SCHEMA)
    assert found(frame, node_rows=node_rows) == brute(rows)


def test_group_of_many_near_copies_is_one_component(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(900)}" for _ in range(300)]
    rows = []
    for i in range(1500):
        words = list(base)
        words[rng.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(words), 0, ""))
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA), node_rows=100).collect()
    assert {r.component_id for r in got} == {0}


def test_branching_finds_pairs_in_a_crowded_node():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 256, M.COORDINATES, dtype=np.uint8)
    sketch = np.where(rng.random((800, M.COORDINATES)) < 0.4, shared, rng.integers(0, 256, (800, M.COORDINATES), dtype=np.uint8))
    for i in range(0, 100, 2):
        sketch[i + 1] = np.where(rng.random(M.COORDINATES) < 0.8, sketch[i], sketch[i + 1])
    ids = np.arange(800)
    hits = set()
    for tree in range(len(M.ROOTS)):
        pairs, crowds = M.branch(ids, ids, sketch.astype(np.uint8), 80, seed=tree)
        hits |= pairs
        assert not crowds
    want = M.compare_across(ids, ids, sketch.astype(np.uint8), 80)
    assert hits <= want and len(hits) >= 0.98 * len(want)


def test_sketch_estimates_similarity():
    shingler = M.Shingler()
    words = [f"w{i}" for i in range(600)]
    a, b = shingler.shingles(" ".join(words)), shingler.shingles(" ".join(words[:480] + [f"v{i}" for i in range(120)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    estimate = (shingler.minwise(a) == shingler.minwise(b)).mean()
    assert abs(true - estimate) < 0.15
    assert M.set_mark(a) != M.set_mark(b)


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op1_minhash_near_dedup"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 30, 40, 50)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert M.common_counts(sets, columns=7).tolist() == want


def test_crowd_of_loosely_alike_documents(spark):
    """Most pairs are just under the border, so that stars join little and the crowd is compared on full sets."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(900)}" for _ in range(140)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.03, 0.04])))) for i in range(260)]
    frame = spark.createDataFrame([(k, t, 0, "") for k, t in rows], SCHEMA)
    for node_rows in (2048, 64):
        assert found(frame, node_rows=node_rows) == brute(rows)


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_branching_keeps_the_target_at_any_depth(percent):
    spread = M.branching(percent)
    assert all(M.missed(percent, spread, levels) <= M.MISSED for levels in (1, 5, 10, 2 * M.DEPTH))
    assert spread * percent / 100 > 1


def loose_crowd(n, planted, seed=4):
    """Sets with 120 of 200 shingles (similarity 0.43); each of the first ones is followed by a copy at 0.752."""
    rng, shingler = np.random.default_rng(seed), M.Shingler()
    pool, sets = rng.integers(0, 2**63, 200, dtype=np.uint64), []
    for i in range(n):
        sets.append(np.sort(rng.choice(pool, 120, replace=False)))
        if i < planted:
            own = rng.integers(0, 2**63, 17, dtype=np.uint64)
            sets.append(np.sort(np.concatenate([rng.choice(sets[-1], 103, replace=False), own])))
    return sets, np.array([shingler.minwise(x) for x in sets])


def found_by_all_roots(minwise, sketch, least_equal=80, **settings):
    """Candidates of all roots, each branched like a node of the table; of crowds, pairs of neighbours."""
    ids, hits = np.arange(len(sketch)), set()
    for root in range(sum(M.ROOTS)):
        order = np.argsort(minwise[:, root], kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(minwise[order, root].astype(np.int64))) + 1):
            pairs, crowds = M.branch(ids[own], ids[own], sketch[own], least_equal, seed=root, **settings)
            hits |= pairs.union(*({(x, x + 1) for x in set(c.tolist()) & set((c - 1).tolist())} for c in crowds))
    return hits


def test_pairs_at_the_border_in_a_large_loose_crowd():
    planted = 600
    sets, minwise = loose_crowd(3000, planted)
    similarity = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert 0.75 <= similarity(sets[0], sets[1]) < 0.76
    assert 0.40 < np.mean([similarity(x, y) for x, y in zip(sets[-300:], sets[-299:])]) < 0.45
    sketch = (minwise >> np.uint64(40)).astype(np.uint8)
    want = {(2 * i, 2 * i + 1) for i in range(planted) if (sketch[2 * i] == sketch[2 * i + 1]).sum() >= 80}
    hits = found_by_all_roots(minwise, sketch, small=16, depth=40)
    assert len(want) >= 0.99 * planted and len(want - hits) <= 1  # the target of one in a thousand


def test_children_of_a_node_choose_different_coordinates(spark):
    sketch = bytes(range(M.COORDINATES))
    rows = [(node, 1, 1, bytearray(sketch)) for node in range(4000)]
    nodes = spark.createDataFrame(rows, "node long, cls long, part long, sketch binary")
    for spread in (1.75, 2.5):
        got = [r.node for r in M._children(nodes, spread).collect()]
        assert len(set(got)) == len(got) and abs(len(got) / len(rows) - spread) < 0.05
