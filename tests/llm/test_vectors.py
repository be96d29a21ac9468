"""Lattice hashing, components and posting lists against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caselight.llm import ann_search, components
from caselight.llm import embedding_dedup as E
from caselight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, rep string, n int"


def test_lattice_points():
    short = E.shortest_vectors()
    assert len(short) == len({tuple(v) for v in short}) == 240 and np.allclose((short**2).sum(axis=1), 2)
    rng = np.random.default_rng(0)
    x = rng.normal(0, 2, (500, 8))
    points = E.decode_e8(x)
    doubled = np.rint(2 * points).astype(int)
    assert (np.mod(doubled, 2).std(axis=1) == 0).all() and (doubled.sum(axis=1) % 4 == 0).all()
    distance = ((x - points) ** 2).sum(axis=1)
    assert distance.max() <= 1 + 1e-9  # the covering radius of E8
    for v in short:  # no neighbour is nearer
        assert (((x - points - v) ** 2).sum(axis=1) >= distance - 1e-9).all()


def brute_links(ids, vectors, labels, threshold):
    """(links, component) by comparing all pairs; None stands for a vector that takes no part."""
    usable = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) and label is not None and i is not None for i, v, label in zip(ids, vectors, labels)]
    links, parent = [0] * len(ids), list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if usable[i] and usable[j] and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    least = {}
    for i, known in enumerate(ids):
        if known is not None:
            least[root(i)] = min(known, least.get(root(i), known))
    return sorted(((k, n, least.get(root(i))) for i, (k, n) in enumerate(zip(ids, links))), key=str)


def noisy_groups(rng, groups, copies, dimension=64, noise=0.012):
    rows = []
    for g in range(groups):
        base = rng.normal(size=dimension)
        base /= np.linalg.norm(base)
        for _ in range(copies):
            rows.append((base + rng.normal(0, noise, dimension)).tolist())
    return rows


def test_links_of_crowded_cells_and_borderline_pairs(spark):
    rng = np.random.default_rng(4)
    vectors = noisy_groups(rng, 12, 5) + noisy_groups(rng, 1, 60, noise=0.010)
    vectors += [vectors[0]] * 4  # exact copies
    labels = [i % 2 if i < 60 else 0 for i in range(len(vectors))]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None] * 64, [float("inf")] * 64, [1e-200] * 64, [1e200] * 64, [1.0, 0.0], [0.9999, 0.001]]
    vectors, labels = vectors + odd + [vectors[0]], labels + [0] * len(odd) + [None]
    ids = [*range(1, len(vectors))] + [None]
    ids[3] = ids[2]  # a repeated id
    frame = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in zip(ids, vectors, labels)], SCHEMA)
    want = brute_links(ids, vectors, labels, 0.98)
    for cell_rows in (1024, 7):
        got = E.link(frame, 0.98, cell_rows=cell_rows).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
        assert all(r.kept == (None if r.vec_id is None else r.vec_id == r.component_id) for r in got)
    assert E.link(frame.limit(0)).count() == 0


def test_registered_query_against_brute_force(spark):
    table = pd.read_parquet(f"{SF}/embeddings.parquet")
    got = QUERIES["op6_embedding_near_dedup"](spark, SF).collect()
    want = brute_links(table.vec_id.tolist(), [v.tolist() for v in table.embedding], table.label.tolist(), 0.98)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, i) for i in range(101, 300)]
    ring = [(1000 + i, 1000 + (i + 1) % 30) for i in range(30)]
    frame = spark.createDataFrame(chain + star + ring + [(5, 5), (7, 6)], "a long, b long")
    got = {r.id: r.component for r in components.connected(frame).collect()}
    want = {i: 1 for i in range(2, 61)} | {i: 100 for i in range(101, 300)} | {1000 + i: 1000 for i in range(1, 30)}
    assert got == want
    assert components.connected(frame.limit(0)).count() == 0


def nearest(ids, vectors, query, k):
    pairs = sorted((float(np.sqrt(((np.array(v) - np.array(vectors[ids.index(query)])) ** 2).sum())), i) for i, v in zip(ids, vectors) if i != query)
    return [i for _, i in pairs[:k]]


def test_search_recall_and_scores(spark):
    table = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet").sort_values("vec_id")
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    got = QUERIES["op8_posting_list_search"](spark, "/root/testdata/sf0.1").toPandas()
    asked = ids[ids % 100 == 0]
    assert set(got.query_id) == set(asked) and (got.groupby("query_id").size() == 10).all()
    hits = 0
    for q, rows in got.groupby("query_id"):
        distance = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(axis=1))
        distance[ids == q] = np.inf
        rows = rows.sort_values("rank")
        assert rows["rank"].tolist() == list(range(1, 11))
        assert np.allclose(rows["score"], [distance[ids == v][0] for v in rows.vec_id])
        assert rows[["score", "vec_id"]].apply(tuple, axis=1).is_monotonic_increasing
        hits += len(set(rows.vec_id) & set(ids[np.lexsort((ids, distance))[:10]]))
    assert hits >= 0.95 * 10 * len(asked)


@pytest.mark.parametrize("settings", [{}, {"list_rows": 10, "block_rows": 4, "ratio": 10.0}])
def test_search_odd_input_is_exact_when_all_lists_are_searched(spark, settings):
    rng = np.random.default_rng(8)
    vectors = [rng.normal(size=8).tolist() for _ in range(80)]
    vectors += [vectors[0]] * 12  # ties
    ids = list(range(len(vectors)))
    odd = [(500, None), (600, [0.0] * 8), (700, [float("nan")] * 8), (None, vectors[1]), (800, [1.0]), (0, vectors[0])]
    rows = [*zip(ids, vectors), *odd]
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    got = ann_search.search(frame, F.col("vec_id") % 20 == 0, k=10, **settings).collect()
    assert {r.query_id for r in got} == {i for i in ids if i % 20 == 0}
    for q in {r.query_id for r in got}:
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == nearest(ids, vectors, q, 10)
    few = ann_search.search(frame.filter("vec_id < 4"), F.col("vec_id") == 0, k=10).collect()
    assert len(few) == 3
    assert ann_search.search(frame.limit(0), F.col("vec_id") == 0).count() == 0
