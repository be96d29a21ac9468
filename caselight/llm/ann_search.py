"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted by balanced k-means on a bounded sample. Every vector of the table goes to the list of its nearest
centroid and, if it lies near a border, to those of up to ``replicas`` centroids within ``border`` of the nearest distance.
A query walks a neighbour graph over the centroids, held in memory, and searches the lists whose centroid is
within ``ratio`` of the nearest one's distance; it goes on to further lists while these hold too few vectors. Long lists and
many queries of one list are cut into blocks; a task compares one block of a list with one block of queries and hands on
the k nearest of each query.

Bounds (parameters): at most ``most_lists`` centroids, fitted on ``sample_per_list`` rows for each, drawn by a hash. All rows are
indexed. With more rows than ``most_lists`` lists of ``list_rows`` the lists get longer.

Defined results: vectors that are null, empty, zero, hold null, NaN or infinite numbers, or are of another length than most, take
no part, and neither do rows without id; rows that repeat an id count once; equal distances go to the smaller id; with fewer than k
candidates all are returned; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import map_groups, map_rows, matrix, stored
from caselight.llm.embedding_dedup import usable
from caselight.operators.ranking import keep_first

LIST_ROWS, MOST_LISTS, SAMPLE_PER_LIST = 200, 4096, 32
REPLICAS, BORDER, RATIO, BLOCK_ROWS = 4, 0.10, 0.16, 2048


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """k-means whose full clusters cost more, so that lists come out similar in length."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    penalty = np.zeros(len(centroids))
    for _ in range(rounds):
        nearest = np.concatenate([(_squared(part, centroids) + penalty).argmin(axis=1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
        if (~filled).any():
            centroids[~filled] = sample[rng.choice(len(sample), (~filled).sum())]
        spread = float(np.mean((sample - centroids[nearest]) ** 2) * sample.shape[1])
        penalty = 0.05 * spread * (sizes / max(1.0, sizes.mean()) - 1)
    return centroids


class Graph:
    """Neighbour graph over the centroids for best-first search."""

    def __init__(self, centroids: np.ndarray, degree: int = 16):
        self.centroids = centroids
        k = min(degree, len(centroids) - 1)
        near = [np.argpartition(_squared(centroids[i : i + 1], centroids)[0], k)[: k + 1] for i in range(len(centroids))] if k else [[0]]
        links: list[set[int]] = [set(map(int, n)) - {i} for i, n in enumerate(near)]
        for i, found in enumerate(list(map(set, links))):
            for j in found:
                links[j].add(i)
            if i:  # a chain keeps the graph in one piece
                links[i].add(i - 1)
                links[i - 1].add(i)
        self.links = [np.array(sorted(found), dtype=np.int64) for found in links]

    def search(self, query: np.ndarray, ratio: float, sizes: np.ndarray, least_rows: int) -> list[int]:
        """Centroids within ``1 + ratio`` of the nearest, and further ones while their lists hold under ``least_rows``."""
        seen = np.zeros(len(self.centroids), dtype=bool)
        waiting: list[tuple[float, int]] = []
        found: list[tuple[float, int]] = []
        best, rows = np.inf, 0

        def visit(which: np.ndarray) -> None:
            seen[which] = True
            for d, i in zip(np.sqrt(((self.centroids[which] - query) ** 2).sum(axis=1)).tolist(), which.tolist()):
                heapq.heappush(waiting, (d, i))

        visit(np.unique(np.linspace(0, len(self.centroids) - 1, min(16, len(self.centroids))).astype(np.int64)))
        while waiting:
            d, i = heapq.heappop(waiting)
            if d > (1 + ratio) * best and rows >= least_rows and len(found) >= 16:
                break
            found.append((d, i))
            best, rows = min(best, d), rows + int(sizes[i])
            fresh = self.links[i][~seen[self.links[i]]]
            if len(fresh):
                visit(fresh)
        chosen, rows = [], 0
        for d, i in sorted(found):
            if d > (1 + ratio) * best and rows >= least_rows:
                break
            chosen.append(i)
            rows += int(sizes[i])
        return chosen


def _draw(name: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(1_000_000)) / 1_000_000


def search(
    df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    list_rows: int = LIST_ROWS, most_lists: int = MOST_LISTS, sample_per_list: int = SAMPLE_PER_LIST,
    replicas: int = REPLICAS, border: float = BORDER, ratio: float = RATIO, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that meets ``is_query``, by Euclidean distance."""
    kind = dict(df.dtypes)[vector]
    kept = df.filter(usable(vector) & F.col(key).isNotNull())
    dimension, total = kept.agg(F.mode(F.size(vector)), F.count("*")).first()
    same = kept.filter(F.size(vector) == (dimension or 0))
    rows = same.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    lists = int(min(most_lists, max(1, round((total or 0) / list_rows))))
    drawn = rows.filter(_draw("centroids") < min(1.0, lists * sample_per_list / max(1, total or 0))).select("v").toArrow()
    sample = matrix(drawn.column("v")) if drawn.num_rows else np.zeros((1, dimension or 1))
    centroids = balanced_centroids(sample, lists)

    def assign():
        def work(batch):
            vectors = matrix(batch.column(1))
            distance = np.sqrt(_squared(vectors, centroids))
            near = np.argsort(distance, axis=1, kind="stable")[:, :replicas]
            apart = np.take_along_axis(distance, near, axis=1)
            close = apart <= (1 + border) * apart[:, :1] + 1e-12
            close[:, 0] = True
            at, place = np.nonzero(close)
            return {"list": near[at, place].tolist(), "id": batch.column(0).take(at), "v": batch.column(1).take(at)}

        return work

    posts = stored(map_rows(rows.select("id", "v"), f"list bigint, id bigint, v {kind}", assign), "posts")
    sizes = np.zeros(len(centroids), dtype=np.int64)
    for r in posts.groupBy("list").agg(F.count("*").alias("n")).collect():  # one row per centroid
        sizes[r.list] = r.n

    def route():
        graph = Graph(centroids)
        least = 2 * replicas * (k + 1)

        def work(batch):
            found = [graph.search(q, ratio, sizes, least) for q in matrix(batch.column(1))]
            at = [i for i, f in enumerate(found) for _ in f]
            return {"list": [x for f in found for x in f], "id": batch.column(0).take(at), "v": batch.column(1).take(at)}

        return work

    asked = stored(map_rows(rows.filter("asked").select("id", "v"), f"list bigint, id bigint, v {kind}", route), "asked")
    parts = posts.groupBy("list").agg(F.expr(f"(count(*) + {block_rows - 1}) div {block_rows}").alias("_p")).join(
        asked.groupBy("list").agg(F.expr(f"(count(*) + {block_rows - 1}) div {block_rows}").alias("_q")), "list"
    )

    def blocks(side: DataFrame, is_post: bool) -> DataFrame:
        own, other = ("_p", "_q") if is_post else ("_q", "_p")
        dealt = side.join(parts, "list").withColumn("_own", F.expr(f"pmod(xxhash64(id, 7), {own})"))
        dealt = dealt.withColumn("_other", F.explode(F.expr(f"sequence(0L, {other} - 1)")))
        post, ask = ("_own", "_other") if is_post else ("_other", "_own")
        return dealt.select("list", F.col(post).alias("post"), F.col(ask).alias("ask"), F.lit(is_post).alias("is_post"), "id", "v")

    met = blocks(posts, True).unionByName(blocks(asked, False))

    def compare():
        def work(group):
            is_post, ids, vectors = group.column("is_post").to_numpy(), group.column("id").to_numpy(), matrix(group.column("v"))
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            held, held_ids = vectors[is_post], ids[is_post]
            if not len(held):
                return out
            for query, query_id in zip(vectors[~is_post], ids[~is_post]):
                distance = np.sqrt(((held - query) ** 2).sum(axis=1))
                distance[held_ids == query_id] = np.inf
                if len(distance) > k:
                    near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
                else:
                    near = np.arange(len(distance))
                near = near[np.isfinite(distance[near])]
                near = near[np.lexsort((held_ids[near], distance[near]))]
                _, firsts = np.unique(held_ids[near], return_index=True)  # an id that is there twice counts once
                near = near[np.sort(firsts)][:k]
                out["query_id"] += [int(query_id)] * len(near)
                out["vec_id"] += held_ids[near].tolist()
                out["score"] += distance[near].tolist()
            return out

        return work

    near = map_groups(met, ["list", "post", "ask"], "query_id bigint, vec_id bigint, score double", compare)
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = keep_first(once, ["query_id"], [F.col("score"), F.col("vec_id")], k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
