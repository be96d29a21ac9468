"""Dense vector search.

A corpus has ``id, vector`` and optionally ``category``; queries have ``query_id, vector`` and the same.
Exact search multiplies blocks of vectors inside tasks and hands on k rows per query and task, never
all pairs. A query set of bounded size travels to the tasks; a larger one is searched block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.functions import vectors as vx
from caselight.operators.ranking import STEP, keep_first, rank_key
from caselight.session import rows_if_bounded

MAX_SENT_QUERIES = 4096
QUERY_BLOCK_ROWS = 2048
BLOCK_ROWS = 32768
PAIRS_AT_ONCE = 1 << 20  # scores or distances a task holds at a time, 8 bytes each
BLOCK_NUMBERS = 1 << 20  # numbers in a packed block, 4 or 8 bytes each
PIECE = (512, 256)  # distances of so many asked and stored vectors at a time stay in a core's cache
HITS = "query_id string, id long, score double"


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _matrix(column: pd.Series) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, 0))
    return _unit_rows(np.stack(column.to_numpy()).astype(np.float64))


def _best(keys: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest keys, ties by id."""
    place = np.arange(len(keys))
    if len(place) > k:
        place = np.flatnonzero(keys >= np.partition(keys, len(keys) - k)[len(keys) - k])
    return place[np.lexsort((ids[place], -keys[place]))][:k]


def _block_hits(asked: pd.DataFrame, query_matrix: np.ndarray, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """Top k of one corpus block for each query of the same category."""
    found_q, found_id, found_s = [], [], []
    if len(asked) and len(block):
        ids, corpus_matrix = block["id"].to_numpy(), _matrix(block["vector"])
        asked_places = asked.groupby("category", sort=False).indices
        for category, places in block.groupby("category", sort=False).indices.items():
            askers = asked_places.get(category)
            if askers is None:
                continue
            here, there = ids[places], corpus_matrix[places]
            step = max(1, PAIRS_AT_ONCE // len(places))
            for start in range(0, len(askers), step):
                part = askers[start : start + step]
                scores = query_matrix[part] @ there.T
                keys = np.floor(scores * STEP + 0.5)
                for row, asker in enumerate(part):
                    best = _best(keys[row], here, k)
                    found_q += [asked["query_id"].iat[asker]] * len(best)
                    found_id.append(here[best])
                    found_s.append(scores[row][best])
    joined = lambda parts, kind: np.concatenate(parts) if parts else np.array([], kind)
    return pd.DataFrame(
        {"query_id": found_q, "id": joined(found_id, "int64"), "score": joined(found_s, "float64")}
    )


def _scan(corpus: DataFrame, queries: list, k: int) -> DataFrame:
    """Each task searches its share of the corpus for all queries and keeps a running top k."""
    columns = ["query_id", "vector", "category"]
    sent = corpus.sparkSession.sparkContext.broadcast([tuple(r[c] for c in columns) for r in queries])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = pd.DataFrame(sent.value, columns=columns)
        query_matrix, kept = _matrix(asked["vector"]), None
        for batch in batches:
            hits = _block_hits(asked, query_matrix, batch, k)
            kept = hits if kept is None else pd.concat([kept, hits], ignore_index=True)
            kept["_key"] = np.floor(kept["score"].astype("float64") * STEP + 0.5)
            kept = (
                kept.sort_values(["query_id", "_key", "id"], ascending=[True, False, True])
                .groupby("query_id", sort=False)
                .head(k)
                .drop(columns="_key")
            )
        if kept is not None:
            yield kept

    return corpus.mapInPandas(search, HITS)


def meet_in_blocks(
    asking: DataFrame,
    stored: DataFrame,
    asking_id: str,
    stored_id: str,
    cell: str,
    search,
    schema: str,
    query_rows: int,
    corpus_rows: int,
) -> DataFrame:
    """Rows of both sides with equal ``cell`` meet in tasks of bounded size.

    The rows of a cell are cut into blocks by its measured size, so a cell that holds a large part of
    all rows becomes many tasks. ``search`` gets one block of each side.
    """
    asked_sizes = asking.groupBy(cell).agg(F.ceil(F.count("*") / query_rows).cast("int").alias("_qs"))
    stored_sizes = stored.groupBy(cell).agg(F.ceil(F.count("*") / corpus_rows).cast("int").alias("_cs"))
    splits = asked_sizes.join(stored_sizes, cell)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spread = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    # Fresh column ids, because both sides may come from one table.
    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])
    left = asking.join(splits, cell).withColumn("_q", spread(asking_id, "_qs")).withColumn("_c", every("_cs"))
    right = fresh(stored).join(fresh(splits), cell).withColumn("_c", spread(stored_id, "_cs")).withColumn("_q", every("_qs"))
    block = [cell, "_q", "_c"]
    return left.groupBy(*block).cogroup(fresh(right).groupBy(*block)).applyInPandas(search, schema)


def rank_hits(hits: DataFrame, k: int, key: str = "query_id") -> DataFrame:
    """Final ranks from partial hits: score falling, ties by id."""
    return keep_first(hits, [key], [rank_key(F.col("score")).desc(), F.col("id")], k)


def cosine_top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    by_category: bool = False,
    max_sent_queries: int = MAX_SENT_QUERIES,
    corpus_block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact (query_id, id, score, rank) by cosine. With ``by_category`` a query sees only its own
    category, and the k are counted after that filter."""
    category = F.col("category").cast("string") if by_category else F.lit("")
    asked = queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        vx.as_double(F.col("vector")).alias("vector"),
        category.alias("category"),
    )
    stored = corpus.select("id", "vector", category.alias("category"))
    few = rows_if_bounded(asked, max_sent_queries)
    if few is not None:
        return rank_hits(_scan(stored, few, k), k)

    def search(asked_block: pd.DataFrame, corpus_block: pd.DataFrame) -> pd.DataFrame:
        return _block_hits(asked_block, _matrix(asked_block["vector"]), corpus_block, k)

    hits = meet_in_blocks(
        asked, stored, "query_id", "id", "category", search, HITS, QUERY_BLOCK_ROWS, corpus_block_rows
    )
    return rank_hits(hits, k)


def centroids(corpus: DataFrame, by: str = "category") -> DataFrame:
    """Mean, least, most and mid-range vector per group, folded before the exchange."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    stats = Summarizer.metrics("mean", "min", "max").summary(
        array_to_vector(vx.as_double(F.col("vector")))
    )
    summed = corpus.groupBy(by).agg(stats.alias("s"))
    parts = summed.select(
        by, *[vector_to_array(F.col(f"s.{m}")).alias(m) for m in ("mean", "min", "max")]
    )
    middle = F.zip_with("min", "max", lambda a, b: (a + b) / 2)
    return parts.withColumn("middle", middle)


def similarity_matrix(group: DataFrame, name: str, vector: str) -> DataFrame:
    """(a, b, cosine) for the pairs a < b of a small group, as a matrix product over dimensions."""
    unit = group.select(F.col(name).alias("a"), F.posexplode(vx.normalize(F.col(vector))).alias("d", "x"))
    other = unit.select(F.col("a").alias("b"), "d", F.col("x").alias("y"))
    return (
        unit.join(other, "d")
        .filter(F.col("a") < F.col("b"))
        .groupBy("a", "b")
        .agg(F.sum(F.col("x") * F.col("y")).alias("cosine"))
    )


def content_key(text: Column, product_id: Column | None = None, prefix_chars: int | None = None) -> Column:
    """What makes two hits the same: the product id, else a hash of the whole content.

    ``prefix_chars`` compares that many first characters only, for sources that repeat a long head.
    """
    content = text if prefix_chars is None else F.substring(text, 1, prefix_chars)
    hashed = F.sha2(content, 256)
    return hashed if product_id is None else F.coalesce(product_id.cast("string"), hashed)


def merge_variants(hits: DataFrame, k: int) -> DataFrame:
    """Hits of several variants of a query: (query_id, key, id, distance) to the best per key, nearest first."""
    best = hits.groupBy("query_id", "key").agg(
        F.min_by(F.struct("id", "distance"), F.struct(rank_key(F.col("distance")), "id")).alias("b")
    )
    flat = best.select("query_id", "key", "b.id", "b.distance")
    return keep_first(flat, ["query_id"], [rank_key(F.col("distance")), F.col("id")], k)


def rerank(candidates: DataFrame, second_score: Column, keep: int) -> DataFrame:
    """Second stage: the first-stage candidates by another score."""
    scored = candidates.drop("rank").withColumn("first_score", F.col("score")).withColumn("score", second_score)
    return rank_hits(scored, keep)


def _by_id(items: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    ids, order = items["id"].to_numpy(), np.argsort(items["id"].to_numpy(), kind="stable")
    return ids[order], np.stack(items["vector"].to_numpy())[order].astype(np.float64, copy=False)


def _nearest_of_block(asked: pd.DataFrame, block: pd.DataFrame, max_distance: float) -> pd.DataFrame:
    """The nearest item of ``block`` with a smaller id for each item of ``asked``; both are met piece by piece.

    One product gives the squared distances of a piece. Only the asked that come nearer by it than before are ranked.
    """
    if len(asked) == 0 or len(block) == 0:
        return pd.DataFrame({"id": [], "match_id": [], "distance": []})
    (ids, a), (other, b) = _by_id(asked), _by_id(block)
    squares = lambda m: (m * m).sum(axis=1)[:, None]
    left = np.hstack([-2 * a, squares(a), np.ones((len(a), 1))])
    right = np.hstack([b, np.ones((len(b), 1)), squares(b)]).T
    slack = 1 + 1e-9  # what is left out by squares must be farther by the ranked distance too
    least, match, near = np.full(len(ids), np.inf), np.zeros(len(ids), other.dtype), np.full(len(ids), np.inf)
    bound = np.full(len(ids), max_distance * max_distance * slack)
    width, step = PIECE
    for top in range(0, len(ids), width):
        bottom = min(top + width, len(ids))
        for start in range(0, len(other), step):
            there = other[start : start + step]
            first = top + np.searchsorted(ids[top:bottom], there[0], "right")  # those before have no smaller id here
            if first == bottom:
                break
            squared = left[first:bottom] @ right[:, start : start + step]
            if there[-1] >= ids[first]:
                squared[there[None, :] >= ids[first:bottom, None]] = np.inf
            rows = np.flatnonzero(squared.min(axis=1) <= bound[first:bottom])
            distance = np.sqrt(np.maximum(squared[rows], 0))
            key = np.floor(distance * STEP + 0.5)
            best = key.argmin(axis=1)  # the first of equals has the smallest id
            found, places = key[np.arange(len(rows)), best], first + rows
            better = found < least[places]
            at = places[better]
            least[at], match[at] = found[better], there[best[better]]
            near[at] = distance[better, best[better]]
            bound[at] = near[at] * near[at] * slack
    ok = np.isfinite(least) & (near <= max_distance)
    return pd.DataFrame({"id": ids[ok], "match_id": match[ok], "distance": near[ok]})


_BLOCK = {
    "part": "int", "rows": "int", "single": "boolean", "low_id": "long", "high_id": "long",
    "low_slab": "double", "high_slab": "double", "ids": "binary", "vectors": "binary",
}


def _pack(batches: Iterator[pd.DataFrame], block_rows: int) -> Iterator[pd.DataFrame]:
    """Sorted rows (id, vector, slab, part) to blocks, one row each; numbers are in single precision where that loses nothing."""

    def packed(rows: pd.DataFrame, vectors: np.ndarray) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            short = vectors.astype(np.float32)
        single = bool((short == vectors).all())
        ids, slabs = rows["id"].to_numpy(np.int64), rows["slab"]
        cells = [rows["part"].iat[0], len(ids), single, ids.min(), ids.max(), slabs.min(), slabs.max()]
        return pd.DataFrame([[*cells, ids.tobytes(), (short if single else vectors).tobytes()]], columns=list(_BLOCK))

    held = None
    for batch in batches:
        if len(batch) == 0:
            continue
        matrix = np.stack(batch["vector"].to_numpy()).astype(np.float64)
        # A number that is null, NaN or infinite makes every distance so, and no distance counts then.
        with np.errstate(over="ignore"):
            known = np.isfinite((matrix * matrix).sum(axis=1))
        rows, matrix = batch[["id", "slab", "part"]][known], matrix[known]
        if held is not None:
            rows, matrix = pd.concat([held[0], rows], ignore_index=True), np.concatenate([held[1], matrix])
        most = max(1, min(block_rows, BLOCK_NUMBERS // max(1, matrix.shape[1])))
        while len(rows) >= most:
            yield packed(rows[:most], matrix[:most])
            rows, matrix = rows[most:], matrix[most:]
        held = rows, matrix
    if held is not None and len(held[0]):
        yield packed(*held)


def _unpacked(rows: int, single: bool, ids: bytes, vectors: bytes) -> pd.DataFrame:
    matrix = np.frombuffer(vectors, np.float32 if single else np.float64).reshape(rows, -1)
    return pd.DataFrame({"id": np.frombuffer(ids, np.int64), "vector": list(matrix.astype(np.float64))})


def nearest_earlier(
    items: DataFrame,
    max_distance: float,
    query_rows: int = QUERY_BLOCK_ROWS,
    corpus_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each item the nearest item with a smaller id within ``max_distance`` (Euclidean), if any.

    Copies of one vector are folded first: all but the first of them take the first at distance 0. The
    distinct vectors are cut into slabs along a fixed direction; two vectors within the distance lie in
    the same or in neighbouring slabs, so no pair is lost. Sorted by slab and id they are packed into
    blocks of at most ``corpus_rows``, one row each. Blocks are exchanged once and a task reads those of
    two parts, so what is written grows with the vectors and not with the pairs. Blocks of distant slabs
    and blocks without a smaller id are not met; a task hands on one row per vector. There are as many
    parts as keep the cores busy, not below ``query_rows`` nor above twice ``corpus_rows`` vectors each.
    A vector that holds NaN or an infinite number is near to none.
    """
    copy = ["_copy0", "_copy1"]
    keyed = items.filter(F.col("vector").isNotNull()).select(
        "id", "vector", *[F.xxhash64(F.lit(i), "vector").alias(c) for i, c in enumerate(copy)]
    )
    firsts = keyed.groupBy(*copy).agg(F.min("id").alias("id"), F.any_value("vector").alias("vector"))
    copies = (
        keyed.select("id", *copy)
        .join(firsts.select(*copy, F.col("id").alias("match_id")), copy)
        .filter(F.col("id") != F.col("match_id"))
        .select("id", "match_id", F.lit(0.0).alias("distance"))
    )

    # Direction of alternating sign and unit length; projections differ by no more than distances.
    signed = F.aggregate(
        F.transform(vx.as_double(F.col("vector")), lambda x, i: F.when(i % 2 == 0, x).otherwise(-x)),
        F.lit(0.0),
        lambda total, x: total + x,
    ) / F.sqrt(F.size("vector"))
    stored = firsts.select("id", "vector", F.floor(signed / max_distance).alias("slab"))

    total, cores = items.count(), items.sparkSession.sparkContext.defaultParallelism
    wanted = min(math.ceil(math.sqrt(8 * cores)), math.ceil(total / query_rows))
    parts = max(1, wanted, math.ceil(total / (2 * corpus_rows)))
    schema = ", ".join(f"{name} {kind} not null" for name, kind in _BLOCK.items())
    blocks = (
        stored.filter(F.col("id").isNotNull() & F.col("slab").isNotNull())
        .repartitionByRange(parts, "slab", "id")
        .sortWithinPartitions("slab", "id")
        .withColumn("part", F.spark_partition_id())
        .mapInPandas(lambda batches: _pack(batches, corpus_rows), schema)
        .repartitionById(parts, F.col("part") % parts)
    )
    # Both sides keep all columns, so that they are one exchange.
    asked, met = [blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in _BLOCK]) for side in ("asked", "met")]
    near = (F.col("met_low_slab") <= F.col("asked_high_slab") + 1) & (F.col("met_high_slab") >= F.col("asked_low_slab") - 1)
    pairs = asked.join(met.hint("shuffle_replicate_nl"), near & (F.col("met_low_id") < F.col("asked_high_id")))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            for row in batch.to_dict("records"):
                sides = [[row[f"{side}_{c}"] for c in ("rows", "single", "ids", "vectors")] for side in ("asked", "met")]
                hits = _nearest_of_block(*[_unpacked(*side) for side in sides], max_distance)
                kept = hits if kept is None else pd.concat([kept, hits], ignore_index=True)
                kept["_key"] = np.floor(kept["distance"] * STEP + 0.5)
                kept = kept.sort_values(["id", "_key", "match_id"]).drop_duplicates("id").drop(columns="_key")
        if kept is not None:
            yield kept

    partial = pairs.mapInPandas(search, "id long, match_id long, distance double")
    best = partial.groupBy("id").agg(
        F.min_by(
            F.struct("match_id", "distance"), F.struct(rank_key(F.col("distance")), "match_id")
        ).alias("b")
    )
    return best.select("id", "b.match_id", "b.distance").unionByName(copies)


def plane_sign(plane: Column, dimension: Column) -> Column:
    """+1 or -1, fixed for each plane and dimension."""
    digit = F.substring(F.md5(F.concat_ws(":", plane.cast("string"), dimension.cast("string"))), 1, 1)
    return F.when(digit.isin(*"01234567"), F.lit(1.0)).otherwise(F.lit(-1.0))


def cell_of(vector: Column, planes: int, dimensions: int) -> Column:
    """Number of the cell: one bit per random plane, by the side the vector lies on."""
    def signs_of(plane: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda d: plane_sign(F.lit(plane), d))

    cell = F.lit(0).cast("long")
    for plane in range(planes):
        signs = signs_of(plane)
        cell = cell + F.when(vx.dot(vector, signs) >= 0, F.lit(1 << plane)).otherwise(F.lit(0)).cast("long")
    return cell


def build_cells(corpus: DataFrame, planes: int, dimensions: int) -> DataFrame:
    """Corpus with its ``cell``; stored partitioned by it, a search reads only the probed cells."""
    return corpus.withColumn("cell", cell_of(F.col("vector"), planes, dimensions))


def probes(queries: DataFrame, planes: int, dimensions: int, flips: int = 1) -> DataFrame:
    """(query_id, vector, cell): the own cell of each query and those that differ in up to ``flips`` bits."""
    own = cell_of(F.col("vector"), planes, dimensions)
    masks = [m for m in range(1 << planes) if bin(m).count("1") <= flips]
    near = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
    return queries.select("query_id", "vector", own.alias("_own"), near.alias("_mask")).select(
        "query_id", "vector", F.col("_own").bitwiseXOR(F.col("_mask")).alias("cell")
    )


def approximate_top_k(
    queries: DataFrame, cells: DataFrame, k: int, planes: int, dimensions: int, flips: int = 1
) -> DataFrame:
    """Exact scores over the probed cells only: (query_id, id, score, rank).

    The cell acts as the category of the exact search. On a table stored by cell, the semi-join lets
    Spark read the probed partitions alone.
    """
    asked = probes(queries, planes, dimensions, flips)
    probed = cells.join(asked.select("cell").distinct(), "cell", "left_semi")
    return cosine_top_k(
        asked.withColumnRenamed("cell", "category"),
        probed.select("id", "vector", F.col("cell").alias("category")),
        k,
        by_category=True,
    )


def recall_table(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Per query: exact hits, how many the approximate search found, and both best scores."""
    found = approximate.select("query_id", "id", F.col("score").alias("found_score"))
    return (
        exact.join(found, ["query_id", "id"], "left")
        .groupBy("query_id")
        .agg(
            F.count("*").alias("exact_hits"),
            F.count("found_score").alias("found_hits"),
            F.max("score").alias("best_exact"),
            F.max("found_score").alias("best_found"),
        )
        .withColumn("recall", F.col("found_hits") / F.col("exact_hits"))
    )
