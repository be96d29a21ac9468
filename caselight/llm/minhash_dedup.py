"""Near-copies of documents by a chosen-path similarity join.

A document is its set of shingles. Documents with equal sets are folded into one class first. A class has a sketch of
``COORDINATES`` minwise hashes. The root of each tree chooses one or two coordinates and sends every class to the child of its
minwise token there; a node that is still large chooses again, by its own hash, one or more coordinates: ``branching`` on
average, which is more than one over the least similarity, so the places where a similar pair is still together grow in
number with depth while others part. Small nodes are compared exhaustively by their sketches, and independent trees bring
the recall up: branching loses at most ``MISSED`` of the pairs at the least similarity, however many levels a node needs (for
least similarities under about 0.5 the roots alone lose more).

Every candidate is confirmed on the full sets. It is done in two passes, because components are asked for, not
pairs: first each node is compared with one of its members only, which joins most of each group; the nodes that still hold
several components then branch, and only pairs across components are compared. A group of n near copies so costs
about n comparisons, and no link between components is left out.

Nodes over ``NODE_ROWS`` members branch in Spark, level by level, smaller ones inside a task. A node that is alike
throughout, or does not shrink by ``DEPTH`` levels, is compared in blocks. No group is ever held whole. In a crowd, a node of many members that
are alike throughout, branching would part nothing and the candidates would be nearly all pairs; its members' full sets are
compared in one task (at most two blocks) and a spanning forest of the links is handed on.

Defined results: a null text and a text without words have an empty set and link with nothing, nor do rows without id;
texts under five words are one shingle, the whole sequence; rows that repeat an id are rows of their own; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import map_groups, map_rows, stored
from caselight.llm.components import connected, forest

WORDS = 5
COORDINATES = 128
ROOTS = (2, 1, 1, 2, 1, 1, 2, 1, 1)  # coordinates chosen at the root of each tree
MISSED = 0.001  # the most that branching may lose of the pairs at the least similarity
SLACK = 0.13  # candidates are estimated within this of the least similarity: 3.4 standard deviations of the sketch
SMALL_NODE, NODE_ROWS, DEPTH = 48, 2048, 10
CROWD = 0.5  # a larger node whose pairs are this alike on average is a crowd
BROADCAST_IDS = 1_000_000
WORD_MEMORY = 400_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= WORD_MEMORY:
                self.clear()
            self[word] = value
        return value


class Shingler:
    """Shingle sets and sketches of whole texts."""

    def __init__(self, words: int = WORDS, seed: int = 21):
        self.words, self.known = words, _WordHashes()
        self.factors = np.random.default_rng(seed).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted hashes of the distinct shingles."""
        found = (text or "").encode("utf-8").lower().split()
        if not found:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        hashes = np.array([known[w] for w in found], dtype=np.uint64)
        size = min(self.words, len(hashes))
        mixed = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : len(hashes) - size + 1 + i]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return np.unique(mixed ^ (mixed >> np.uint64(30)))

    def minwise(self, shingles: np.ndarray) -> np.ndarray:
        """The least value of each of the hash functions."""
        least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(shingles), 4096):
            np.minimum(least, (shingles[start : start + 4096, None] * self.factors).min(axis=0), out=least)
        return least


def set_mark(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the set."""
    a = (shingles * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = ((shingles ^ (shingles >> np.uint64(27))) * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def sketches(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, n, m0, m1, roots, sketch) of every row: set size, mark of the set, minwise tokens at the roots, sketch bytes."""
    kind = dict(documents.dtypes)[key]
    n_roots = sum(ROOTS)

    def make():
        shingler = Shingler(words)

        def work(batch):
            out = {c: [] for c in ("n", "m0", "m1", "roots", "sketch")}
            for t in batch.column(1).to_pylist():
                found = shingler.shingles(t)
                least = shingler.minwise(found)
                mark = set_mark(found)
                out["n"].append(len(found))
                out["m0"].append(mark[0])
                out["m1"].append(mark[1])
                out["roots"].append(least[:n_roots].view(np.int64).tolist())
                out["sketch"].append((least >> np.uint64(40)).astype(np.uint8).tobytes())
            return out | {"key": batch.column(0)}

        return work

    schema = f"key {kind}, n bigint, m0 bigint, m1 bigint, roots array<bigint>, sketch binary"
    return map_rows(documents.select(key, text), schema, make).withColumnRenamed("key", key)


def missed(percent: float, spread: float, levels: int) -> float:
    """The share of pairs of one similarity that no tree holds together after so many levels of branching."""
    similar = percent / 100
    equal = np.arange(COORDINATES + 1)  # places where the sketches of a pair agree
    odds = np.array([comb(COORDINATES, int(k)) * similar**k * (1 - similar) ** (COORDINATES - k) for k in equal])
    same = equal / COORDINATES
    least, more = int(spread), spread - int(spread)
    lost = np.zeros(len(same))
    for _ in range(levels):
        apart = 1 - same + same * lost
        lost = (1 - more) * apart**least + more * apart ** (least + 1)
    return float((odds * (1 - same + same * lost) ** sum(ROOTS)).sum())


_BRANCHING: dict[int, float] = {}  # a plain dictionary travels with the functions; a cached function would not


def branching(percent: int) -> float:
    """How many coordinates a node chooses on average: the fewest that lose ``MISSED`` at most through all levels."""
    if percent not in _BRANCHING:
        steps = np.arange(1, 4.01, 1 / 16).tolist()
        _BRANCHING[percent] = next((b for b in steps if missed(percent, b, 2 * DEPTH) <= MISSED), steps[-1])
    return _BRANCHING[percent]


def _sketch_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES)


def _star(least_equal: int):
    """Candidates between a block of a node and its first member."""

    def make():
        def work(group):
            ids, sketch = group.column("cls").to_numpy(), _sketch_rows(group.column("sketch"))
            first = int(ids.argmin())
            near = np.flatnonzero((sketch == sketch[first]).sum(axis=1) >= least_equal)
            near = near[near != first]
            return {"a": [int(ids[first])] * len(near), "b": ids[near].tolist()}

        return work

    return make


def _candidates(ids, parts, sketch, least_equal: int) -> np.ndarray:
    """Which members agree in enough places and are of different components."""
    near = np.zeros((len(ids), len(ids)), dtype=bool)
    step = max(1, (1 << 23) // (len(ids) * COORDINATES))
    for start in range(0, len(ids), step):
        end = start + step
        equal = (sketch[start:end, None, :] == sketch[None, :, :]).sum(axis=2, dtype=np.int16)
        near[start:end] = (equal >= least_equal) & (parts[start:end, None] != parts[None, :])
    return near


def compare_across(ids, parts, sketch, least_equal: int) -> set[tuple[int, int]]:
    """The candidates of a node as pairs of ids."""
    pairs = np.nonzero(_candidates(ids, parts, sketch, least_equal) & (ids[:, None] < ids[None, :]))
    return {(int(ids[i]), int(ids[j])) for i, j in zip(*pairs)}


def branch(ids, parts, sketch, least_equal: int, seed: int, small: int = SMALL_NODE, depth: int = DEPTH, percent: int = 75):
    """(pairs, crowds) of the subtree of one node: branch until nodes are small or hold one component.

    A node of many members that are alike throughout is a crowd: its members that have a candidate are named, to be
    compared on their full sets in one place, for their pairs would be too many to hand on.
    """
    rng = np.random.default_rng(seed)
    spread = branching(percent)
    waiting = [(np.arange(len(ids)), 0)]
    pairs: set[tuple[int, int]] = set()
    crowds: list[np.ndarray] = []
    while waiting:
        own, level = waiting.pop()
        if (parts[own] == parts[own[0]]).all():
            continue
        if len(own) <= small:
            pairs |= compare_across(ids[own], parts[own], sketch[own], least_equal)
            continue
        alike = level >= depth
        if not alike:  # the mean similarity of the node's pairs, from the counts of equal bytes
            looked = sketch[own][:, rng.choice(COORDINATES, 16, replace=False)]
            same = sum(float((np.bincount(c).astype(float) ** 2).sum()) for c in looked.T) / 16 - len(own)
            alike = same >= CROWD * len(own) * (len(own) - 1)
        if alike:
            met = _candidates(ids[own], parts[own], sketch[own], least_equal).any(axis=1)
            if met.any():
                crowds.append(ids[own[met]])
            continue
        for coordinate in rng.choice(COORDINATES, int(spread + rng.random()), replace=False):
            values = sketch[own, coordinate]
            order = np.argsort(values, kind="stable")
            for child in np.split(own[order], np.flatnonzero(np.diff(values[order])) + 1):
                if len(child) > 1:
                    waiting.append((child, level + 1))
    return pairs, crowds


def _subtrees(least_equal: int, percent: int):
    """Rows (a, b, null) for pairs and (a, null, crowd) for members of crowds."""

    def make():
        def work(group):
            ids, parts, sketch = group.column("cls").to_numpy(), group.column("part").to_numpy(), _sketch_rows(group.column("sketch"))
            node, low, high = (group.column(c)[0].as_py() for c in ("node", "low", "high"))
            if group.column("whole")[0].as_py():
                pairs, crowds = branch(ids, parts, sketch, least_equal, abs(node), percent=percent)
            else:
                met = _candidates(ids, parts, sketch, least_equal).any(axis=1)
                pairs, crowds = set(), [ids[met]] if met.any() else []
            out = {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs], "crowd": [None] * len(pairs)}
            for i, members in enumerate(crowds):
                name = (node * 31 + low * 1_000_003 + high * 7_919 + i) * 0x9E3779B97F4A7C15 % (1 << 63)
                out["a"] += members.tolist()
                out["b"] += [None] * len(members)
                out["crowd"] += [name] * len(members)
            return out

        return work

    return make


def common_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """The sizes of all intersections, as a matrix product over the shingles that several sets hold."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = (np.cumsum(shared) - 1)[places]
    keep = shared[places]
    rows, column = rows[keep], column[keep]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)  # whole numbers far below 2^24
    for start in range(0, int(shared.sum()), columns):
        low, high = np.searchsorted(column, [start, start + columns])
        part = np.zeros((len(sets), columns), dtype=np.float32)
        part[rows[low:high], column[low:high] - start] = 1
        total += part @ part.T
    np.fill_diagonal(total, [len(x) for x in sets])
    return total


def _crowd_links(percent: int, words: int):
    """Links of a crowd on the full sets: a spanning forest of those across components."""

    def make():
        shingler = Shingler(words)

        def work(group):
            ids, first = np.unique(group.column("cls").to_numpy(), return_index=True)
            parts = group.column("part").to_numpy()[first]
            sets = [shingler.shingles(t) for t in group.column("text").take(first).to_pylist()]
            sizes, common = np.array([len(x) for x in sets], dtype=float), common_counts(sets)
            linked = np.zeros(common.shape, dtype=bool)
            for i, shared in enumerate(common):  # a row at a time, to stay small beside the matrix
                union = sizes[i] + sizes - shared
                linked[i] = (100 * shared.astype(float) >= percent * union) & (parts != parts[i])
            edges = forest(linked)
            return {"a": [int(ids[i]) for i, _ in edges], "b": [int(ids[j]) for _, j in edges]}

        return work

    return make


def _live(nodes: DataFrame) -> DataFrame:
    """Only nodes of several components, with their number of members ``_m``."""
    counts = nodes.groupBy("node").agg(F.count("*").alias("_m"), F.min("part").alias("_lo"), F.max("part").alias("_hi"))
    # Written apart, so that the join meets two plain exchanges and can split a crowded node.
    return nodes.join(stored(counts.filter("_lo < _hi").select("node", "_m"), "counts"), "node")


def _dense(nodes: DataFrame) -> DataFrame:
    """(node) of the nodes whose pairs agree in ``CROWD`` of their places on average, from the counts of equal bytes."""
    looked = F.array(*[F.expr(f"substring(sketch, {COORDINATES - i}, 1)") for i in range(4)])
    tokens = nodes.select("node", "_m", F.posexplode(looked).alias("_c", "_token"))
    counts = tokens.groupBy("node", "_m", "_c", "_token").agg(F.count("*").alias("_n"))
    alike = counts.groupBy("node", "_m").agg((F.sum(F.col("_n") * F.col("_n")) / (4 * F.col("_m") * F.col("_m"))).alias("_alike"))
    return stored(alike.filter(F.col("_alike") >= CROWD).select("node"), "dense")


def _children(nodes: DataFrame, spread: float) -> DataFrame:
    """One level down: each node chooses ``spread`` coordinates on average by its own hash."""
    first, step = F.xxhash64("node", F.lit(1)), F.pmod(F.xxhash64("node", F.lit(2)), F.lit(COORDINATES // 2)) * 2 + 1
    more = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 20)) < int((spread - int(spread)) * (1 << 20))
    number = F.lit(int(spread)) + more.cast("int")
    # Odd steps, so that the coordinates of a node differ.
    split = nodes.withColumn("_i", F.explode(F.sequence(F.lit(0), number - 1)))
    split = split.withColumn("_c", F.pmod(F.pmod(first, F.lit(COORDINATES)) + F.col("_i") * step, F.lit(COORDINATES)).cast("int"))
    token = F.expr("substring(sketch, _c + 1, 1)")
    return split.select(F.xxhash64("node", "_c", token).alias("node"), "cls", "part", "sketch")


def _texts(documents: DataFrame, classes: DataFrame, needed: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(cls, text) of the classes in ``needed`` (cls)."""
    needed = stored(needed.distinct().join(classes.select("cls", "least", "m0", "m1"), "cls"), "needed")
    ids = needed.select(F.col("least").alias(key)).distinct()
    if needed.count() <= BROADCAST_IDS:  # beyond it the texts are exchanged
        ids = F.broadcast(ids)
    held = documents.select(key, text).join(ids, key, "left_semi")

    def marked():
        shingler = Shingler(words)

        def work(batch):
            marks = [set_mark(shingler.shingles(t)) for t in batch.column(1).to_pylist()]
            return {"least": batch.column(0), "m0": [m[0] for m in marks], "m1": [m[1] for m in marks], "text": batch.column(1)}

        return work

    kind = dict(documents.dtypes)[key]
    found = map_rows(held, f"least {kind}, m0 bigint, m1 bigint, text string", marked)
    return found.join(needed, ["least", "m0", "m1"]).select("cls", "text")


def _confirm(texts: DataFrame, pairs: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs (a, b) of classes with 100 * intersection >= percent * union, on the full sets of their texts."""
    sides = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compare():
        shingler = Shingler(words)
        recent = lru_cache(maxsize=16)(shingler.shingles)

        def work(batch):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                left, right = recent(x), recent(y)
                common = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * common >= percent * (len(left) + len(right) - common))
            return {"a": [v for v, k in zip(a, linked) if k], "b": [v for v, k in zip(b, linked) if k]}

        return work

    return stored(map_rows(sides.select("a", "b", "text_a", "text_b"), "a bigint, b bigint", compare).distinct(), "confirmed")


def near_duplicates(
    documents: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text", words: int = WORDS, node_rows: int = NODE_ROWS,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row."""
    least_equal = int(np.ceil((percent / 100 - SLACK) * COORDINATES))
    rows = stored(sketches(documents, key, text, words), "sketches")
    folded = rows.filter(F.col(key).isNotNull() & (F.col("n") > 0)).groupBy("m0", "m1").agg(
        F.min(key).alias("least"), F.first("roots").alias("roots"), F.first("sketch").alias("sketch")
    )
    classes = stored(folded.withColumn("cls", F.monotonically_increasing_id()), "classes")

    tokens = classes.select("cls", F.posexplode("roots").alias("_tree", "_token")).select("cls", F.xxhash64("_tree", "_token").alias("node"))
    shared = tokens.groupBy("node").agg(F.count("*").alias("_m")).filter("_m > 1")
    level = stored(tokens.join(shared, "node").join(classes.select("cls", "sketch"), "cls").select("node", "_m", "cls", "sketch"), "nodes")

    pair = "a bigint, b bigint"
    blocks = level.withColumn("block", F.expr(f"pmod(xxhash64(cls, node), (_m + {node_rows - 1}) div {node_rows})"))
    starred = stored(map_groups(blocks.select("node", "block", "cls", "sketch"), ["node", "block"], pair, _star(least_equal), least=2).distinct(), "stars")
    ends = F.explode(F.array("a", "b")).alias("cls")
    joined = _confirm(_texts(documents, classes, starred.select(ends), key, text, words), starred, percent, words)

    parts = connected(joined).select(F.col("id").alias("cls"), F.col("component").alias("part"))
    nodes = level.drop("_m").join(parts, "cls", "left").withColumn("part", F.coalesce("part", "cls"))
    now = stored(_live(nodes), "live")
    done, crowded = now.filter(F.col("_m") <= node_rows), now.limit(0)
    for _ in range(DEPTH):
        now = now.filter(F.col("_m") > node_rows)
        if now.isEmpty():
            break
        dense = _dense(now)  # branching would part nothing there
        crowded = crowded.unionByName(now.join(dense, "node", "left_semi"))
        now = stored(_live(_children(now.join(dense, "node", "left_anti"), branching(percent))), "live")
        done = done.unionByName(now.filter(F.col("_m") <= node_rows))
    whole = done.select("node", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"), F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("whole"), "cls", "part", "sketch")
    left = crowded.unionByName(now.filter(F.col("_m") > node_rows)).withColumn("_n", F.expr(f"(_m + {node_rows - 1}) div {node_rows}"))
    left = left.withColumn("block", F.expr("pmod(xxhash64(cls, node), _n)")).withColumn("_o", F.explode(F.expr("sequence(0L, _n - 1)")))
    left = left.select("node", F.least("block", "_o").alias("low"), F.greatest("block", "_o").alias("high"), "block", F.lit(False).alias("whole"), "cls", "part", "sketch")
    across = stored(map_groups(whole.unionByName(left), ["node", "low", "high"], f"{pair}, crowd bigint", _subtrees(least_equal, percent), least=2), "across")
    pairs = stored(across.filter("crowd is null").select("a", "b").distinct().join(starred, ["a", "b"], "left_anti"), "pairs")
    crowds = across.filter("crowd is not null").select("crowd", F.col("a").alias("cls"))
    texts = _texts(documents, classes, pairs.select(ends).unionByName(crowds.select("cls")), key, text, words)
    held = crowds.join(texts, "cls").join(parts, "cls", "left").select("crowd", "cls", F.coalesce("part", "cls").alias("part"), "text")
    in_crowds = stored(map_groups(held, ["crowd"], pair, _crowd_links(percent, words), least=2), "crowds")
    joined = joined.unionByName(_confirm(texts, pairs, percent, words)).unionByName(in_crowds)

    named = classes.join(connected(joined).select(F.col("id").alias("cls"), "component"), "cls", "left")
    named = named.select("m0", "m1", "least", F.coalesce("component", "cls").alias("_class"))
    names = named.groupBy("_class").agg(F.min("least").alias("_name"))
    folded = named.join(names, "_class").select("m0", "m1", "_name")
    usable = F.when(F.col("n") > 0, F.col("_name"))
    return rows.join(folded, ["m0", "m1"], "left").select(
        key, F.col("n").alias("n_shingles"),
        F.when(F.col(key).isNotNull(), F.coalesce(usable, F.col(key))).alias("component_id"),
        (F.col(key) == F.coalesce(usable, F.col(key))).alias("kept"),
    )


def keep_one(documents: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, the one with the least id, with the columns it came with; rows without id stay.

    Ids are taken for keys: of rows that repeat both id and text one stays.
    """
    chosen = near_duplicates(documents, percent, key, text).filter("kept").select(key).distinct()
    kept = documents.filter(F.col(key).isNotNull()).join(chosen, key, "left_semi").dropDuplicates([key, text])
    return kept.unionByName(documents.filter(F.col(key).isNull()))
