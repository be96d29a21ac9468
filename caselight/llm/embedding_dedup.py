"""Near-copies of vectors by lattice hashing.

Random projections take a vector to several blocks of eight numbers, each block is decoded to the nearest point of the E8
lattice, and the points of a table's blocks together are its cell. Near vectors fall into the same cell or into one whose
point differs in one block by a shortest lattice vector, so each vector also probes the ``probes`` cells of that kind
that are nearest to it. Two vectors meet where one lies in a cell that the other lies in or probes; every meeting is verified by
the cosine. Independent ``tables`` make up for cells that part near vectors.

Only codes are exchanged to find the cells in which vectors meet; vectors go to those cells only. A crowded cell is cut into
blocks of rows and compared block by block. A link is counted in the first table and cell where its two vectors meet, so
links are counted without listing pairs, and components get a spanning forest of each cell. Equal vectors of one label are
folded into one representative first.

Defined results: null labels, and vectors that are null, empty, zero or hold null, NaN or infinite numbers, link with nothing;
so do rows without id. Rows that repeat an id are rows of their own. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import map_groups, map_rows, matrix, stored
from caselight.llm.components import connected, forest

TABLES, PROBES, BLOCKS, SCALE, CELL_ROWS = 8, 8, 4, 0.35, 1024


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(pairs + halves)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum."""
    near = np.rint(x)
    odd = np.mod(near.sum(axis=-1), 2) != 0
    error = x - near
    worst = np.abs(error).argmax(axis=-1)[..., None]
    shift = np.where(np.take_along_axis(error, worst, -1) >= 0, 1.0, -1.0) * odd[..., None]
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, -1) + shift, -1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points of rows of eight numbers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=-1) < ((x - whole) ** 2).sum(axis=-1)
    return np.where(closer[..., None], half, whole)


class Lattice:
    """Cell codes of unit vectors of one dimension."""

    def __init__(self, dimension: int, tables: int, probes: int, blocks: int, scale: float, seed: int = 5):
        rng = np.random.default_rng([seed, dimension])
        self.tables, self.probes, self.blocks = tables, probes, blocks
        self.projection = rng.normal(0, scale, (dimension, tables * blocks * 8))
        self.weights = rng.integers(0, 2**64, (tables, blocks, 8), dtype=np.uint64) | np.uint64(1)
        self.short = shortest_vectors()
        doubled = np.rint(2 * self.short).astype(np.int64).view(np.uint64)
        self.steps = np.stack([[(doubled * w).sum(axis=1) for w in table] for table in self.weights]).reshape(tables, -1)

    def codes(self, unit: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes): the cell of each row, then the cells it probes; ``salt`` keeps labels apart."""
        x = (unit @ self.projection).reshape(len(unit), self.tables, self.blocks, 8)
        points = decode_e8(x)
        doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
        own = (doubled * self.weights).sum(axis=(2, 3))
        closeness = ((x - points) @ self.short.T).reshape(len(unit), self.tables, -1)
        nearest = np.argpartition(-closeness, self.probes - 1, axis=2)[:, :, : self.probes]
        steps = np.take_along_axis(np.broadcast_to(self.steps, (len(unit), *self.steps.shape)), nearest, axis=2)
        every = np.concatenate([own[:, :, None], own[:, :, None] + steps], axis=2)
        every = every * np.uint64(0x9E3779B97F4A7C15) + salt[:, None, None]
        every += np.arange(self.tables, dtype=np.uint64)[None, :, None] * np.uint64(0xD6E8FEB86659FD93)
        return (every ^ (every >> np.uint64(29))).view(np.int64)


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, and every number finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def link(
    df: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    tables: int = TABLES, probes: int = PROBES, blocks: int = BLOCKS, scale: float = SCALE, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    compared = usable(vector) & F.col(label).isNotNull() & F.col(key).isNotNull()
    rows = df.select(F.col(key).alias("_id"), F.col(vector).alias("_v"), F.col(label).alias("_label"), compared.alias("_ok"))
    mark = [F.when(F.col("_ok"), F.xxhash64(F.lit(i), "_label", "_v")).alias(f"_h{i}") for i in (0, 1)]
    marked = rows.select("_id", "_ok", *mark, "_v", "_label")
    equal = marked.filter("_ok").groupBy("_h0", "_h1").agg(
        F.min("_id").alias("least"), F.count("*").alias("n"), F.first("_v").alias("v"), F.xxhash64(F.first("_label")).alias("salt")
    )
    equal = equal.withColumn("rep", F.monotonically_increasing_id())  # ids may repeat, so classes get numbers
    width = 1 + probes

    def hashed():
        made: dict[int, Lattice] = {}

        def work(batch):
            lists, salts = batch.column(0), batch.column(1).to_numpy().view(np.uint64)
            codes = [None] * batch.num_rows
            sizes = np.array([len(v) for v in lists.to_pylist()])
            for d in set(sizes.tolist()):
                own = np.flatnonzero(sizes == d)
                lattice = made.setdefault(d, Lattice(d, tables, probes, blocks, scale))
                for i, c in zip(own.tolist(), lattice.codes(unit_rows(matrix(lists.take(own))), salts[own]).reshape(len(own), -1).tolist()):
                    codes[i] = c
            kept = {name: batch.column(i + 2) for i, name in enumerate(["rep", "n", "least", "_h0", "_h1"])}
            return kept | {"v": lists, "codes": codes}

        return work

    kind = dict(df.dtypes)[vector]
    schema = f"rep bigint, n bigint, least bigint, _h0 bigint, _h1 bigint, v {kind}, codes array<bigint>"
    reps = stored(map_rows(equal.select("v", "salt", "rep", "n", "least", "_h0", "_h1"), schema, hashed), "lattice")

    places = reps.select("rep", F.posexplode("codes").alias("_pos", "code")).select(
        "rep", "code", F.expr(f"_pos div {width}").alias("tab"), (F.col("_pos") % width == 0).alias("own")
    )
    cells = places.groupBy("code", "tab").agg(F.count("*").alias("_m"), F.sum(F.col("own").cast("int")).alias("_o"))
    cells = cells.filter("_m > 1 and _o > 0").select("code", "tab", F.expr(f"(_m + {cell_rows - 1}) div {cell_rows}").alias("_parts"))
    met = (
        places.join(cells, ["code", "tab"])
        .withColumn("block", F.expr("pmod(xxhash64(rep, 7), _parts)"))
        .withColumn("_other", F.explode(F.expr("sequence(0L, _parts - 1)")))
        .select("rep", "code", "tab", "own", "block", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"))
    )
    grouped = met.join(reps.select("rep", "n", "v", "codes"), "rep").select("code", "tab", "low", "high", "block", "own", "rep", "n", "v", "codes")

    def compare():
        def work(group):
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            own = group.column("own").to_numpy()
            if not own.any():
                return {}
            tab, code = group.column("tab")[0].as_py(), group.column("code")[0].as_py()
            unit = unit_rows(matrix(group.column("v")))
            linked = (unit @ unit.T >= threshold) & (own[:, None] | own[None, :])
            if low != high:
                side = group.column("block").to_numpy()
                linked &= side[:, None] != side[None, :]
            np.fill_diagonal(linked, False)
            if not linked.any():
                return {}
            a, b = np.nonzero(np.triu(linked))
            reps_, n = group.column("rep").to_numpy(), group.column("n").to_numpy()
            involved = np.unique(np.concatenate([a, b]))
            codes = np.zeros((len(reps_), tables, width), dtype=np.int64)
            codes[involved] = np.array(group.column("codes").take(involved).to_pylist(), dtype=np.int64).reshape(-1, tables, width)
            links = np.zeros(len(reps_), dtype=np.int64)
            for start in range(0, len(a), 1 << 18):  # the links of a crowded block, some at a time
                x, y = a[start : start + (1 << 18)], b[start : start + (1 << 18)]
                first = np.ones(len(x), dtype=bool)
                for t in range(tab + 1):
                    own_x, own_y = codes[x, t, 0], codes[y, t, 0]
                    x_to_y = (codes[x, t, 1:] == own_y[:, None]).any(axis=1)
                    y_to_x = (codes[y, t, 1:] == own_x[:, None]).any(axis=1)
                    if t < tab:
                        first &= ~((own_x == own_y) | x_to_y | y_to_x)
                    else:  # where each probes the other's cell, the lesser of the two cells counts
                        first &= ~(x_to_y & y_to_x) | (np.minimum(own_x, own_y) == code)
                links += np.bincount(x[first], n[y[first]], len(reps_)).astype(np.int64)
                links += np.bincount(y[first], n[x[first]], len(reps_)).astype(np.int64)
            tree = forest(linked)
            counted = np.flatnonzero(links)
            return {
                "rep": reps_[counted].tolist() + [int(reps_[i]) for i, _ in tree],
                "links": links[counted].tolist() + [None] * len(tree),
                "other": [None] * len(counted) + [int(reps_[j]) for _, j in tree],
            }

        return work

    found = stored(map_groups(grouped, ["code", "tab", "low", "high"], "rep bigint, links bigint, other bigint", compare, least=2), "near")
    links = found.filter("links is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    named = reps.join(connected(edges).withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("_h0", "_h1", "rep", "n", "least", F.coalesce("component", "rep").alias("_class"))
    names = named.groupBy("_class").agg(F.min("least").alias("_component"))
    folded = named.join(names, "_class").join(links, "rep", "left").select(
        "_h0", "_h1", "_component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("_links")
    )
    return marked.select("_id", "_h0", "_h1").join(folded, ["_h0", "_h1"], "left").select(
        F.col("_id").alias(key),
        F.coalesce("_links", F.lit(0)).alias("n_links"),
        F.coalesce("_component", "_id").alias("component_id"),
        (F.col("_id") == F.coalesce("_component", "_id")).alias("kept"),
    )
