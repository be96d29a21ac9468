"""A Merkle manifest of a table of documents, stored in a Van Emde Boas layout, with a proof for every row.

Each row is a leaf: the SHA-256 (lowercase hex) of its fields ``doc_id, source, lang, n_chars, text``, each written as
``-`` when null, else as its UTF-8 byte count, ``:`` and its value (integers in decimal). Per source the leaves ascend by
doc_id (nulls first; ties by the leaf digest, so equal rows are interchangeable); while a level holds more than one node,
every run of ``FANOUT`` consecutive nodes (the last run shorter, even of one) becomes the digest of their hex digests
joined. The one node that remains is the source's subroot (a lone leaf is its own subroot). The subroots, ordered by
source (null first, then UTF-8 bytewise, as Spark compares strings), are the leaves of a top tree built the same way,
whose remaining node is the root.

Layout. A tree of height ``h`` is addressed as in a Van Emde Boas layout: the top ``h // 2`` levels are stored first, then
every bottom subtree, left to right, each laid out the same way, recursively. ``veb_address`` is that arithmetic; for a
fixed height and depth it is a sum of digit groups of the node's index, so ``veb_sql`` writes it as one column
expression, and the parent of a node is found by the same arithmetic on ``index div FANOUT``. The stored manifest is the
table of all nodes sorted by (tree, address): every aligned subtree is one contiguous range of rows, whatever the
block size of the storage below. Construction groups nodes by their parent's address; proofs fetch a node's run of
siblings by that same address.

Scale. Positions within a source come from one range sort: partition-wise counts, summed per source over partition
numbers, give each row its rank, so a source with a third of all rows is spread over many tasks like any other range.
Each level is a grouping into runs of ``FANOUT``, ``FANOUT`` times smaller than the one below. Proofs go top down:
every node receives the runs of all levels above it, one join per level keyed by the parent's address; at the leaves
that join is made once per run (not per leaf), and the leaves' own rows meet it in one more join.

Edge cases: an empty table gives no rows; null fields hash as ``-``; empty and very long texts are hashed whole; repeated
rows give equal leaves at neighbouring positions; a null source is a source of its own, ordered first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselight.llm.common import stored

FANOUT = 16
DIGEST = 64  # hex characters of one SHA-256
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# The source of a row as two join keys without nulls: (source is null, source or '').
TREE = ["t_null", "t_key"]


def veb_address(depth: int, index: int, height: int, fanout: int = FANOUT) -> int:
    """The place of node ``index`` (left to right) at ``depth`` (0: the root) of a complete tree of ``height`` levels."""
    if height == 1:
        return 0
    top = height // 2
    if depth < top:
        return veb_address(depth, index, top, fanout)
    below = height - top
    reach = fanout ** (depth - top)
    return (fanout**top - 1) // (fanout - 1) + (index // reach) * ((fanout**below - 1) // (fanout - 1)) + veb_address(
        depth - top, index % reach, below, fanout
    )


def veb_sql(depth: int, height: int, index: str, fanout: int = FANOUT) -> str:
    """``veb_address`` as a SQL expression of the column (or expression) ``index``."""
    if height == 1:
        return "0"
    top = height // 2
    if depth < top:
        return veb_sql(depth, top, index, fanout)
    below = height - top
    reach = fanout ** (depth - top)
    inner = veb_sql(depth - top, below, f"({index} % {reach})", fanout)
    return f"({(fanout**top - 1) // (fanout - 1)} + ({index} div {reach}) * {(fanout**below - 1) // (fanout - 1)} + {inner})"


def tree_height(count: int, fanout: int = FANOUT) -> int:
    """Levels of the tree over ``count`` leaves: 1 for a lone leaf."""
    height, span = 1, 1
    while span < count:
        height, span = height + 1, span * fanout
    return height


def _height_sql(count: str, most: int) -> str:
    """``tree_height`` of a column, for counts up to ``most``."""
    steps = " ".join(f"WHEN {count} <= {FANOUT ** k} THEN {k + 1}" for k in range(tree_height(most)))
    return f"CASE {steps} END"


def _address(level: int, most_height: int, index: str = "idx") -> F.Column:
    """Address of the node ``index`` at ``level`` above the leaves, in a tree of the row's height ``h``."""
    cases = " ".join(
        f"WHEN h = {h} THEN {veb_sql(h - 1 - level, h, index)}" for h in range(level + 1, most_height + 1)
    )
    return F.expr(f"CASE {cases} END") if cases else F.lit(None).cast("long")


def _field(column: F.Column) -> F.Column:
    value = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text") -> F.Column:
    """The leaf of a row: SHA-256 of its five fields, each as ``-`` or byte count, ``:``, value."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (doc_id, source, lang, n_chars, text)]
    return F.sha2(F.concat(*[_field(p) for p in parts]), 256)


def positions(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``idx`` (0-based place within equal ``keys``, by ``order``) and ``n`` (rows of those keys).

    One range sort; the ranks come from counts per (partition, keys), summed in partition order per key, so no key is one
    task however many rows it has.
    """
    ordered = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    marked = stored(ordered.withColumn("_mid", F.monotonically_increasing_id()), "merkle-sorted")
    marked = marked.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_local", F.col("_mid").bitwiseAND((1 << 33) - 1))
    counts = marked.groupBy("_pid", *keys).agg(F.count("*").alias("_n"), F.min("_local").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", *keys, "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("n"),
    )
    placed = marked.join(offsets, ["_pid", *keys]).withColumn("idx", F.col("_before") + F.col("_local") - F.col("_first"))
    return placed.drop("_mid", "_pid", "_local", "_first", "_before")


def _build(nodes: DataFrame, keys: list[str], most_height: int, name: str) -> tuple[DataFrame, DataFrame]:
    """All nodes and all runs of the trees whose leaves are ``nodes`` (keys, idx, h, hash).

    Returns (nodes: keys, level, idx, h, address, hash) and (runs: keys, level, parent, run, size), where ``parent`` is
    the address of the node the run becomes and ``run`` its members' digests joined in order.
    """
    level, now = 0, nodes.withColumn("level", F.lit(0)).withColumn("address", _address(0, most_height))
    every, runs = [now], []
    while level + 1 < most_height:
        # Trees with more than one node at this level make their runs; the others are finished.
        open_ = now.filter(F.col("h") > level + 1).withColumn("pidx", F.expr(f"idx div {FANOUT}"))
        open_ = open_.withColumn("parent", _address(level + 1, most_height, "pidx"))
        grouped = open_.groupBy(*keys, "h", "pidx", "parent").agg(
            F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("members")
        )
        run = stored(
            grouped.select(
                *keys, "h", "pidx", "parent", F.lit(level).alias("level"),
                F.array_join(F.transform("members", lambda m: m["hash"]), "").alias("run"),
                F.size("members").alias("size"),
            ),
            f"{name}-runs",
        )
        runs.append(run.select(*keys, "level", "parent", "run", "size"))
        level += 1
        now = run.select(
            *keys, F.col("pidx").alias("idx"), "h", F.sha2("run", 256).alias("hash"), F.lit(level).alias("level"),
            F.col("parent").alias("address"),
        )
        every.append(now)
    union = every[0].select(*keys, "level", "idx", "h", "address", "hash")
    for more in every[1:]:
        union = union.unionByName(more.select(*keys, "level", "idx", "h", "address", "hash"))
    all_runs = runs[0] if runs else None
    for more in runs[1:]:
        all_runs = all_runs.unionByName(more)
    return union, all_runs


STEPS = "array<struct<run:string,k:bigint>>"


def _tree(leaves: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, DataFrame | None, int]:
    """Positions, heights and all levels of the trees of ``leaves`` (keys, hash, ...; positions by ``_order``)."""
    most_count = int(leaves.agg(F.max("n")).first()[0] or 1)
    most = tree_height(most_count)
    placed = leaves.withColumn("h", F.expr(_height_sql("n", most_count)))
    nodes, runs = _build(placed.select(*keys, "idx", "h", "hash"), keys, most, name)
    return placed, nodes, runs, most


def _downward(nodes: DataFrame, runs: DataFrame | None, keys: list[str], most: int, top: DataFrame | None, name: str):
    """For every run of level 0: (keys, parent, run, up, root, subroot), ``up`` being the steps of all levels above.

    A tree's top node takes its steps, root and subroot from ``top`` (keys, up, root), or, without ``top``, none, its
    own digest as root and no subroot. Below, a node's steps are its own run and place, then its parent's steps.
    """
    if runs is None:
        return None
    empty = F.array().cast(STEPS)
    above = None
    for level in range(most - 1, 0, -1):
        at = nodes.filter(F.col("level") == level)
        heads = at.filter(F.col("h") - 1 == level)
        if top is None:
            heads = heads.select(*keys, "address", empty.alias("up"), F.col("hash").alias("root"), F.lit(None).cast("string").alias("subroot"))
        else:
            heads = heads.join(top, keys, "left").select(
                *keys, "address", F.coalesce("up", empty).alias("up"), F.coalesce("root", "hash").alias("root"),
                F.col("hash").alias("subroot"),
            )
        made = heads
        if above is not None:
            inner = at.filter(F.col("h") - 1 > level).withColumn("paddr", _address(level + 1, most, f"idx div {FANOUT}"))
            own = runs.filter(F.col("level") == level).select(*keys, F.col("parent").alias("paddr"), "run")
            upper = above.select(*keys, F.col("address").alias("paddr"), F.col("up").alias("above"), "root", "subroot")
            inner = inner.join(own, [*keys, "paddr"]).join(upper, [*keys, "paddr"]).select(
                *keys, "address", F.concat(F.array(_step("run", F.col("idx") % FANOUT)), "above").alias("up"), "root", "subroot"
            )
            made = made.unionByName(inner)
        above = stored(made, f"{name}-up")
    first = runs.filter(F.col("level") == 0).select(*keys, "parent", "run")
    return first.join(above.select(*keys, F.col("address").alias("parent"), "up", "root", "subroot"), [*keys, "parent"])


def _step(run: str, k: F.Column) -> F.Column:
    """One level of a proof: the run a node belongs to and its place in it."""
    return F.struct(F.col(run).alias("run"), k.cast("long").alias("k"))


def _finish(placed: DataFrame, groups: DataFrame | None, keys: list[str], most: int, top: DataFrame | None) -> DataFrame:
    """Every leaf of ``placed`` with ``steps`` (from its own level up to the root), ``root`` and ``subroot``."""
    empty = F.array().cast(STEPS)
    single = placed.filter(F.col("h") == 1)
    if top is None:
        single = single.withColumn("steps", empty).withColumn("root", F.col("hash")).withColumn("subroot", F.lit(None).cast("string"))
    else:
        single = single.join(top, keys, "left").select(
            *placed.columns, F.coalesce("up", empty).alias("steps"), F.coalesce("root", "hash").alias("root"),
            F.col("hash").alias("subroot"),
        )
    if groups is None:
        return single
    many = placed.filter(F.col("h") > 1).withColumn("parent", _address(1, most, f"idx div {FANOUT}"))
    many = many.join(groups, [*keys, "parent"]).select(
        *placed.columns, F.concat(F.array(_step("run", F.col("idx") % FANOUT)), "up").alias("steps"), "root", "subroot"
    )
    return single.unionByName(many)


def proof_digest(steps: str = "steps") -> F.Column:
    """SHA-256 of the siblings' digests, level by level from the leaf up, left to right."""
    return F.expr(
        f"sha2(array_join(transform({steps}, s -> concat(substring(s.run, 1, {DIGEST} * s.k), "
        f"substring(s.run, {DIGEST} * s.k + {DIGEST + 1}))), ''), 256)"
    )


def fold(leaf: str, steps: str = "steps") -> F.Column:
    """The root recomputed from ``leaf`` and the stored siblings of each level."""
    return F.expr(
        f"aggregate({steps}, {leaf}, (now, s) -> sha2(concat(substring(s.run, 1, {DIGEST} * s.k), now, "
        f"substring(s.run, {DIGEST} * s.k + {DIGEST + 1})), 256))"
    )


def manifest(docs: DataFrame, carry: list[str] = (), name: str = "merkle") -> tuple[DataFrame, DataFrame]:
    """(proved leaves, stored nodes) of ``docs`` (doc_id, source, lang, n_chars, text; other columns ignored).

    Proved leaves: doc_id, the ``carry`` columns, leaf, subroot, root and ``steps`` (per level, leaf first: the run of
    digests the node belongs to and its place ``k``), from which ``proof_digest`` and ``fold`` work. Stored nodes: the
    layout, (t_null, t_key, level, idx, address, hash) of the source trees and, with ``t_null`` null, of the top tree,
    sorted by tree and address.
    """
    source = F.col("source")
    rows = docs.select(
        "doc_id", *carry, F.col("source").isNull().alias("t_null"), F.coalesce(source, F.lit("")).alias("t_key"),
        leaf_digest().alias("hash"),
    )
    placed = positions(rows, TREE, [F.col("doc_id").asc_nulls_first(), F.col("hash")])
    placed, nodes, runs, most = _tree(placed, TREE, f"{name}-source")

    heads = nodes.filter(F.col("level") == F.col("h") - 1).select(*TREE, "hash")
    tops = positions(heads.withColumn("t_top", F.lit(0)), ["t_top"], [F.col("t_null").desc(), F.col("t_key")])
    tops, top_nodes, top_runs, top_most = _tree(tops, ["t_top"], f"{name}-top")
    top_groups = _downward(top_nodes, top_runs, ["t_top"], top_most, None, f"{name}-top")
    above = _finish(tops, top_groups, ["t_top"], top_most, None).select(*TREE, F.col("steps").alias("up"), "root")

    groups = _downward(nodes, runs, TREE, most, above, f"{name}-source")
    proved = _finish(placed, groups, TREE, most, above).select(
        "doc_id", *carry, F.col("hash").alias("leaf"), "subroot", "root", "steps"
    )
    layout = nodes.select(*TREE, "level", "idx", "address", "hash").unionByName(
        top_nodes.select(F.lit(None).cast("boolean").alias("t_null"), F.lit(None).cast("string").alias("t_key"), "level", "idx", "address", "hash")
    )
    layout = stored(layout.repartitionByRange(*TREE, "address").sortWithinPartitions(*TREE, "address"), f"{name}-layout")
    return proved, layout
