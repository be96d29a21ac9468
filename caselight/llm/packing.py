"""Best-fit packing of documents into fixed-length sequences, in bulk-synchronous steps.

Documents are range-sorted by length and numbered inside their length; the documents of one length in one shard are
interchangeable, and so are the open sequences with the same gap, so a step moves whole runs of them at once:

* the longest unplaced documents meet the sorted gaps; their successor is the smallest gap that holds them,
* where many documents want the same gaps, the document of rank i takes the gap of rank i, the rest go on to the
  next gap, and only when no gap is left new sequences are opened,
* the gaps are updated, and the next length follows.

That places every document where best-fit-decreasing would. A shard sees a table of lengths and counts, at most
``capacity`` rows whatever the number of documents; shards are swept side by side in different tasks. The steps give
runs (length, first rank, count, first sequence, offset), and documents find theirs by shard, length and block of ranks.
No document passes through the driver and no length, however common, is held by one task.

Defined results: a null text is an empty one, its only token is the end id; documents of equal length are ranked by key
and piece; repeated rows are packed once each; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselight.llm.byte_bpe import send_bpe, task_bpe
from caselight.llm.common import map_rows, stored

RANK_BLOCK = 4096
ROWS_PER_SHARD = 8_000_000  # a shard leaves at most one sequence badly filled


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones at the end, the first may be shorter."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def token_pieces(
    df: DataFrame, tokenizer_json: str, pattern: str, capacity: int = 2048, end_id: int = 0,
    key: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each document's ids and the end id after them."""
    sent, kind = send_bpe(df, tokenizer_json, pattern), dict(df.dtypes)[key]
    end = np.array([end_id], dtype="<u4").tobytes()

    def make():
        bpe = task_bpe(sent.value)

        def work(batch):
            out = {c: [] for c in ("key", "piece", "start", "length", "ids_crc32", "ids")}
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = bpe.encode(t) + end
                for n, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (k, n, start, length, zlib.crc32(part), part if with_ids else None)
                    for c, v in zip(out, row):
                        out[c].append(v)
            return out

        return work

    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return map_rows(df.select(key, text), schema, make).withColumnRenamed("key", key)


def sweep(lengths: list[int], counts: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset); lengths are distinct."""
    runs, opened = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, count)
    sizes: list[int] = []  # the gaps there are, rising

    def add(gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    for length, todo in sorted(zip(lengths, counts), reverse=True):
        rank = 0
        while todo:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = capacity, opened
                count = -(-todo // (capacity // length))
                opened += count
            fit = gap // length
            full = min(todo // fit, count)
            for j in range(fit if full else 0):
                runs.append((length, rank + j * full, full, first, capacity - gap + j * length))
            add(gap - fit * length, first, full)
            rank, todo, first, count = rank + fit * full, todo - fit * full, first + full, count - full
            if count and todo:  # fewer documents than one sequence holds
                for j in range(todo):
                    runs.append((length, rank + j, 1, first, capacity - gap + j * length))
                add(gap - todo * length, first, 1)
                rank, todo, first, count = rank + todo, 0, first + 1, count - 1
            add(gap, first, count)
    return runs


RUNS = "shard bigint, length bigint, first_rank bigint, count bigint, first_sequence bigint, offset bigint"


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = 2048, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the pieces (``key``, ``piece``, ``length`` from 1 to ``capacity``, others)."""
    ordered = pieces.repartitionByRange(F.desc("length"), F.col(key), F.col("piece")).sortWithinPartitions("length", key, "piece")
    place = F.monotonically_increasing_id()  # partition number, then place in the partition
    ranked = stored(ordered.withColumn("_part", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND((1 << 33) - 1)), "ranked")

    in_part = ranked.groupBy("length", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = in_part.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")

    totals = ranked.groupBy("length").agg(F.count("*").alias("_n"))  # at most ``capacity`` rows
    shards = max(1, -(-ranked.count() // rows_per_shard))
    dealt = totals.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))
    dealt = dealt.withColumn("_n", F.expr(f"(_n - shard + {shards - 1}) div {shards}")).filter("_n > 0")

    def steps(group: pd.DataFrame) -> pd.DataFrame:
        runs = sweep(group["length"].tolist(), group["_n"].tolist(), capacity)
        found = pd.DataFrame(runs, columns=["length", "first_rank", "count", "first_sequence", "offset"], dtype="int64")
        found.insert(0, "shard", int(group["shard"].iloc[0]))
        return found

    runs = stored(dealt.groupBy("shard").applyInPandas(steps, RUNS), "runs").withColumn(
        "_block",
        F.explode(F.expr(f"sequence(first_rank div {RANK_BLOCK}, (first_rank + count - 1) div {RANK_BLOCK})")),
    )
    numbered = ranked.join(parts, ["length", "_part"]).withColumn("_rank", F.expr("_before + _at - _first"))
    numbered = (
        numbered.withColumn("shard", F.expr(f"_rank % {shards}"))
        .withColumn("_rank", F.expr(f"_rank div {shards}"))
        .withColumn("_block", F.expr(f"_rank div {RANK_BLOCK}"))
    )
    inside = (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("first_rank") + F.col("count"))
    met = numbered.join(runs, ["shard", "length", "_block"]).filter(inside)
    sequence = (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")) * shards + F.col("shard")
    return met.select(*pieces.columns, sequence.alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary): the packed ids themselves; a sequence holds at most ``capacity`` of them."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    joined = F.aggregate(F.col("_parts"), F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))
