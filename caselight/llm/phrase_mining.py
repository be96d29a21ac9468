"""Collocations: phrases of 2 to 5 words that occur far more often than their parts, counted in quotient filters.

Text. A-Z are lower-cased (other letters stay), a null text is empty; the text is cut at ``[.,;:!?\\x0A-\\x0D]`` into
pieces and each piece into words ``[^\\x20\\x09]+``. Phrases are contiguous words of one piece; overlapping
occurrences all count. Everything is per lang (null: ``und``): ``n`` counts all word occurrences, ``f(p)`` all
occurrences of phrase ``p``.

Scoring. A candidate has 2 to 5 words and ``a = f(p) >= least``. Each cut after its first ``k`` words gives
``l = f(first part)``, ``r = f(rest)`` and ``floor(1000 * a * n / (l * r))``; the lowest such score counts (ties after flooring:
the smallest ``k``). Arithmetic is in exact decimals of 38 digits, so products beyond 64 bits are exact. A candidate is dropped
when it lies contiguously inside a longer candidate of the same count (a longer phrase never occurs more often). It is
enough to look one word further on either side: between a candidate and a longer one of its count every phrase has that
count too. Each lang keeps its ``top`` first by score descending, ``a`` descending, phrase ascending (UTF-8 bytes).

Counting quotient filters. Only words with ``least`` occurrences or more can be part of a candidate or of its parts, so each
such word gets a dense id per lang (1 upwards, by count descending) and any other word ends a phrase: that pruning is
exact. The ids of a phrase, ``bits`` bits each, are packed and a four-round Feistel network as wide as that length of phrase
needs permutes them invertibly; the top bits of the result are the quotient, the others the full remainder, so nothing is
lost and the original phrase is recovered by the inverse network. A key of up to 64 bits is one long where it is
exchanged, a wider one two. Texts are coded to ids once and written. Phrases are counted
level by level, 2 to 5 words: a phrase can be frequent, or be a part of a candidate, only if both its parts one word
shorter are frequent, so each level counts only phrases whose two parts passed the level before (their 64-bit
fingerprints travel to every task when at most ``MOST_SHIPPED_GRAMS``, else that level keeps every phrase; a
fingerprint that matches by chance only keeps a phrase too many, counted exactly). Every task builds the filter of its
texts as a sorted table of (key, count); Spark merges the filters of all tasks by key (partial
aggregation first, then one exchange by key). Up to 2**25 - 1 frequent words per lang fit; beyond that ``count_phrases`` fails with a
clear error rather than drop any.

Scale. Word counts are partial aggregates; ids come from one range sort (no lang is one task); the occurrences meet their
ids in the task when at most ``MOST_SHIPPED_WORDS`` frequent words exist (that table is then broadcast, about 40
bytes a word), else in one join that adaptive execution splits for very frequent words; a task merges its keys into
one sorted filter per ``FLUSH_KEYS`` keys; the top of each lang is taken first per
(lang, hash bucket) and then over those tops, so no lang's candidates are one task.

Edge cases: null or empty texts and an empty table give no words; null lang is ``und``; a phrase of repeated words counts
its overlapping occurrences; extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselight.llm.common import stored
from caselight.llm.merkle_manifest import positions

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PIECE_BREAK = "[.,;:!?\\x0A-\\x0D]"
WORD_BREAK = "[\\x20\\x09]+"
LONGEST = 5
ROUND_KEYS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
BUCKETS = 64  # first-stage groups of a lang's candidates when taking its top
EXACT = "decimal(38,0)"
MOST_SHIPPED_WORDS = 2_000_000  # frequent words (all langs) sent to every task; with more, ids come by a join
FLUSH_KEYS = 1 << 21  # packed keys a task holds before it sorts and emits them as one filter
MOST_SHIPPED_GRAMS = 4_000_000  # frequent phrases of one length sent to every task (8 bytes each) to prune longer ones

_M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A round function: splitmix64 of ``x ^ key`` (any function keeps the network invertible)."""
    with np.errstate(over="ignore"):
        z = x ^ np.uint64(key)
        z = (z + np.uint64(0x9E3779B97F4A7C15)) & _M64
        z = ((z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)) & _M64
        z = ((z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)) & _M64
        return z ^ (z >> np.uint64(31))


def half_of(width: int) -> int:
    """Bits of either half of a Feistel network over keys of ``width`` bits."""
    return max(1, (width + 1) // 2)


def _low(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in ROUND_KEYS:
        hi, lo = lo, hi ^ (_mix(lo, key) & _low(half))
    return hi, lo


def unpermute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(ROUND_KEYS):
        hi, lo = lo ^ (_mix(hi, key) & _low(half)), hi
    return hi, lo


def pack(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of up to five ids (0 = no word) as 128 bits (hi, lo): word ``i`` at bit ``i * bits``."""
    hi = np.zeros(len(ids), dtype=np.uint64)
    lo = np.zeros(len(ids), dtype=np.uint64)
    for i in range(ids.shape[1]):
        value, at = ids[:, i].astype(np.uint64), i * bits
        if at + bits <= 64:
            lo |= value << np.uint64(at)
        elif at >= 64:
            hi |= value << np.uint64(at - 64)
        else:
            lo |= (value << np.uint64(at)) & _M64
            hi |= value >> np.uint64(64 - at)
    return hi, lo


def unpack(hi: np.ndarray, lo: np.ndarray, bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    out = np.zeros((len(hi), LONGEST), dtype=np.uint64)
    for i in range(LONGEST):
        at = i * bits
        if at + bits <= 64:
            out[:, i] = (lo >> np.uint64(at)) & mask
        elif at >= 64:
            out[:, i] = (hi >> np.uint64(at - 64)) & mask
        else:
            out[:, i] = ((lo >> np.uint64(at)) | (hi << np.uint64(64 - at))) & mask
    return out.astype(np.int64)


def filter_key(hi: np.ndarray, lo: np.ndarray, half: int) -> list[np.ndarray]:
    """Permuted keys of packed ids, top bits (the quotient) first: one unsigned long while both halves fit, else two."""
    if half < 64:
        hi, lo = (lo >> np.uint64(half)) | (hi << np.uint64(64 - half)), lo & _low(half)
    hi, lo = permute(hi, lo, half)
    return [(hi << np.uint64(half)) | lo] if half <= 32 else [hi, lo]


def packed_of(key: list[np.ndarray], half: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed 128 bits (hi, lo) behind ``filter_key``."""
    hi, lo = [key[0] >> np.uint64(half), key[0] & _low(half)] if half <= 32 else key
    hi, lo = unpermute(hi, lo, half)
    if half == 64:
        return hi, lo
    return hi >> np.uint64(64 - half), (hi << np.uint64(half)) | lo


def counted_keys(key: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    if len(key) == 1:
        distinct, count = np.unique(key[0], return_counts=True)
        return [distinct], count.astype(np.int64)
    order = np.lexsort(key[::-1])
    hi, lo = key[0][order], key[1][order]
    starts = np.concatenate([[0], np.flatnonzero((hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])) + 1]).astype(np.int64)
    return [hi[starts], lo[starts]], np.diff(np.append(starts, len(hi)))


def windows(flat: np.ndarray, length: int) -> np.ndarray:
    """Rows of ``length`` consecutive nonzero ids of ``flat`` (zeros end phrases)."""
    if len(flat) < length:
        return np.zeros((0, length), dtype=np.int64)
    every = np.lib.stride_tricks.sliding_window_view(flat, length)
    return every[(every != 0).all(axis=1)]


def packed(rows: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed 128-bit keys of rows of up to ``LONGEST`` ids (zeros after them)."""
    full = np.zeros((len(rows), LONGEST), dtype=np.int64)
    full[:, : rows.shape[1]] = rows
    return pack(full, bits)


def fingerprint(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """64 bits of a packed key, for membership tests that may only err by keeping too much."""
    return _mix(hi ^ _mix(lo, ROUND_KEYS[0]), ROUND_KEYS[1])


def pieces_of(docs: DataFrame) -> DataFrame:
    """(lang, row, pieces): every text cut into pieces; ``row`` tells the document's rows apart within one job."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), CAPITALS, CAPITALS.lower())
    return docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.monotonically_increasing_id().alias("row"),
        F.split(lowered, PIECE_BREAK).alias("pieces"),
    )


def words_of(rows: DataFrame) -> DataFrame:
    """(lang, row, piece, pos, word) of every word occurrence of ``pieces_of``'s rows."""
    pieces = rows.select("lang", "row", F.posexplode("pieces").alias("piece", "body"))
    return pieces.select("lang", "row", "piece", F.posexplode(F.split("body", WORD_BREAK)).alias("pos", "word")).filter(
        F.col("word") != ""
    )


def count_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(counts, vocabulary, totals, bits): f of every phrase of 1 to 5 words with f >= least per lang, as ids w1..w5."""
    pieces = pieces_of(docs)
    occurrences = words_of(pieces)  # the exploded words are never written
    counted = stored(occurrences.groupBy("lang", "word").agg(F.count("*").alias("c")), "phrase-words")
    totals = counted.groupBy("lang").agg(F.sum("c").alias("n"))
    frequent = counted.filter(F.col("c") >= least)
    vocabulary = positions(frequent, ["lang"], [F.col("c").desc(), F.col("word")])
    vocabulary = stored(vocabulary.select("lang", "word", (F.col("idx") + 1).alias("id"), "c"), "phrase-vocabulary")
    most = int(vocabulary.agg(F.max("id")).first()[0] or 0)
    bits = max(1, most.bit_length())
    if bits * LONGEST > 128:
        raise ValueError(f"{most} frequent words in one lang do not fit five to 128 bits")

    coded = stored(_coded(docs, pieces, occurrences, vocabulary), "phrase-ids")

    levels = [vocabulary.select("lang", F.col("c").alias("f"), F.col("id").alias("w1"), *[F.lit(0).cast("bigint").alias(f"w{i}") for i in range(2, LONGEST + 1)])]
    shipped = None  # fingerprints of the frequent phrases one word shorter, per lang; None: keep every phrase
    for length in range(2, LONGEST + 1):
        # Only frequent phrases are ever looked up: candidates and their parts all have f >= least.
        frequent = stored(_level(coded, length, bits, shipped, least), f"phrase-level-{length}")
        levels.append(frequent)
        if frequent.isEmpty():
            break  # no longer phrase can be frequent
        shipped = _fingerprints(frequent, bits)
    counts = levels[0]
    for more in levels[1:]:
        counts = counts.unionByName(more)
    return counts, vocabulary, totals, bits


def _coded(docs: DataFrame, pieces: DataFrame, occurrences: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, ids): each row's frequent-word ids, 0 for other words and after every piece."""
    if vocabulary.count() <= MOST_SHIPPED_WORDS:
        # Small enough to travel: every task codes its own texts, and no word occurrence is exchanged.
        known: dict[str, dict[str, int]] = {}
        for row in vocabulary.select("lang", "word", "id").toLocalIterator():
            known.setdefault(row.lang, {})[row.word] = row.id
        words = docs.sparkSession.sparkContext.broadcast(known)

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import re

            cut = re.compile("[\\x20\\x09]+")
            for batch in batches:
                out = []
                for lang, parts in zip(batch.column("lang").to_pylist(), batch.column("pieces").to_pylist()):
                    ids = words.value.get(lang, {})
                    out.append([i for piece in parts for i in [*(ids.get(w, 0) for w in cut.split(piece) if w), 0]])
                yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "ids": pa.array(out, pa.list_(pa.int32()))})

        return pieces.select("lang", "pieces").mapInArrow(code, "lang string, ids array<int>")
    joined = occurrences.join(vocabulary.select("lang", "word", "id"), ["lang", "word"], "left").fillna(0, ["id"])
    return joined.groupBy("lang", "row", "piece").agg(
        F.concat(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda s: s["id"].cast("int")), F.array(F.lit(0))
        ).alias("ids")
    ).select("lang", "ids")


def _fingerprints(frequent: DataFrame, bits: int):
    """Broadcast fingerprints of ``frequent`` phrases per lang, or None when there are more than ``MOST_SHIPPED_GRAMS``."""
    if frequent.count() > MOST_SHIPPED_GRAMS:
        return None
    held: dict[str, list[np.ndarray]] = {}
    for row in frequent.toLocalIterator():
        held.setdefault(row.lang, []).append(np.array([row[f"w{i + 1}"] for i in range(LONGEST)], dtype=np.int64))
    table = {lang: np.unique(fingerprint(*pack(np.stack(rows), bits))) for lang, rows in held.items()}
    return frequent.sparkSession.sparkContext.broadcast(table)


def _level(coded: DataFrame, length: int, bits: int, shipped, least: int) -> DataFrame:
    """Counts (lang, f, w1..w5) of the phrases of ``length`` words that occur ``least`` times or more."""

    half = half_of(length * bits)
    names = ["key"] if half <= 32 else ["key", "key_low"]  # a short key is exchanged as one long

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                key = filter_key(np.concatenate([h for h, _ in parts]), np.concatenate([l for _, l in parts]), half)
                distinct, count = counted_keys(key)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(count), pa.string()),
                    **{n: pa.array(k.view(np.int64)) for n, k in zip(names, distinct)}, "f": pa.array(count),
                })
            held.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            lists = batch.column("ids")
            for lang in set(langs):
                mine = lists.filter(pa.array([x == lang for x in langs]))
                flat = mine.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                rows = windows(flat, length)
                if shipped is not None and len(rows):
                    known = shipped.value.get(lang, np.zeros(0, np.uint64))
                    keep = np.ones(len(rows), dtype=bool)
                    for part in (rows[:, :-1], rows[:, 1:]):
                        marks = fingerprint(*packed(part, bits))
                        at = np.minimum(np.searchsorted(known, marks), max(len(known) - 1, 0))
                        keep &= (known[at] == marks) if len(known) else False
                    rows = rows[keep]
                if len(rows):
                    held.setdefault(lang, []).append(packed(rows, bits))
                    size += len(rows)
            if size >= FLUSH_KEYS:
                yield from flush()
                size = 0
        yield from flush()

    shards = coded.mapInArrow(filters, f"lang string, {', '.join(f'{n} bigint' for n in names)}, f bigint")
    merged = shards.groupBy("lang", *names).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in names]
            ids = unpack(*packed_of(key, half), bits)
            out = {"lang": batch.column("lang"), "f": batch.column("f")}
            for i in range(LONGEST):
                out[f"w{i + 1}"] = pa.array(ids[:, i])
            yield pa.RecordBatch.from_pydict(out)

    schema = "lang string, f bigint, " + ", ".join(f"w{i + 1} bigint" for i in range(LONGEST))
    return merged.mapInArrow(decode, schema)


def _length() -> F.Column:
    return sum((F.col(f"w{i + 1}") != 0).cast("int") for i in range(LONGEST))


def _slice(start: F.Column, end: F.Column) -> list[F.Column]:
    """Ids ``start`` to ``end`` (0-based, end exclusive) of a phrase as w1.., zeros after them."""
    every = F.array(*[F.col(f"w{i + 1}") for i in range(LONGEST)])
    return [
        F.when(start + i < end, F.get(every, start + i)).otherwise(F.lit(0)).cast("bigint").alias(f"w{i + 1}")
        for i in range(LONGEST)
    ]


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """Per lang the ``top`` candidates: lang, rank, phrase, a, l, r, n, score (see the module's text)."""
    counts, vocabulary, totals, _bits = count_phrases(docs, least)
    ids = [f"w{i + 1}" for i in range(LONGEST)]
    counted = counts.withColumn("m", _length())
    candidates = stored(counted.filter((F.col("m") >= 2) & (F.col("f") >= least)), "phrase-candidates")

    # Dropped: a candidate inside a candidate one word longer with the same count.
    longer = candidates.filter(F.col("m") >= 3)
    m = F.col("m")
    inner = longer.select("lang", "f", *_slice(F.lit(0), m - 1)).unionByName(longer.select("lang", "f", *_slice(F.lit(1), m)))
    kept = candidates.join(inner.distinct(), ["lang", *ids, "f"], "left_anti")

    # Every cut of a kept candidate, with the counts of its two parts.
    cuts = kept.select("lang", *ids, "m", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    k = F.col("k")
    cuts = cuts.select(
        "lang", "a", "k", *ids,
        *[c.alias(f"l{c_name}") for c, c_name in zip(_slice(F.lit(0), k), ids)],
        *[c.alias(f"r{c_name}") for c, c_name in zip(_slice(k, m), ids)],
    )
    left = counts.select("lang", *[F.col(c).alias(f"l{c}") for c in ids], F.col("f").alias("l"))
    right = counts.select("lang", *[F.col(c).alias(f"r{c}") for c in ids], F.col("f").alias("r"))
    both = cuts.join(left, ["lang", *[f"l{c}" for c in ids]]).join(right, ["lang", *[f"r{c}" for c in ids]])
    both = both.join(totals, "lang")
    score = F.expr(f"CAST(a AS {EXACT}) * CAST(n AS {EXACT}) * 1000 div (CAST(l AS {EXACT}) * CAST(r AS {EXACT}))")
    best = both.groupBy("lang", *ids, "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    best = best.select("lang", *ids, "a", "n", "best.score", "best.l", "best.r")

    # Phrases as text: each id meets its word once.
    spelled = best.select("lang", *ids, F.posexplode(F.array(*ids)).alias("at", "id")).filter("id <> 0")
    spelled = spelled.join(vocabulary.select("lang", "id", "word"), ["lang", "id"])
    phrases = spelled.groupBy("lang", *ids).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase")
    )
    scored = best.join(phrases, ["lang", *ids])

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    bucket = F.pmod(F.xxhash64(*ids), F.lit(BUCKETS))
    local = scored.withColumn("_b", bucket).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order)))
    near = local.filter(F.col("_r") <= top).drop("_b", "_r")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("a").cast("long").alias("a"),
        F.col("l").cast("long").alias("l"), F.col("r").cast("long").alias("r"), F.col("n").cast("long").alias("n"),
        F.col("score").cast("long").alias("score"),
    )
