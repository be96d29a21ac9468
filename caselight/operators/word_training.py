"""Word vectors trained part by part: skip-gram with negative samples, no vocabulary in one place.

A task trains the words it meets, from starting values that hang on the word alone, and hands them on when they get many;
the vectors of one word are then averaged over the parts, as Spark's own Word2Vec averages over partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_WORDS = 300_000  # a task hands on its vectors when it holds more words than this
STEP_TOKENS = 1024  # tokens whose pairs are worked on at once
RATE, LEAST_RATE = 0.025, 0.0000025  # learning rate at the start and the end, as in Spark's Word2Vec
NEGATIVES, SHARED = 5, 10  # samples that count per pair, and words drawn for all pairs of a step
MOST_STEP = 0.25  # largest change of a number in one step, where a word stands in many pairs


def _starts(words: list[str], size: int, seed: int) -> np.ndarray:
    """Numbers between -0.5 / size and 0.5 / size by the hash of a word, the same in every task."""
    codes = [int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in words]
    x = np.array(codes, dtype=np.uint64)[:, None] + np.arange(seed, seed + size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) / 2.0**64 - 0.5) / size


class Part:
    """Words met so far with their vectors (``own``), the vectors they are predicted by (``near``) and their counts."""

    def __init__(self, size: int, window: int, seed: int) -> None:
        self.size, self.window, self.seed = size, window, seed
        self.ids: dict[str, int] = {}
        self.own, self.near, self.counts = np.empty((0, size)), np.empty((0, size)), np.empty(0)
        self.random = np.random.default_rng(seed)

    def numbers_of(self, words: list[str]) -> np.ndarray:
        known = len(self.ids)
        numbers = np.array([self.ids.setdefault(w, len(self.ids)) for w in words], dtype=np.int64)
        fresh = _starts([w for w, n in zip(words, numbers.tolist()) if n >= known], self.size, self.seed)
        self.own = np.concatenate([self.own, fresh])
        self.near = np.concatenate([self.near, np.zeros_like(fresh)])
        self.counts = np.concatenate([self.counts, np.zeros(len(fresh))])
        return numbers

    def _pairs(self, start: int, stop: int, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (centre, neighbour) of one row; a centre reaches 1 to ``window`` places, by chance."""
        centre = np.arange(start, stop)
        reach = self.random.integers(1, self.window + 1, len(centre))
        found = []
        for away in [d for w in range(1, self.window + 1) for d in (-w, w)]:
            other = centre + away
            fits = (reach >= abs(away)) & (other >= 0) & (other < len(row))
            fits[fits] = row[centre[fits]] == row[other[fits]]
            found.append((centre[fits], other[fits]))
        return np.concatenate([c for c, _ in found]), np.concatenate([o for _, o in found])

    def _add(self, table: np.ndarray, at: np.ndarray, change: np.ndarray) -> None:
        held, place = np.unique(at, return_inverse=True)
        cells = (place[:, None] * self.size + np.arange(self.size)).ravel()
        summed = np.bincount(cells, weights=change.ravel(), minlength=len(held) * self.size).reshape(len(held), self.size)
        table[held] += np.clip(summed, -MOST_STEP, MOST_STEP)

    def train(self, token: np.ndarray, row: np.ndarray, rate: float) -> None:
        """One pass over tokens (numbers of words) that stand in rows."""
        self.counts += np.bincount(token, minlength=len(self.counts))
        held = np.unique(token)
        chance = np.cumsum(self.counts[held] ** 0.75)
        for start in range(0, len(token), STEP_TOKENS):
            centre, other = (token[p] for p in self._pairs(start, min(start + STEP_TOKENS, len(token)), row))
            drawn = held[np.searchsorted(chance, self.random.random(SHARED) * chance[-1], side="right")]
            own, near, far = self.own[centre], self.near[other], self.near[drawn]
            pull = rate * (1 - _sigmoid((own * near).sum(axis=1)))[:, None]
            push = -rate * NEGATIVES / SHARED * _sigmoid(own @ far.T)
            self._add(self.own, centre, pull * near + push @ far)
            self._add(self.near, np.concatenate([other, drawn]), np.concatenate([pull * own, push.T @ own]))

    def rows(self) -> pa.RecordBatch:
        offsets = pa.array(np.arange(len(self.ids) + 1, dtype=np.int32) * self.size)
        vectors = pa.ListArray.from_arrays(offsets, pa.array(self.own.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(list(self.ids), pa.string()), vectors], names=["word", "vector"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def frequent_words(rows: DataFrame, words: str, min_count: int) -> DataFrame:
    """(words): the rows without words that come less than ``min_count`` times in all; only words are exchanged."""
    numbered = rows.select(words).withColumn("_row", F.monotonically_increasing_id())
    placed = numbered.select("_row", F.posexplode(words).alias("_at", "word"))
    frequent = placed.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    kept = placed.join(frequent, "word", "left_semi").groupBy("_row")
    in_order = F.array_sort(F.collect_list(F.struct("_at", "word")))
    return kept.agg(F.transform(in_order, lambda w: w["word"]).alias(words)).select(words)


def train(rows: DataFrame, words: str, size: int, window: int, seed: int, partitions: int | None = None) -> DataFrame:
    """(word, vector): one row per distinct word of the arrays ``words``."""
    texts = rows.select(F.filter(words, lambda w: w.isNotNull()).alias(words))
    parts = texts.rdd.getNumPartitions()
    least = partitions or rows.sparkSession.sparkContext.defaultParallelism
    if partitions or parts < least:
        texts, parts = texts.repartition(least), least
    total = texts.agg(F.sum(F.size(words))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = Part(size, window, seed), 0
        for batch in batches:
            lists = batch.column(0)
            coded = pc.dictionary_encode(lists.flatten())
            if len(coded):
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                token = part.numbers_of(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
                rate = max(RATE * (1 - seen * parts / total), LEAST_RATE)
                part.train(token, np.repeat(np.arange(len(lists)), lengths), rate)
                seen += len(token)
            if len(part.ids) > PART_WORDS:
                yield part.rows()
                part = Part(size, window, seed)
        yield part.rows()

    trained = texts.mapInArrow(run, "word string, vector array<double>")
    sums = trained.groupBy("word").agg(F.count("*").alias("_n"), *[F.sum(F.get("vector", F.lit(i))).alias(f"_{i}") for i in range(size)])
    return sums.select("word", F.array(*[F.col(f"_{i}") / F.col("_n") for i in range(size)]).alias("vector"))
