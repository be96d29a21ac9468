"""Places where a model is plugged in: batched functions on executors, rules by default."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.operators import word_training

BATCH_ROWS = 64  # fixed value: texts handed to a model at once

EmbedFn = Callable[[list[str]], np.ndarray]


def hashed_words(texts: list[str], dimensions: int = 64) -> np.ndarray:
    """Signed word counts by hash, unit length: needs no model and no network.

    The first 32 bits of a word's MD5 give its place, and their highest bit its sign. Words are hashed once per batch.
    """
    counts = [Counter(text.lower().split()) for text in texts]
    codes = {w: int(hashlib.md5(w.encode("utf-8")).hexdigest()[:8], 16) for w in set().union(*counts)}
    out = np.zeros((len(texts), dimensions))
    for row, held in enumerate(counts):
        known = np.fromiter((codes[w] for w in held), dtype=np.int64, count=len(held))
        sign = np.where(known & 0x80000000, 1.0, -1.0)
        np.add.at(out[row], known % dimensions, sign * np.fromiter(held.values(), dtype=float, count=len(held)))
    norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def embed(
    rows: DataFrame, text: str, embed_fn: EmbedFn = hashed_words, batch_rows: int = BATCH_ROWS, number: str = "float"
) -> DataFrame:
    """Adds ``embedding``, an array of ``number``. ``embed_fn`` is sent to the tasks and called once per batch."""
    kind = np.float32 if number == "float" else np.float64

    @F.pandas_udf(f"array<{number}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            vectors = []
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start : start + batch_rows].fillna("").tolist()
                vectors.extend(np.asarray(embed_fn(part), dtype=kind))
            yield pd.Series(vectors, index=batch.index)

    return rows.withColumn("embedding", run(F.col(text)))


def classify_with(rows: DataFrame, text: str, classify_fn: Callable[[list[str]], list[str]], name: str) -> DataFrame:
    """Adds the label a plugged-in classifier gives each text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(classify_fn(batch.fillna("").tolist()), index=batch.index)

    return rows.withColumn(name, run(F.col(text)))


def score_with(
    pairs: DataFrame, left: str, right: str, score_fn: Callable[[list[str], list[str]], list[float]],
    name: str = "score", right_chars: int | None = None,
) -> DataFrame:
    """Adds a second-stage score of (query, text) pairs; ``right_chars`` is the input limit of a model
    that has one."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for asked, found in batches:
            # Not by ``found.str``: a series and its accessor hold each other, so batches would pile up in the worker.
            texts = [text[:right_chars] if isinstance(text, str) else text for text in found.tolist()]
            yield pd.Series(score_fn(asked.tolist(), texts), index=asked.index)

    return pairs.withColumn(name, run(F.col(left), F.col(right)))


def word_vectors(rows: DataFrame, words: str, size: int = 10, window: int = 5, min_count: int = 1, seed: int = 7, partitions: int | None = None) -> DataFrame:
    """(word, vector) trained on arrays of words; words that come less than ``min_count`` times are left out."""
    kept = word_training.frequent_words(rows, words, min_count) if min_count > 1 else rows
    return word_training.train(kept, words, size, window, seed, partitions)
