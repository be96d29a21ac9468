"""Word vectors are trained in parts; no vocabulary stands in one place."""

import inspect

import numpy as np
from pyspark.sql import functions as F

from caselight.operators import hooks, word_training


def _vectors(spark, rows, **options):
    frame = spark.createDataFrame([(r,) for r in rows], "words array<string>")
    found = hooks.word_vectors(frame, "words", **options).collect()
    return found, {r.word: np.array(r.vector) for r in found}


def test_every_word_once_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(word_training, "PART_WORDS", 20)
    rows = [[f"w{i}", f"w{i + 1}", "both"] for i in range(200)] + [None, [], [None, "alone"], ["both"]]
    found, vectors = _vectors(spark, rows, partitions=3)
    assert len(found) == len(vectors) == 203  # w0 to w200, both, alone
    assert all(v.shape == (10,) and np.isfinite(v).all() for v in vectors.values())


def test_words_of_the_same_company_are_alike(spark):
    rng = np.random.default_rng(1)
    groups = [[f"{g}{i}" for i in range(8)] for g in "ab"]
    rows = [[str(w) for w in rng.choice(groups[i % 2], 12)] for i in range(2000)]
    _, vectors = _vectors(spark, rows, partitions=2)
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    within = np.mean([unit["a0"] @ unit[f"a{i}"] for i in range(1, 8)])
    across = np.mean([unit["a0"] @ unit[f"b{i}"] for i in range(8)])
    assert within > across + 0.2


def test_rare_words_are_left_out_before_windows(spark):
    rows = [["x", "rare", "y"], ["x", "y"], ["y", "x", None]]
    found, _ = _vectors(spark, rows, min_count=3)
    assert sorted(r.word for r in found) == ["x", "y"]
    frame = spark.createDataFrame([(r,) for r in rows], "words array<string>")
    kept = word_training.frequent_words(frame, "words", 3).collect()
    assert sorted(r.words for r in kept) == [["x", "y"], ["x", "y"], ["y", "x"]]


def test_no_words_give_no_rows(spark):
    assert _vectors(spark, [None, []])[0] == []


def test_no_vocabulary_on_the_driver(spark):
    """Spark's Word2Vec collects the vocabulary; averaging by word is left to an exchange."""
    frame = spark.range(100).select(F.array(F.col("id").cast("string"), F.lit("x")).alias("words"))
    plan = hooks.word_vectors(frame, "words")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning(word" in plan
    assert "Word2Vec(" not in inspect.getsource(hooks)
