"""Toxicity: held-out separation, single planted words in long texts, and odd input."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from caselight.llm import toxicity as T
from caselight.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def area(scores, labels):
    order = pd.Series(scores).rank()
    positive = labels == 1
    n, m = positive.sum(), (~positive).sum()
    return (order[positive].sum() - n * (n + 1) / 2) / (n * m)


def test_held_out_documents(spark):
    found = QUERIES["op3_toxicity"](spark, SF).toPandas()
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    assert len(found) == len(pd.read_parquet(f"{SF}/documents.parquet"))
    held = found[found.held_out].merge(labels, on="doc_id")
    assert area(held["score"].to_numpy(), held["toxic"].to_numpy()) > 0.93
    assert found["score"].between(0, 1).all()
    assert ((found["score"] >= 0.3).astype(int) == found["predicted"]).all()


def test_gain_of_a_toxic_word_anywhere(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = T.train(documents, labels, F.lit(True))
    gains = T.Gains(model)
    plain = "the and of erth thing " * 3000
    clean, planted = gains.inputs(plain), gains.inputs(plain + " worthless")
    gain = lambda w: gains.lengths(w)[0] - gains.lengths(w)[1]
    assert gain(b"worthless") > max(gain(w) for w in T.words(plain))
    assert planted[:-1] > clean[:-1]


def test_odd_input(spark):
    words = ["fine", "good", "nice", "calm", "warm", "kind"]
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(400):
        text = " ".join(rng.choice(words, 12)) + f" {rng.choice(words)}{i % 7}" + (" nastyword" if i % 4 == 0 else f" {rng.choice(words)}")
        rows.append((i, text + " " + rng.choice(words), "x", 0.5))
        marks.append((i, int(i % 4 == 0), None))
    schema = "doc_id long, text string, toxic string, score double"
    labels = spark.createDataFrame([*marks, (None, 1, 0), (5000, None, 1)], "doc_id long, toxic int, text int")
    documents = spark.createDataFrame(rows, schema)
    model = T.train(documents, labels, F.lit(True))
    odd = spark.createDataFrame([(1, None, "x", 0.1), (2, "", "x", 0.1), (2, "", "x", 0.1), (3, "NASTYWORD", None, None), (4, "fine " * 50_000, None, None)], schema)
    got = sorted(map(tuple, T.score(odd, model).collect()))
    assert len(got) == 5 and got[1] == got[2] and got[0][1] == got[1][1]
    assert got[3][1] > 0.5 > got[4][1]
    assert T.score(odd.limit(0), model).count() == 0
    unlabelled = T.train(documents, labels.limit(0), F.lit(True))
    assert {r.score for r in T.score(odd, unlabelled).collect()} == {0.0}
