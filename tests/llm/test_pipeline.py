"""The pipeline against a brute-force version of each stage on its own input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from caselight.llm import byte_bpe, language_id, packing, toxicity
from tests.llm.test_minhash_dedup import brute
from tests.llm.test_packing import VOCABULARY, best_fit_decreasing, check

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input rows, output rows) of each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 400")
    odd = [(10_001, None, "en", "x", 0), (10_002, "", "en", "x", 0), (10_003, "12 34 !!", None, None, 7), (10_004, "The and of " * 5000, "en", "x", 1), (10_004, "The and of " * 5000, "en", "x", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("score", F.lit("extra")).withColumn("inputs", F.lit(1))
    from caselight.llm.common import stored

    found = []
    for name, stage in P.STAGES:
        out = stored(stage(spark, docs, SF), "test-stage")
        found.append((name, docs, out))
        docs = out
    return found


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay_until_the_last_stage(stages):
    for _, before, after in stages[:-1]:
        assert before.dtypes == after.dtypes
        assert after.exceptAll(before).count() == 0  # filters change nothing in a row


def test_language_stage(stages):
    _, before, after = stages[0]
    model = language_id.train(before, P._remainder(3) != 1)
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    want = [k for k, t in rows if (p := language_id.predict(model, [t])[0])[0] != "und" and p[1] >= P.LEAST_LANGUAGE_SCORE]
    assert ids(after) == sorted(want)
    assert not {10_001, 10_002, 10_003} & set(ids(after))
    assert len(want) > 0.97 * len(rows)


def test_toxicity_stage(spark, stages):
    _, before, after = stages[1]
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"), P._remainder(4) != 2)
    gains = toxicity.Gains(model)
    want = []
    for r in before.select("doc_id", "text").collect():
        x = np.clip((np.array(gains.inputs(r.text)) - model.centre) / model.scale, -toxicity.REACH, toxicity.REACH)
        if 1 / (1 + np.exp(-(x @ np.array(model.weights[:-1]) + model.weights[-1]))) < P.TOXIC_FROM:
            want.append(r.doc_id)
    assert ids(after) == sorted(want)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [k for k in ids(before) if labels.get(k) == 0]
    assert len(set(clean) & set(want)) > 0.95 * len(clean)


def test_near_copy_stage(stages):
    _, before, after = stages[2]
    rows = sorted({(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()})
    assert ids(after) == sorted(k for k, _, c in brute(rows) if k == c)


def test_packing_stage(stages):
    _, before, after = stages[3]
    bpe = byte_bpe.ByteBPE(VOCABULARY, P.public_tokenizers.PATTERN)
    lengths = []
    for r in before.select("text").collect():
        lengths += [n for _, n in packing.piece_bounds(len(bpe.encode(r.text)) // 4 + 1, P.SEQUENCE_TOKENS)]
    rows = after.collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    assert check(rows, P.SEQUENCE_TOKENS) == best_fit_decreasing(lengths, P.SEQUENCE_TOKENS)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
