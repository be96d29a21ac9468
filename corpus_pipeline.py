"""From raw documents to packed token sequences: language, toxicity, near-copies, packing.

Each stage takes (spark, documents so far, folder of the tables); its result is written and read again as the next
stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.llm import language_id, minhash_dedup, packing, toxicity
from caselight.llm.common import prepare, stored, table

LEAST_LANGUAGE_SCORE = 0.35  # below it no language stands out
TOXIC_FROM = 0.3
LEAST_PERCENT_ALIKE = 75
SEQUENCE_TOKENS = 2048


def _remainder(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in which no language is recognised, go."""
    prepare(spark)
    model = language_id.train(docs, learn=_remainder(3) != 1)
    return language_id.keep_known(docs, model, LEAST_LANGUAGE_SCORE)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    prepare(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=_remainder(4) != 2)
    return toxicity.keep_clean(docs, model, TOXIC_FROM)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays."""
    prepare(spark)
    return minhash_dedup.keep_one(docs, LEAST_PERCENT_ALIKE)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of tokens."""
    prepare(spark)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    pieces = packing.token_pieces(docs, vocabulary, public_tokenizers.PATTERN, SEQUENCE_TOKENS, end_id=0)
    return packing.pack(stored(pieces, "pieces"), capacity=SEQUENCE_TOKENS)


STAGES = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("minhash_near_dedup", one_of_each),
    ("best_fit_packing", packed),
]

#: No stage but the filters' shape can be said in SQL (a network, a compressor, a tokenizer); see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
