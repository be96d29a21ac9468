"""Registered queries against their SQL twins; ``CASELIGHT_ALL=1`` runs every one of them."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from tools.check_queries import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "ticket_case_report", "case_summary_cube", "customer_context", "prior_ticket_count", "insert_or_ignore",
    "row_chunks", "html_article", "recursive_chunks", "md_header_path", "budget_select", "tfidf_topk_scoped",
    "retrieve_context", "hybrid_union", "vector_topk_filtered", "multi_query_merge", "semantic_reuse", "ann_recall",
    "slot_fill", "stream_slot_fill", "memory_switch", "fenced_json_parse", "eval_job", "nucleus_share",
    "weighted_sample", "stream_volume", "ticket_classify_rules",
]
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE) if os.environ.get("CASELIGHT_ALL") else SAMPLE)
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, SF)
    result = db.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())


def test_every_sql_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_pca_against_numpy(spark):
    import numpy as np

    found = QUERIES["pca_2d"](spark, SF).orderBy("id").toPandas()
    vectors = np.stack(spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").toPandas()["embedding"]).astype(float)
    values, directions = np.linalg.eigh(np.cov(vectors.T))
    share = values[::-1] / values.sum()
    assert found["explained_1"][0] == pytest.approx(share[0], abs=1e-6)
    assert found["explained_2"][0] == pytest.approx(share[1], abs=1e-6)
    first = vectors @ directions[:, -1]
    assert np.allclose(np.abs(found["pc1"]), np.abs(first), atol=1e-6)


def test_paragraph_query_keeps_every_paragraph(spark):
    from pyspark.sql import functions as F

    chunks = QUERIES["para_chunks"](spark, SF)
    held = chunks.groupBy("doc_id").agg(F.array_join(F.collect_list("chunk"), "\n").alias("all"))
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    lines = documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter(F.length(F.trim("line")) > 0)
    lost = lines.join(held, "doc_id", "left").filter(~F.contains("all", F.trim("line")))
    assert lost.count() == 0
