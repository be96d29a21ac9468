"""The eleven queries are there, read whole tables and keep their columns."""

import pytest

import __spark_entry__ as contract
from caselight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op2": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op8": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op12": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op13": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
}
ROWS = {"op1": "documents", "op2": "pages", "op3": "documents", "op4": "documents", "op6": "embeddings", "op9": "documents", "op10": "documents", "op11": "documents", "op13": "documents"}


def test_registered_in_the_contract():
    found = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert {n.split("_")[0] for n in QUERIES} == set(COLUMNS)
    assert set(contract.oracle_sql()) <= set(found)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    short = name.split("_")[0]
    frame = QUERIES[name](spark, SF)
    assert dict(frame.dtypes) == COLUMNS[short]
    rows = frame.count()
    if short in ROWS:
        assert rows == spark.read.parquet(f"{SF}/{ROWS[short]}.parquet").count()
