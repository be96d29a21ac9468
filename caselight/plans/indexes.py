"""Term indexes of the given tables: built on first use, kept in the shared folder, read afterwards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caselight.operators.term_index import TermIndex, load_term_index, save_term_index
from caselight.session import scratch_path
from caselight.sources.stores import has_rows_at, persisted, stamp

_paths: dict[tuple, str] = {}


def stored_table(spark: SparkSession, name: str, table_path: str, build: Callable[[], DataFrame], by: str) -> DataFrame:
    """A table derived from another one, stored by column ``by`` on first use; a changed source is derived anew."""
    key = (spark.sparkContext.applicationId, name, table_path, stamp(spark, table_path))
    if key not in _paths:
        _paths[key] = scratch_path(spark, name)
    return persisted(spark, _paths[key], build, by=by)


def stored_index(
    spark: SparkSession,
    name: str,
    table_path: str,
    chunks: Callable[[], DataFrame],
    stop_words: list[str] | None = None,
) -> TermIndex:
    """The index ``name`` of a table; a changed table, or a lost index, is indexed anew."""
    key = (spark.sparkContext.applicationId, name, table_path, stamp(spark, table_path))
    path = _paths.get(key)
    if path is None or not has_rows_at(spark, f"{path}/idf"):
        path = scratch_path(spark, f"index-{name}")
        save_term_index(chunks(), path, stop_words=stop_words)
        _paths[key] = path
    return load_term_index(spark, path)
