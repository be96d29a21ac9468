"""Where the checked queries and their SQL twins are kept, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caselight.session import SPREAD_SETTING, spread_small_scan, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)`` under ``name``, with the SQL that must give the same rows."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_small_scan(found, name, sf_dir) if spark.conf.get(SPREAD_SETTING, "false") == "true" else found


def text_literal(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("'", "''") + "'"
