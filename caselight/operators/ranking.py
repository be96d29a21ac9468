"""First rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP = 1e9  # scores are ranked in whole steps of 1e-9, so that ties do not hang on summation order


def rank_key(score: Column) -> Column:
    return F.floor(score * STEP + 0.5)


def keep_first(rows: DataFrame, keys: list[str], order: list[Column], k: int | Column) -> DataFrame:
    """Adds ``rank`` and keeps the rows with ``rank <= k``.

    The filter stands directly on the row number: with a plain k, Spark then cuts every task's rows to
    k per key before the exchange and again after it.
    """
    numbered = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    limit = F.lit(k) if isinstance(k, int) else k
    return numbered.filter(F.col("rank") <= limit).withColumn("rank", F.col("rank").cast("long"))
