"""Joins by key: lookups with missing keys, parent checks, first-arrival inserts.

A single hot key is split by adaptive execution, which ``session.tune`` forces for skewed joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def spread_nulls(key: Column, *row_key: Column, buckets: int = 1024) -> Column:
    """``key``, or for a null key one of many values that match nothing.

    Left joins keep rows without a key; hashing them all alike would put them in one task.
    """
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*row_key), F.lit(buckets)).cast("string"))
    return F.coalesce(key, filler)


def left_lookup(rows: DataFrame, lookup: DataFrame, key: str, row_key: str, *more: DataFrame) -> DataFrame:
    """Left join on a nullable string key that is unique in ``lookup``; ``more`` lookups by it need no further exchange of rows."""
    found = rows.withColumn("_key", spread_nulls(F.col(key), F.col(row_key)))
    for each in (lookup, *more):
        found = found.join(each.withColumnRenamed(key, "_key"), "_key", "left")
    return found.drop("_key")


def missing_parents(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row; null keys are no violation."""
    keys = parents.select(F.col(parent_key).alias(child_key))
    return children.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def without_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    keys = children.select(F.col(child_key).alias(parent_key)).distinct()
    return parents.join(keys, parent_key, "left_anti")


def insert_or_ignore(target: DataFrame, incoming: DataFrame, key: str, arrival: str) -> DataFrame:
    """Target rows kept, plus the first arriving row of each new key."""
    columns = [c for c in target.columns if c != key]
    first = incoming.groupBy(key).agg(
        F.min_by(F.struct(*columns), F.col(arrival)).alias("_row")
    )
    fresh = first.join(target.select(key), key, "left_anti").select(key, "_row.*")
    return target.unionByName(fresh)
