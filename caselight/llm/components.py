"""Connected components of a table of links, by alternating stars.

In a large star every id hands its larger neighbours to the least id it knows; in a small star every id joins itself and
its smaller neighbours to their least. The links get shorter until each component is a star around its least id, after a
number of rounds that grows with the logarithm of the component. Each round is written to the shared folder. Links are
grouped by partial aggregates and joins only, so an id with very many links is no single task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import stored


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the links (a, b) but the least of each component, which is its name."""
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(down.distinct(), "links")
    sign = _sign(now)
    while sign[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written apart, so that the join below meets two plain exchanges and can split an id with very many links.
        least = stored(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        now = stored(small.select("e.a", "e.b").filter("a <> b").distinct(), "links")
        sign, before = _sign(now), sign
        if sign == before:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """(row, least row of its component) of a symmetric boolean matrix, for rows that are not the least."""
    own = np.arange(len(linked))
    while True:
        near = [own[row].min(initial=len(own)) for row in linked]
        least = np.minimum(own, np.array(near, dtype=own.dtype))
        least = least[least]
        if (least == own).all():
            return [(i, int(least[i])) for i in np.flatnonzero(least != np.arange(len(own)))]
        own = least
