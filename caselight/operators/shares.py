"""Shares of weighted items per group: cuts, rescaling, sampling, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselight.operators.conversation import in_parts, join_nulls_too, split_running
from caselight.operators.ranking import keep_first


def _with_total(rows: DataFrame, group: str, weight: str, total: str = "_total") -> DataFrame:
    """Adds the group's sum by a folded aggregate and a join, not by a window over the group."""
    totals = rows.groupBy(group).agg(F.sum(weight).alias(total))
    return join_nulls_too(rows, totals, [group])


def top_k_share(items: DataFrame, group: str, item: str, weight: str, k: int) -> DataFrame:
    """The k heaviest items per group with their renormalised ``share``."""
    kept = keep_first(items, [group], [F.col(weight).desc(), F.col(item)], k)
    whole = Window.partitionBy(group)  # at most k rows
    return kept.withColumn("share", F.col(weight) / F.sum(weight).over(whole))


def nucleus_share(items: DataFrame, group: str, item: str, weight: str, p: float, blocks: int | None = None) -> DataFrame:
    """Fewest heaviest items per group whose share reaches p, renormalised.

    Items are range-partitioned by group and falling weight, so that one group may span many
    tasks; the partition number is then the block of a two-level running sum. The result of the
    range partitioning is fixed first, because both levels must see the same borders.
    """
    shared = _with_total(items, group, weight).withColumn("_share", F.col(weight) / F.col("_total"))
    fixed = in_parts(shared.withColumn("_falling", -F.col(weight)), [group], ["_falling", item], blocks)
    running = split_running(fixed, [group], ["_falling", item], F.col("_part"), sums=["_share"])
    # Kept while the items before have not reached p; the first one always is.
    # One part in 1e12 absorbs the error of summing in blocks.
    before = F.col("_share_running") - F.col("_share")
    kept = running.filter(before < p - 1e-12).select(group, item, weight)
    return _with_total(kept, group, weight).withColumn("share", F.col(weight) / F.col("_total")).drop("_total")


def temperature_share(items: DataFrame, group: str, weight: str, temperature: float) -> DataFrame:
    """``share ** (1 / temperature)`` renormalised per group; shares are clipped at 1e-10."""
    shared = _with_total(items, group, weight).withColumn(
        "_log", F.ln(F.greatest(F.col(weight) / F.col("_total"), F.lit(1e-10))) / temperature
    )
    peaks = shared.groupBy(group).agg(F.max("_log").alias("_peak"))
    scaled = join_nulls_too(shared, peaks, [group]).withColumn("_scaled", F.exp(F.col("_log") - F.col("_peak")))
    return (
        _with_total(scaled, group, "_scaled", "_sum")
        .withColumn("share", F.col("_scaled") / F.col("_sum"))
        .drop("_total", "_log", "_peak", "_scaled", "_sum")
    )


def seeded_uniform(seed: int, *key: Column) -> Column:
    """A number in (0, 1) that depends on seed and key only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *key))
    whole = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (whole + 0.5) / float(16**13)


def weighted_sample(items: DataFrame, group: str, item: str, weight: str, n: int, seed: int = 7) -> DataFrame:
    """n items per group without replacement, drawn in proportion to their weight."""
    u = seeded_uniform(seed, F.col(group).cast("string"), F.col(item).cast("string"))
    drawn = items.filter(F.col(weight) > 0).withColumn("_draw", -F.ln(u) / F.col(weight))
    return keep_first(drawn, [group], [F.col("_draw"), F.col(item)], n).drop("_draw")


def budget_select(rows: DataFrame, group: str, order: str, cost: str, budget: int) -> DataFrame:
    """Rows in order while their running cost fits.

    Every row costs at least 1, so no more than the first ``budget`` rows of a group can fit; that
    bound is exact and keeps a large group out of one task.
    """
    priced = rows.withColumn(cost, F.greatest(F.col(cost), F.lit(1)))
    first = keep_first(priced, [group], [F.col(order)], budget)
    running = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        first.withColumn(f"{cost}_so_far", F.sum(cost).over(running))
        .filter(F.col(f"{cost}_so_far") <= budget)
        .drop("rank")
    )
