"""Comparing runs: scores by type, deltas, targets, retrieval and word-overlap measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselight.functions.text import tokens

# The four measures, their targets, the question types in report order.
METRICS = ["faithfulness", "answer_relevancy", "context_precision", "context_recall"]
TARGETS = {
    "faithfulness": 0.85,
    "answer_relevancy": 0.80,
    "context_precision": 0.75,
    "context_recall": 0.70,
}
QUERY_TYPES = [
    "product_factual", "policy_eligibility", "comparative_recommendation", "seller_policy", "multi_hop",
]
ARROW_STEP = 0.01


def means_by_type(scores: DataFrame, by: str, metrics: list[str] = METRICS, types: list[str] | None = None) -> DataFrame:
    """Mean of each metric per type and over all, as ``OVERALL``. Types without rows do not appear.

    With ``types`` given, ``place`` puts them in that order, the overall row last.
    """
    means = scores.rollup(by).agg(
        F.grouping(by).alias("_all"),
        F.count("*").alias("questions"),
        *[F.avg(m).alias(m) for m in metrics],
    )
    named = means.withColumn(by, F.when(F.col("_all") == 1, "OVERALL").otherwise(F.col(by)))
    if types is None:
        return named.drop("_all")
    order = F.array_position(F.array(*[F.lit(t) for t in [*types, "OVERALL"]]), F.col(by))
    return named.filter(order > 0).withColumn("place", order).drop("_all")


def compare(baseline: DataFrame, improved: DataFrame, key: str, metrics: list[str] = METRICS) -> DataFrame:
    """Baseline and improved side by side per key."""
    left = baseline.select(key, *[F.col(m).alias(f"{m}_baseline") for m in metrics])
    right = improved.select(key, *[F.col(m).alias(f"{m}_improved") for m in metrics])
    return left.join(right, key)


def arrow(delta: Column) -> Column:
    return F.when(delta > ARROW_STEP, "▲").when(delta < -ARROW_STEP, "▼").otherwise("→")


def deltas(compared: DataFrame, key: str, metrics: list[str] = METRICS) -> DataFrame:
    """(key, metric, baseline, improved, delta, arrow), one row per metric."""
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}_baseline").alias("baseline"),
                F.col(f"{m}_improved").alias("improved"),
            )
            for m in metrics
        ]
    )
    long = compared.select(key, F.explode(entries).alias("e")).select(key, "e.*")
    delta = F.col("improved") - F.col("baseline")
    return long.withColumn("delta", delta).withColumn("arrow", arrow(delta))


def override(baseline: DataFrame, improved: DataFrame, key: str, by: str, selected: list[str], columns: list[str]) -> DataFrame:
    """Improved values for the selected types, baseline for the rest and where none was re-run."""
    rerun = improved.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = baseline.join(rerun, key, "left")
    chosen = F.col(by).isin(selected)
    return joined.select(
        *[c for c in baseline.columns if c not in columns],
        *[F.coalesce(F.when(chosen, F.col(f"_{c}")), F.col(c)).alias(c) for c in columns],
    )


def against_targets(overall: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """(metric, score, target, met) from one row of means."""
    entries = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).alias("score"), F.lit(t).alias("target"))
            for m, t in targets.items()
        ]
    )
    long = overall.select(F.explode(entries).alias("e")).select("e.*")
    return long.withColumn("met", F.col("score") >= F.col("target"))


def per_question(compared: DataFrame, key: str, metrics: list[str] = METRICS) -> DataFrame:
    """Both score sets nested under each question."""
    nested = lambda kind: F.create_map(
        *[part for m in metrics for part in (F.lit(m), F.col(f"{m}_{kind}"))]
    )
    return compared.withColumns(
        {"baseline_scores": nested("baseline"), "improved_scores": nested("improved")}
    ).drop(*[f"{m}_{kind}" for m in metrics for kind in ("baseline", "improved")])


def precision_at_k(marked: DataFrame) -> DataFrame:
    """Share of relevant hits and average precision; a query has at most k rows here."""
    up_to = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.count_if("relevant").over(up_to)
    running = marked.withColumn("_at", F.when(F.col("relevant"), seen / F.col("rank")))
    return running.groupBy("query_id").agg(
        F.avg(F.col("relevant").cast("int")).alias("precision"),
        F.coalesce(F.avg("_at"), F.lit(0.0)).alias("average_precision"),
    )


def recall_at_k(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    found = marked.groupBy("query_id").agg(F.count_if("relevant").alias("_found"))
    return found.join(wanted, "query_id").select(
        "query_id", "relevant_total", (F.col("_found") / F.col("relevant_total")).alias("recall")
    )


def coverage(single: DataFrame, merged: DataFrame, names: DataFrame, name: str = "category") -> DataFrame:
    """Distinct names among the hits before and after expansion."""
    count = lambda hits, alias: hits.join(names, "id").groupBy("query_id").agg(
        F.count_distinct(name).alias(alias)
    )
    return count(single, "before_expansion").join(count(merged, "after_expansion"), "query_id")


def lexical_share(part: Column, whole: Column) -> Column:
    """Share of the distinct words of ``part`` that occur in ``whole``; 0 for a text without words.

    A plain stand-in for scores an outside judge would give.
    """
    wanted = F.array_distinct(tokens(part))
    found = F.size(F.array_intersect(wanted, tokens(whole)))
    return F.when(F.size(wanted) > 0, found / F.size(wanted)).otherwise(F.lit(0.0))


def token_usage(calls: DataFrame, kind: str) -> DataFrame:
    """Input, output and total tokens per kind of call."""
    return calls.groupBy(kind).agg(
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
    )
