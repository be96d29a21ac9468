"""The evaluation job: a baseline, a re-run of selected types, and what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.operators import evaluation as ev


def evaluate_runs(baseline: DataFrame, rerun: DataFrame, selected: list[str]) -> dict[str, DataFrame]:
    """``by_type``, ``improved_by_type``, ``deltas`` and ``per_question`` of two runs.

    Runs have ``question, query_type, answer`` and the four measures.
    """
    columns = ["question", "query_type", "answer", *ev.METRICS]
    first = baseline.select(*columns)
    improved = ev.override(
        first, rerun.select(*columns), "question", "query_type", selected, [*ev.METRICS, "answer"]
    )
    means, better = [ev.means_by_type(run, "query_type") for run in (first, improved)]
    answers = first.select("question", "query_type", F.col("answer").alias("baseline_answer")).join(
        improved.select("question", F.col("answer").alias("improved_answer")), "question"
    )
    nested = ev.per_question(ev.compare(first, improved, "question"), "question")
    return {
        "by_type": means,
        "improved_by_type": better,
        "deltas": ev.deltas(ev.compare(means, better, "query_type"), "query_type"),
        "per_question": answers.join(nested, "question"),
    }
