"""Checked queries on evaluation runs. Labels are the questions; scores follow from document columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.operators import evaluation as ev
from caselight.plans.evaluate import evaluate_runs
from caselight.registry import query, table

M = ev.METRICS
SELECTED = ["en", "de"]

_RUNS = """
asked AS (SELECT l.doc_id AS question, d.lang AS query_type, d.n_chars, l.quality, l.toxic
  FROM labels l JOIN documents d USING (doc_id)),
baseline AS (SELECT question, query_type, (n_chars % 101) / 100 AS faithfulness,
  (n_chars % 53) / 52 AS answer_relevancy, (n_chars % 31) / 30 AS context_precision,
  (n_chars % 17) / 16 AS context_recall, 'first ' || question::VARCHAR AS answer FROM asked),
rerun AS (SELECT b.question, b.query_type,
  least(1, faithfulness + 0.1 * quality) AS faithfulness,
  greatest(0, answer_relevancy - 0.1 * toxic) AS answer_relevancy,
  least(1, context_precision + 0.002) AS context_precision,
  greatest(0, context_recall - 0.05 * quality) AS context_recall, 'second ' || b.question::VARCHAR AS answer
  FROM baseline b JOIN asked a USING (question))"""
_IMPROVED = f"""
improved AS (SELECT b.question, b.query_type, {', '.join(
    f"CASE WHEN b.query_type IN ('en', 'de') THEN r.{c} ELSE b.{c} END AS {c}" for c in [*M, 'answer'])}
  FROM baseline b JOIN rerun r USING (question))"""


def baseline(spark, sf_dir) -> DataFrame:
    n = F.col("n_chars")
    asked = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id"
    )
    return asked.select(
        F.col("doc_id").alias("question"), F.col("lang").alias("query_type"),
        (n % 101 / 100).alias("faithfulness"), (n % 53 / 52).alias("answer_relevancy"),
        (n % 31 / 30).alias("context_precision"), (n % 17 / 16).alias("context_recall"),
        F.concat(F.lit("first "), F.col("doc_id").cast("string")).alias("answer"), "quality", "toxic",
    )


def rerun(spark, sf_dir) -> DataFrame:
    """A second run of every question; which of it counts is chosen later."""
    one, zero = F.lit(1.0), F.lit(0.0)
    return baseline(spark, sf_dir).withColumns(
        {
            "faithfulness": F.least(one, F.col("faithfulness") + 0.1 * F.col("quality")),
            "answer_relevancy": F.greatest(zero, F.col("answer_relevancy") - 0.1 * F.col("toxic")),
            "context_precision": F.least(one, F.col("context_precision") + 0.002),
            "context_recall": F.greatest(zero, F.col("context_recall") - 0.05 * F.col("quality")),
            "answer": F.replace("answer", F.lit("first"), F.lit("second")),
        }
    )


def improved(spark, sf_dir) -> DataFrame:
    return ev.override(
        baseline(spark, sf_dir), rerun(spark, sf_dir), "question", "query_type", SELECTED, [*M, "answer"]
    )


def _rounded(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


_MEANS = ", ".join(f"round(avg({m}), 6) AS {m}" for m in M)


@query(
    "eval_by_type",
    f"""WITH {_RUNS} SELECT coalesce(query_type, 'OVERALL') AS query_type, count(*) AS questions, {_MEANS},
      CASE coalesce(query_type, 'OVERALL') WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 WHEN 'es' THEN 4
        ELSE 6 END::BIGINT AS place FROM baseline GROUP BY ROLLUP (query_type)""",
)
def eval_by_type(spark, sf_dir):
    """In a fixed order of types; ``it`` has no question and is left out."""
    means = ev.means_by_type(baseline(spark, sf_dir), "query_type", types=["en", "de", "fr", "es", "it"])
    return means.select("query_type", "questions", *_rounded(*M), "place")


@query("golden_counts", f"WITH {_RUNS} SELECT query_type, count(*) AS questions FROM asked GROUP BY query_type")
def golden_counts(spark, sf_dir):
    return baseline(spark, sf_dir).groupBy("query_type").agg(F.count("*").alias("questions"))


@query(
    "eval_compare",
    f"""WITH {_RUNS} SELECT question, {', '.join(
      f'round(b.{m}, 6) AS {m}_baseline, round(r.{m}, 6) AS {m}_improved' for m in M)}
      FROM baseline b JOIN rerun r USING (question)""",
)
def eval_compare(spark, sf_dir):
    compared = ev.compare(baseline(spark, sf_dir), rerun(spark, sf_dir), "question")
    return compared.select("question", *_rounded(*[c for c in compared.columns if c != "question"]))


@query(
    "selective_override",
    f"WITH {_RUNS}, {_IMPROVED} SELECT question, query_type, answer, {', '.join(f'round({m}, 6) AS {m}' for m in M)} FROM improved",
)
def selective_override(spark, sf_dir):
    return improved(spark, sf_dir).select("question", "query_type", "answer", *_rounded(*M))


_TYPE_MEANS = f"""
b AS (SELECT coalesce(query_type, 'OVERALL') AS query_type, {', '.join(f'avg({m}) AS {m}' for m in M)}
  FROM baseline GROUP BY ROLLUP (query_type)),
i AS (SELECT coalesce(query_type, 'OVERALL') AS query_type, {', '.join(f'avg({m}) AS {m}' for m in M)}
  FROM improved GROUP BY ROLLUP (query_type)),
long AS ({' UNION ALL '.join(
    f"SELECT query_type, '{m}' AS metric, b.{m} AS baseline, i.{m} AS improved FROM b JOIN i USING (query_type)"
    for m in M)})"""
_DELTA = """SELECT query_type, metric, round(baseline, 6) AS baseline, round(improved, 6) AS improved,
  round(improved - baseline, 6) AS delta,
  CASE WHEN improved - baseline > 0.01 THEN '▲' WHEN improved - baseline < -0.01 THEN '▼' ELSE '→' END AS arrow
  FROM long"""


@query("eval_delta", f"WITH {_RUNS}, {_IMPROVED}, {_TYPE_MEANS} {_DELTA}")
def eval_delta(spark, sf_dir):
    means = [ev.means_by_type(d, "query_type") for d in (baseline(spark, sf_dir), improved(spark, sf_dir))]
    found = ev.deltas(ev.compare(*means, "query_type"), "query_type")
    return found.select("query_type", "metric", *_rounded("baseline", "improved", "delta"), "arrow")


@query(
    "eval_targets",
    f"""WITH {_RUNS}, m AS (SELECT {', '.join(f'avg({m}) AS {m}' for m in M)} FROM baseline)
      {' UNION ALL '.join(
        f"SELECT '{m}' AS metric, round({m}, 6) AS score, {t}::DOUBLE AS target, {m} >= {t} AS met FROM m"
        for m, t in ev.TARGETS.items())}""",
)
def eval_targets(spark, sf_dir):
    overall = baseline(spark, sf_dir).agg(*[F.avg(m).alias(m) for m in M])
    return ev.against_targets(overall).select("metric", F.round("score", 6).alias("score"), "target", "met")


@query(
    "eval_per_question",
    f"""WITH {_RUNS}, {_IMPROVED} SELECT question, b.query_type, b.answer AS baseline_answer,
      i.answer AS improved_answer, round(b.faithfulness, 6) AS baseline_faithfulness,
      round(i.faithfulness, 6) AS improved_faithfulness, 4::BIGINT AS metrics
      FROM baseline b JOIN improved i USING (question)""",
)
def eval_per_question(spark, sf_dir):
    records = evaluate_runs(
        baseline(spark, sf_dir), rerun(spark, sf_dir), SELECTED
    )["per_question"]
    return records.select(
        "question", "query_type", "baseline_answer", "improved_answer",
        F.round(F.col("baseline_scores")["faithfulness"], 6).alias("baseline_faithfulness"),
        F.round(F.col("improved_scores")["faithfulness"], 6).alias("improved_faithfulness"),
        F.size("baseline_scores").cast("long").alias("metrics"),
    )


@query(
    "eval_job",
    f"WITH {_RUNS}, {_IMPROVED}, {_TYPE_MEANS} {_DELTA}",
)
def eval_job(spark, sf_dir):
    """Both runs with the selected types re-run: means and deltas by type and overall."""
    found = evaluate_runs(baseline(spark, sf_dir), rerun(spark, sf_dir), SELECTED)["deltas"]
    return found.select("query_type", "metric", *_rounded("baseline", "improved", "delta"), "arrow")
