"""Tickets classified by a table of 2,000 ordered rules, through the index of required literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.functions import rules
from caselight.functions.text import word_count
from caselight.operators import rule_table
from caselight.plans import tickets_data as data
from caselight.registry import query, text_literal

GENERATED = 1992  # rules after the eight fixed ones, made by the rule below
OPEN_FROM = 1984  # generated rules from here on have no literal: texts of one length made of letters and blanks
PRODUCT_WORDS = ["refund", "broken", "workshop", "immediately", "size", "bought", "box", "came"]


def _array(values: list[str]):
    return F.array(*[F.lit(v) for v in values])


def generated_rules(spark: SparkSession) -> DataFrame:
    """Rules 8 to 1999: order numbers, product phrases, customer numbers, and a few lengths without a literal."""
    i = F.col("id")
    family = i % 3
    adjective = F.get(_array(data.ADJECTIVES), (F.floor(i / 3) % 8).cast("int"))
    noun = F.get(_array(data.NOUNS), (F.floor(i / 24) % 8).cast("int"))
    word = F.get(_array(PRODUCT_WORDS), (F.floor(i / 192) % 8).cast("int"))
    pattern = (
        F.when(i >= OPEN_FROM, F.concat(F.lit("^[a-z ]{"), (10 + i % 8).cast("string"), F.lit("}$")))
        .when(family == 0, F.concat(F.lit("ord0*"), ((i * 7) % 10000).cast("string"), F.lit("\\b")))
        .when(family == 1, F.concat(adjective, F.lit(" "), noun, F.lit(".*"), word))
        .otherwise(F.concat(F.lit("cust0*"), (i % 500).cast("string"), F.lit("\\b")))
    )
    label = (
        F.when(i >= OPEN_FROM, F.lit("short_text"))
        .when(family == 0, F.lit("order_watch"))
        .when(family == 1, F.concat(F.lit("product_"), adjective, F.lit("_"), noun))
        .otherwise(F.lit("customer_watch"))
    )
    confidence = F.when(i >= OPEN_FROM, F.lit(0.5)).otherwise(F.lit(0.8))
    return spark.range(GENERATED).select(
        (i + len(rules.ISSUE_RULES)).alias("priority"), pattern.alias("pattern"), label.alias("label"), confidence.alias("confidence")
    )


def rule_set(spark: SparkSession) -> DataFrame:
    fixed = spark.createDataFrame(
        [(n, r.pattern, r.issue_type, r.confidence) for n, r in enumerate(rules.ISSUE_RULES)],
        "priority long, pattern string, label string, confidence double",
    )
    return fixed.unionByName(generated_rules(spark))


def _sql_array(values: list[str]) -> str:
    return "[" + ", ".join(text_literal(v) for v in values) + "]"


_FIXED_SQL = ", ".join(
    f"({n}, {text_literal(r.pattern)}, {text_literal(r.issue_type)}, {r.confidence}::DOUBLE)"
    for n, r in enumerate(rules.ISSUE_RULES)
)
_ADJ = f"{_sql_array(data.ADJECTIVES)}[((i // 3) % 8) + 1]"
_NOUN = f"{_sql_array(data.NOUNS)}[((i // 24) % 8) + 1]"
_WORD = f"{_sql_array(PRODUCT_WORDS)}[((i // 192) % 8) + 1]"
RULES_SQL = f"""
rules AS (
  SELECT * FROM (VALUES {_FIXED_SQL}) t(priority, pattern, label, confidence)
  UNION ALL
  SELECT i + {len(rules.ISSUE_RULES)},
         CASE WHEN i >= {OPEN_FROM} THEN '^[a-z ]{{' || (10 + i % 8)::VARCHAR || '}}$'
              WHEN i % 3 = 0 THEN 'ord0*' || ((i * 7) % 10000)::VARCHAR || '\\b'
              WHEN i % 3 = 1 THEN {_ADJ} || ' ' || {_NOUN} || '.*' || {_WORD}
              ELSE 'cust0*' || (i % 500)::VARCHAR || '\\b' END,
         CASE WHEN i >= {OPEN_FROM} THEN 'short_text' WHEN i % 3 = 0 THEN 'order_watch'
              WHEN i % 3 = 1 THEN 'product_' || {_ADJ} || '_' || {_NOUN} ELSE 'customer_watch' END,
         CASE WHEN i >= {OPEN_FROM} THEN 0.5 ELSE 0.8 END::DOUBLE
  FROM range({GENERATED}) r(i))"""

_DEFAULT_CONFIDENCE = (
    rf"CASE WHEN len(regexp_extract_all(text, '\S+')) < {rules.SHORT_TEXT_WORDS} "
    f"THEN {rules.DEFAULT_CONFIDENCE_SHORT}::DOUBLE ELSE {rules.DEFAULT_CONFIDENCE_LONG}::DOUBLE END"
)


@query(
    "ticket_classify_rules",
    f"""WITH {data.EVENT_TICKETS}, {RULES_SQL},
    hits AS (SELECT t.ticket_id, min(r.priority) AS rule_priority FROM tickets t JOIN rules r
             ON regexp_matches(lower(t.text), r.pattern) GROUP BY t.ticket_id)
    SELECT t.ticket_id, coalesce(r.label, '{rules.DEFAULT_ISSUE}') AS issue_type,
           coalesce(r.confidence, {_DEFAULT_CONFIDENCE}) AS confidence, h.rule_priority
    FROM tickets t LEFT JOIN hits h USING (ticket_id) LEFT JOIN rules r ON r.priority = h.rule_priority""",
)
def ticket_classify_rules(spark, sf_dir):
    """Every ticket of the events with the first of 2,000 rules its text holds, else the default label."""
    tickets = data.event_tickets(spark, sf_dir)
    first = rule_table.first_rule(tickets, "ticket_id", "text", rule_set(spark))
    short = word_count(F.col("text")) < rules.SHORT_TEXT_WORDS
    default = F.when(short, rules.DEFAULT_CONFIDENCE_SHORT).otherwise(rules.DEFAULT_CONFIDENCE_LONG)
    return tickets.join(first.hint("merge"), "ticket_id", "left").select(
        "ticket_id",
        F.coalesce("label", F.lit(rules.DEFAULT_ISSUE)).alias("issue_type"),
        F.coalesce("confidence", default).alias("confidence"),
        F.col("priority").alias("rule_priority"),
    )
