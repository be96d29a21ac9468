"""Rule tables: the literal index finds exactly the first rule that a plain CASE finds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caselight.functions import rules
from caselight.operators import rule_table
from caselight.plans import rule_queries
from caselight.plans import tickets_data as data

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "pattern,runs",
    [
        (r"don'?t recognize", [["don", "t recognize"]]),
        (r"ord0*123\b", [["ord", "123"]]),
        (r"a[]b]cde|x(y|z)?www", [["a", "cde"], ["x", "www"]]),
        (r"(double check|make sure).*(charge)", [[]]),
        (r"ab+c{2,3}d*?e", [["ab", "e"]]),
    ],
)
def test_required_runs(pattern, runs):
    assert [rule_table.required_runs(a) for a in rule_table.alternatives(pattern)] == runs


def test_fixed_rules_alone_equal_the_case_chain(spark):
    tickets = data.event_tickets(spark, SF)
    fixed = rule_queries.rule_set(spark).filter(F.col("priority") < len(rules.ISSUE_RULES))
    found = rule_table.first_rule(tickets, "ticket_id", "text", fixed)
    mine = tickets.join(found, "ticket_id", "left").select("ticket_id", F.coalesce("label", F.lit(rules.DEFAULT_ISSUE)).alias("t"))
    plain = tickets.select("ticket_id", rules.issue(F.col("text"))["issue_type"].alias("t"))
    assert mine.exceptAll(plain).count() == 0 and plain.exceptAll(mine).count() == 0


def test_against_every_rule_on_every_text(spark):
    texts = [
        (1, "Refund for the SMALL ring please"), (2, None), (3, "quick question"), (4, ""),
        (5, "order ord0000070 is late"), (6, "x" * 50_000 + " broken"), (7, "can't login to the media page"),
        (8, "nothing at all here"),
    ]
    frame = spark.createDataFrame(texts, "ticket_id long, text string")
    table = rule_queries.rule_set(spark)
    got = {r.ticket_id: r.priority for r in rule_table.first_rule(frame, "ticket_id", "text", table).collect()}
    import re

    every = sorted((r.priority, r.pattern) for r in table.collect())
    for key, text in texts:
        want = next((p for p, pattern in every if text is not None and re.search(pattern, text.lower())), None)
        assert got.get(key) == want, (key, text)


def test_plan_has_no_pair_of_every_text_and_rule(spark):
    plan = rule_queries.ticket_classify_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_no_exploded_texts_are_sent(spark):
    lines = rule_queries.ticket_classify_rules(spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            assert not any("FileScan" in inner for inner in lines[n:below])


def test_rules_with_many_trigrams_are_met_in_an_exchange(spark, monkeypatch):
    monkeypatch.setattr(rule_table, "MOST_SENT", 10)
    tickets = data.event_tickets(spark, SF)
    many = rule_table.first_rule(tickets, "ticket_id", "text", rule_queries.rule_set(spark))
    monkeypatch.undo()
    few = rule_table.first_rule(tickets, "ticket_id", "text", rule_queries.rule_set(spark))
    assert many.exceptAll(few).count() == 0 and few.exceptAll(many).count() == 0
