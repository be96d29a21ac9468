"""Ticket scenarios, gates and accounts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselight.functions import rules
from caselight.operators import joins, term_index, triage
from caselight.operators.chunking import md_sections
from caselight.operators.term_index import build_term_index

# The scenarios and the paths they must take.
SCENARIOS = [
    ("T001", "CUST001", "Hi, can you tell me the status of my recent order? It hasn't arrived yet.", "auto_resolved"),
    ("T002", "CUST003", "I'd like a refund for my recent purchase, it doesn't fit well.", "auto_resolved"),
    ("T003", "CUST002", "I want a refund on my recent order please.", "escalated"),
    ("T004", "CUST005", "There's a transaction on my account that I don't recognize at all.", "escalated"),
    (
        "T005", "CUST005",
        "Hey, quick one - I noticed a small charge on my account, just wanted to double check, "
        "I'm not sure it was me.",
        "escalated",
    ),
    ("T006", "CUST006", "hey issue", "escalated"),
    (
        "T007", "CUST004",
        "This is absolutely unacceptable, I am furious about how this has been handled, I want a manager.",
        "escalated",
    ),
    ("T008", "CUST011", "Do you sell products in other countries besides India?", "auto_resolved"),
]
POLICIES = {
    "refund_rules.md": "# Refunds\nintro\n\n## Returning a purchase\nA refund is paid within a week.\n"
    "\n## Large amounts\nRefunds of large orders are looked at by a person.",
    "delivery_rules.md": "# Delivery\n\n## Lost parcels\nA parcel without news for five days counts as lost.",
    "escalation_criteria.md": "# Internal\n\n## Refund escalation\nRefund refund refund purchase.",
}


@pytest.fixture(scope="module")
def world(spark):
    accounts = spark.createDataFrame(
        [(f"CUST{i:03d}", f"Name{i} Family", "good") for i in range(1, 12)], "customer_id string, name string, standing string"
    )
    rows, number = [], 1
    for i in range(1, 11):
        for j in range(1 if i == 2 else 5):
            amount = 6500.0 if i == 2 else float(300 + number * 137 % 4000)
            rows.append((f"ORD{number:04d}", f"CUST{i:03d}", amount, dt.date(2025, j % 6 + 1, 10)))
            number += 1
    orders = spark.createDataFrame(rows, "order_id string, customer_id string, amount double, order_date date")
    files = spark.createDataFrame(list(POLICIES.items()), "source string, text string")
    sections = files.select("source", F.posexplode(md_sections(F.col("text"))).alias("ordinal", "s"))
    chunks = sections.select("source", F.col("ordinal").cast("long").alias("ordinal"), "s.section", "s.text")
    return accounts, orders, chunks


def reports_of(spark, world, tickets):
    accounts, orders, chunks = world
    frame = spark.createDataFrame(tickets, "ticket_id string, customer_id string, text string")
    return triage.case_reports(
        frame, accounts, orders, chunks, build_term_index(chunks, stop_words=["the", "of", "a", "is", "my", "for"]),
        internal_source="escalation_criteria.md", stop_words=["the", "of", "a", "is", "my", "for"],
    )


def test_scenarios_take_their_path(spark, world):
    rows = reports_of(spark, world, [s[:3] for s in SCENARIOS]).collect()
    assert {r.ticket_id: r.resolution_path for r in rows} == {s[0]: s[3] for s in SCENARIOS}
    by_id = {r.ticket_id: r for r in rows}
    assert by_id["T003"].escalation.escalation_type == "hard_category"
    assert by_id["T003"].order_amount == 6500.0
    assert by_id["T006"].escalation.escalation_type == "low_confidence"
    assert by_id["T004"].issue_type == by_id["T005"].issue_type == "fraud_suspected"
    assert by_id["T002"].hits[0].source == "refund_rules.md"
    assert all(h.source != "escalation_criteria.md" for r in rows for h in r.hits)
    assert by_id["T002"].draft == (
        "Hi Name3, Thanks for reaching out. Based on our policy (refund rules): "
        "A refund is paid within a week. Let us know if you have further questions."
    )


def test_missing_customer_and_foreign_order(spark, world):
    rows = reports_of(
        spark, world,
        [
            ("A", None, "Where is my order? I am cust004, order ord0001 is late today."),
            ("B", "CUST999", "Where is my order, it should have been here long ago?"),
            ("C", "CUST001", "Where is my order ORD0002, it should have been here?"),
        ],
    ).collect()
    by_id = {r.ticket_id: r for r in rows}
    assert by_id["A"].customer_id == "CUST004" and by_id["A"].customer_context_found
    assert by_id["A"].order_amount == 300 + 16 * 137 % 4000  # not the owner: the latest order counts
    assert not by_id["B"].customer_context_found and by_id["B"].order_amount == 0.0
    assert by_id["B"].draft.startswith("Hi there,")
    assert by_id["C"].order_amount == 300 + 2 * 137


def test_no_knowledge_fails_validation(spark, world):
    accounts, orders, chunks = world
    tickets = spark.createDataFrame(
        [("T", "CUST003", "I'd like a refund for my recent purchase, it doesn't fit well.")],
        "ticket_id string, customer_id string, text string",
    )
    none = chunks.limit(0)
    row = triage.case_reports(tickets, accounts, orders, none, build_term_index(none)).collect()[0]
    assert row.escalation.escalation_type == "validation_failed"
    assert row.issues_found == [triage.ISSUE_NO_GROUNDING]


def test_tickets_are_not_exchanged_by_id_or_twice_by_customer(spark, world):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reports_of(spark, world, [s[:3] for s in SCENARIOS])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(ticket_id" not in plan
    # Exchanges by key: tickets and lookup for the order, for the customer (tickets, accounts, orders) and for the words.
    assert plan.count("hashpartitioning(_key") <= 6


def test_known_words_in_the_row_and_by_exchange_are_the_same(spark, world, monkeypatch):
    tickets = [s[:3] for s in SCENARIOS] + [("T002", "CUST003", "a parcel without news"), ("N", None, None), (None, None, "refund")]
    shown = lambda: sorted(
        (str(r.ticket_id), r.draft, [(h.rank, h.source, h.relevance_score) for h in r.hits])
        for r in reports_of(spark, world, tickets).collect()
    )
    in_row = shown()
    monkeypatch.setattr(term_index, "MOST_KNOWN", 1)
    assert shown() == in_row and len(in_row) == len(tickets)
    twice = [hits for ticket, _, hits in in_row if ticket == "T002"]
    assert twice[0] == twice[1] and len(twice[0]) > 1  # one ticket id is one question, made of all its texts
    assert [hits for ticket, _, hits in in_row if ticket == "None"] == [[]]


# Inputs of the gates and what they decide.
GATES = [
    ("fraud_suspected", "neutral", "high", 0.9, True, 0.0, "hard_category"),
    ("fraud_suspected", "frustrated", "medium", 0.95, True, 0.0, "hard_category"),
    ("refund_request", "neutral", "low", 0.9, True, 6500.0, "hard_category"),
    ("order_status", "neutral", "low", 0.4, True, 0.0, "low_confidence"),
    ("order_status", "neutral", "low", 0.9, True, 0.0, None),
    ("refund_request", "neutral", "low", 0.75, True, 5000.0, None),
    ("order_status", "angry", "critical", 0.9, True, 0.0, "hard_category"),
    ("order_status", "neutral", "low", 0.9, False, 0.0, "validation_failed"),
]


def test_gates(spark):
    columns = "issue_type string, sentiment string, urgency string, confidence double, validation_passed boolean, order_amount double, expected string"
    rows = triage.decide(spark.createDataFrame(GATES, columns)).collect()
    assert [r.escalation.escalation_type for r in rows] == [g[-1] for g in GATES]
    assert rows[2].escalation.reason == "refund request for ₹6500.00 exceeds the ₹5000 manual-review threshold"
    assert rows[3].escalation.reason == "classifier confidence 0.40 is below threshold 0.75"


def test_unanchored_and_bounded_rules(spark):
    frame = spark.createDataFrame([("please answer immediately, my lamp is here",)], "text string")
    loose = frame.select(rules.issue(F.col("text"))["issue_type"]).first()[0]
    strict = frame.select(rules.issue(F.col("text"), rules.word_bounded(rules.ISSUE_RULES))["issue_type"]).first()[0]
    assert (loose, strict) == ("complaint_escalation", "general_inquiry")


def test_orders_are_paged_newest_first(spark):
    accounts = spark.createDataFrame([("C1", "n"), ("C2", "n"), ("C3", "n")], "customer_id string, name string")
    rows = [(f"O{i:03d}", "C1", float(i), dt.date(2024, 1, 1) + dt.timedelta(days=i * 7 % 200)) for i in range(95)]
    rows += [("P1", "C2", 1.0, dt.date(2024, 5, 5)), ("P2", "C2", 2.0, dt.date(2024, 5, 5)), ("X", "C9", 2.0, dt.date(2024, 5, 5))]
    orders = spark.createDataFrame(rows, "order_id string, customer_id string, amount double, order_date date")
    pages = triage.customer_context(accounts, orders, page_size=10).collect()
    listed = {}
    for page in sorted(pages, key=lambda p: (p.customer_id, p.page)):
        assert len(page.recent_orders) <= 10
        listed.setdefault(page.customer_id, []).extend(o.order_id for o in page.recent_orders)
    wanted = [r[0] for r in sorted((r for r in rows if r[1] == "C1"), key=lambda r: (-r[3].toordinal(), r[0]))]
    assert listed == {"C1": wanted, "C2": ["P1", "P2"], "C3": []}


def test_insert_or_ignore_keeps_first(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 9, 1), ("b", 3, 2), ("b", 2, 1)], "k string, v int, seq int")
    once = joins.insert_or_ignore(target, incoming, "k", "seq")
    assert {tuple(r) for r in once.collect()} == {("a", 1), ("b", 2)}
    assert {tuple(r) for r in joins.insert_or_ignore(once, incoming, "k", "seq").collect()} == {("a", 1), ("b", 2)}


def test_long_ids_stay_whole(spark):
    from caselight.plans import tickets_data

    rows = spark.createDataFrame([(7,), (123456,), (1234567,), (12345678,)], "k long")
    made = rows.select(tickets_data.customer_code(F.col("k")).alias("c"), tickets_data.order_code(F.col("k")).alias("o")).collect()
    assert [r.c for r in made] == ["CUST000007", "CUST123456", "CUST1234567", "CUST12345678"]
    assert [r.o for r in made] == ["ORD0000007", "ORD0123456", "ORD1234567", "ORD12345678"]


def test_orders_without_a_date_come_last(spark):
    accounts = spark.createDataFrame([("c", "n")], "customer_id string, name string")
    orders = spark.sql("""SELECT * FROM VALUES ('o1', 'c', 1.0, DATE'2024-01-01'), ('o2', 'c', 2.0, NULL),
        ('o3', 'c', 3.0, DATE'2024-02-01'), ('o4', 'x', 3.0, NULL) AS t(order_id, customer_id, amount, order_date)""")
    placed = triage.orders_newest_first(accounts, orders, parts=3).collect()
    assert [r.order_id for r in sorted(placed, key=lambda r: r.place)] == ["o3", "o1", "o2"]
