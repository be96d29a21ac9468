"""Ticket triage: classify, look up the account, draft, validate, decide, report.

A ticket table has ``ticket_id, customer_id, text``; accounts have ``customer_id, name, standing``;
orders have ``order_id, customer_id, amount, order_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.functions import rules
from caselight.operators.conversation import in_parts, split_running
from caselight.operators.joins import left_lookup
from caselight.operators.term_index import (
    CHUNK_KEY,
    TermIndex,
    search_signatures,
    with_signature,
)

# Wording of the drafted answers and of the issues a check can find.
OPENER_SORRY = "I'm really sorry for the trouble here"
OPENER_THANKS = "Thanks for reaching out"
NO_POLICY_LINE = (
    " I don't have a specific policy reference for this yet, "
    "so I'll have a specialist confirm the exact next step."
)
CLOSING_LINE = " Let us know if you have further questions."
ISSUE_NO_GROUNDING = "No grounding KB chunks retrieved for a policy-dependent issue type"
ISSUE_TONE = "Missing empathetic opening for a frustrated/angry customer"
ISSUE_ABSOLUTE = (
    "Draft uses absolute language ('guarantee'/'promise') not supported by policy wording"
)
# The steps a report lists, in order.
STEPS = [
    "classifier_agent",
    "pydantic_validation",
    "account_lookup_agent",
    "knowledge_retrieval_agent",
    "drafting_agent",
    "validation_agent",
    "escalation_agent",
    "case_closure_agent",
]


def classify(tickets: DataFrame, rule_list: list[rules.Rule] = rules.ISSUE_RULES) -> DataFrame:
    """Adds issue type, confidence, sentiment, urgency, ids found in the text and the summary."""
    text = F.col("text")
    judged = tickets.withColumns(
        {
            "_issue": rules.issue(text, rule_list),
            "sentiment": rules.sentiment(text),
            "extracted_order_id": rules.entity(text, "ORD"),
            "extracted_customer_id": rules.entity(text, "CUST"),
            "summary": rules.summary(text),
        }
    )
    named = judged.select("*", "_issue.issue_type", "_issue.confidence").drop("_issue")
    return named.withColumn("urgency", rules.urgency(F.col("issue_type"), F.col("sentiment")))


def resolve_customer(classified: DataFrame) -> DataFrame:
    """The id given with the ticket, else the one found in its text."""
    given = F.nullif(F.col("customer_id"), F.lit(""))
    return classified.withColumn("customer_id", F.coalesce(given, F.col("extracted_customer_id")))


def _found(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("customer_context_found", F.lit(True))


def _or_not_found(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("customer_context_found", F.coalesce("customer_context_found", F.lit(False)))


def join_customer(tickets: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every ticket stays; ``customer_context_found`` tells whether an account matched."""
    return _or_not_found(left_lookup(tickets, _found(accounts), "customer_id", "ticket_id"))


def latest_order(orders: DataFrame) -> DataFrame:
    """(customer_id, latest_amount) by date, then id; folds before the exchange."""
    return orders.groupBy("customer_id").agg(
        F.max_by("amount", F.struct("order_date", "order_id")).alias("latest_amount")
    )


def _with_mention(tickets: DataFrame, orders: DataFrame) -> DataFrame:
    """Adds owner and amount of the order that a ticket mentions."""
    mentioned = orders.select(
        F.upper("order_id").alias("extracted_order_id"),
        F.col("customer_id").alias("_owner"),
        F.col("amount").alias("_mentioned"),
    )
    return left_lookup(tickets, mentioned, "extracted_order_id", "ticket_id")


def _with_amount(tickets: DataFrame) -> DataFrame:
    owned = F.when(F.col("_owner") == F.col("customer_id"), F.col("_mentioned"))
    return tickets.withColumn(
        "order_amount", F.coalesce(owned, "latest_amount", F.lit(0.0))
    ).drop("_owner", "_mentioned", "latest_amount")


def relevant_order_amount(tickets: DataFrame, orders: DataFrame) -> DataFrame:
    """Adds ``order_amount``: the mentioned order if the customer owns it, else the latest, else 0."""
    with_mention = _with_mention(tickets, orders)
    return _with_amount(left_lookup(with_mention, latest_order(orders), "customer_id", "ticket_id"))


def with_question(classified: DataFrame, index: TermIndex, stop_words: list[str] | None = None) -> DataFrame:
    """Adds ``signature``: the known words of a ticket's knowledge query, null where it has none."""
    return with_signature(
        classified, "ticket_id", F.concat_ws(" ", "issue_type", "summary"), index, stop_words
    )


def attach_knowledge(
    tickets: DataFrame,
    asked: DataFrame,
    chunks: DataFrame,
    index: TermIndex,
    k: int = 3,
    internal_source: str | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Adds ``hits``: up to k (rank, source, section, text, score), an empty array when none, their labels as
    ``kb_chunks_used`` and the ``policy`` sentence of the first, null when none.

    ``asked`` holds the tickets with their question before any join, so that the search does not repeat the joins.
    Tickets are scored per distinct set of known words, and get by that what is worked out once per set.
    """
    hits = search_signatures(asked, index, k, internal_source, stop_words)
    detailed = hits.join(chunks.select(*CHUNK_KEY, "section", "text"), CHUNK_KEY)
    hit = F.struct(
        "rank", "source", "section", "text", F.round("score", 4).alias("relevance_score")
    )
    gathered = detailed.groupBy("signature").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    best = F.get("hits", F.lit(0))
    per_signature = gathered.withColumns(
        {"kb_chunks_used": evidence_labels(F.col("hits")), "policy": policy_text(best["source"], best["text"])}
    )
    matched = left_lookup(tickets, per_signature, "signature", "ticket_id").drop("signature")
    none = {c: F.array().cast(per_signature.schema[c].dataType) for c in ("hits", "kb_chunks_used")}
    return matched.withColumns({c: F.coalesce(c, empty) for c, empty in none.items()})


def policy_text(source: Column, chunk_text: Column) -> Column:
    """The sentence that names a chunk's source and last line."""
    pretty = F.replace(F.replace(source, F.lit("_"), F.lit(" ")), F.lit(".md"), F.lit(""))
    last_line = F.trim(F.element_at(F.split(chunk_text, "\n"), -1))
    return F.concat(F.lit(" Based on our policy ("), pretty, F.lit("): "), last_line)


def draft_text(name: Column, mood: Column, policy: Column) -> Column:
    """The answer by template; a null ``policy`` means no chunk was found."""
    first_name = F.coalesce(F.get(F.split(name, " "), F.lit(0)), F.lit("there"))
    opener = F.when(mood.isin("angry", "frustrated"), OPENER_SORRY).otherwise(OPENER_THANKS)
    return F.concat(
        F.lit("Hi "), first_name, F.lit(", "), opener, F.lit("."),
        F.coalesce(policy, F.lit(NO_POLICY_LINE)), F.lit(CLOSING_LINE),
    )


def validate_draft(drafted: DataFrame) -> DataFrame:
    """Adds three booleans, their conjunction and the list of issues."""
    policy_dependent = ~F.col("issue_type").isin("general_inquiry", "order_status")
    ungrounded = ~F.col("grounded") & policy_dependent
    cold = ~F.contains(F.lower("draft"), F.lit("sorry")) & F.col("sentiment").isin("angry", "frustrated")
    absolute = rules.occurs(F.lower("draft"), r"\bguarantee\b|\bpromise\b")
    issues = F.array_compact(
        F.array(
            F.when(ungrounded, ISSUE_NO_GROUNDING),
            F.when(cold, ISSUE_TONE),
            F.when(absolute, ISSUE_ABSOLUTE),
        )
    )
    return drafted.withColumns(
        {
            "is_accurate": ~ungrounded,
            "is_on_policy": ~absolute,
            "tone_ok": ~cold,
            "issues_found": issues,
            "validation_passed": ~ungrounded & ~absolute & ~cold,
        }
    )


def decide(checked: DataFrame) -> DataFrame:
    """Adds the escalation struct and the resolution path."""
    verdict = rules.escalation(
        *[
            F.col(c)
            for c in (
                "issue_type", "sentiment", "urgency", "confidence", "validation_passed", "order_amount",
            )
        ]
    )
    path = F.when(F.col("escalation.should_escalate"), "escalated").otherwise("auto_resolved")
    return checked.withColumn("escalation", verdict).withColumn("resolution_path", path)


def evidence_labels(hits: Column) -> Column:
    return F.transform(hits, lambda h: F.concat_ws("#", h["source"], h["section"]))


def with_account(classified: DataFrame, accounts: DataFrame, orders: DataFrame) -> DataFrame:
    """Account and order amount of classified tickets; one exchange by customer serves both."""
    with_mention = _with_mention(resolve_customer(classified), orders)
    found = left_lookup(with_mention, _found(accounts), "customer_id", "ticket_id", latest_order(orders))
    return _with_amount(_or_not_found(found))


def triage_core(tickets: DataFrame, accounts: DataFrame, orders: DataFrame) -> DataFrame:
    """Classification, account and order amount: what the hard gate needs."""
    return with_account(classify(tickets), accounts, orders)


def case_reports(
    tickets: DataFrame,
    accounts: DataFrame,
    orders: DataFrame,
    chunks: DataFrame,
    index: TermIndex,
    k: int = 3,
    internal_source: str | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """One report row per ticket. A ticket carries its set of known words through the joins with accounts and orders."""
    asked = with_question(classify(tickets), index, stop_words)
    core = with_account(asked, accounts, orders)
    grounded = attach_knowledge(core, asked, chunks, index, k, internal_source, stop_words)
    drafted = grounded.withColumns(
        {
            "grounded": F.size("hits") > 0,
            "draft": draft_text(F.col("name"), F.col("sentiment"), F.col("policy")),
        }
    ).drop("policy")
    decided = decide(validate_draft(drafted))
    answer = F.when(F.col("resolution_path") == "auto_resolved", F.col("draft"))
    return decided.withColumn("final_response", answer).withColumn(
        "agent_trace", F.array(*[F.lit(s) for s in STEPS])
    )


def report_json(reports: DataFrame) -> DataFrame:
    """(ticket_id, report): the nested record as one JSON object per row, raw text left out."""
    classification = F.struct(
        "issue_type", "urgency", "sentiment", "confidence",
        "extracted_order_id", "extracted_customer_id", "summary",
    )
    validation = F.struct("is_accurate", "is_on_policy", "tone_ok", "issues_found")
    record = F.struct(
        "ticket_id",
        classification.alias("classification"),
        "customer_context_found",
        "kb_chunks_used",
        F.col("draft").alias("draft_response"),
        validation.alias("validation"),
        F.col("order_amount").alias("order_amount_considered"),
        "resolution_path",
        "final_response",
        "escalation",
        "agent_trace",
    )
    return reports.select("ticket_id", F.to_json(record).alias("report"))


def report_line(reports: DataFrame) -> DataFrame:
    """(ticket_id, line): the printed form of a report."""
    head = F.format_string(
        "Ticket: %s  |  Path: %s", F.col("ticket_id"), F.upper("resolution_path")
    )
    kind = F.format_string(
        "Issue type: %s | Urgency: %s | Sentiment: %s | Confidence: %.2f",
        F.col("issue_type"), F.col("urgency"), F.col("sentiment"), F.col("confidence"),
    )
    outcome = F.when(
        F.col("resolution_path") == "auto_resolved",
        F.concat(F.lit("Response: "), F.col("final_response")),
    ).otherwise(
        F.format_string(
            "ESCALATED — type: %s | reason: %s",
            F.col("escalation.escalation_type"), F.col("escalation.reason"),
        )
    )
    trace = F.concat(F.lit("Agent trace: "), F.array_join("agent_trace", " -> "))
    return reports.select("ticket_id", F.concat_ws("\n", head, kind, outcome, trace).alias("line"))


def summary_cube(reports: DataFrame) -> DataFrame:
    """Tickets and escalations by issue type and urgency, with sub-totals; ``level`` is the grouping id."""
    return reports.cube("issue_type", "urgency").agg(
        F.grouping_id().cast("long").alias("level"),
        F.count("*").alias("tickets"),
        F.count_if(F.col("resolution_path") == "escalated").alias("escalated"),
    )


def orders_newest_first(accounts: DataFrame, orders: DataFrame, parts: int | None = None) -> DataFrame:
    """Each order of a known customer with its place, newest first; orders without a date come last.

    Orders are range-partitioned by customer, date and id, so a customer who owns a large part of all
    orders is spread over many tasks; places are counted inside the parts and over one row per part.
    """
    known = orders.join(accounts.select("customer_id"), "customer_id", "left_semi")
    aged = known.withColumn("_age", F.coalesce(-F.datediff("order_date", F.lit("1970-01-01")), F.lit(2**31 - 1)))
    fixed = in_parts(aged, ["customer_id"], ["_age", "order_id"], parts)
    placed = split_running(fixed, ["customer_id"], ["_age", "order_id"], F.col("_part"), number="place")
    return placed.drop("_age", "_part")


def customer_context(accounts: DataFrame, orders: DataFrame, page_size: int = 1000) -> DataFrame:
    """Accounts with their orders nested newest first, in pages of bounded size.

    Page 0 is there for every account, empty when it has no order; an ordinary account has no
    further page, and no row grows past ``page_size`` orders.
    """
    placed = orders_newest_first(accounts, orders).withColumn(
        "page", F.floor((F.col("place") - 1) / page_size)
    )
    item = F.struct("place", "order_id", "amount", "order_date")
    pages = placed.groupBy("customer_id", "page").agg(
        F.array_sort(F.collect_list(item)).alias("recent_orders")
    )
    none = F.array().cast(pages.schema["recent_orders"].dataType)
    return accounts.join(pages, "customer_id", "left").withColumns(
        {"page": F.coalesce("page", F.lit(0)), "recent_orders": F.coalesce("recent_orders", none)}
    )
