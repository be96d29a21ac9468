"""Checked queries on tickets: classification, accounts, drafts, gates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.functions import rules
from caselight.operators import conversation, joins, triage
from caselight.plans import tickets_data as data
from caselight.plans import ticket_sql as sql
from caselight.plans.indexes import stored_index
from caselight.registry import query, table

_TICKETS = f"WITH {data.EVENT_TICKETS}, {sql.CLASSIFIED}"
_CORE = (
    f"{_TICKETS}, {data.ACCOUNTS}, {data.ORDER_HISTORY}, {sql.WITH_CUSTOMER}, {sql.WITH_AMOUNT}"
)
_DRAFTED = f"{_CORE}, {data.CATALOGUE}, {sql.KNOWLEDGE}, {sql.DRAFTED}"
_CHECKED = f"{_DRAFTED}, {sql.VALIDATED}"
_DECIDED = f"{_CHECKED}, {sql.gates('checked')}"


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.classify(data.event_tickets(spark, sf_dir))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ticket job on the given tables."""
    chunks = data.catalogue_chunks(spark, sf_dir)
    return triage.case_reports(
        data.event_tickets(spark, sf_dir),
        data.accounts(spark, sf_dir),
        data.orders(spark, sf_dir),
        chunks,
        stored_index(spark, "catalogue", f"{sf_dir}/part.parquet", lambda: chunks, data.STOP_WORDS),
        internal_source=data.INTERNAL_SOURCE,
        stop_words=data.STOP_WORDS,
    )


@query("ticket_classify", f"{_TICKETS} SELECT ticket_id, issue_type, confidence FROM classified")
def ticket_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("ticket_id", "issue_type", "confidence")


@query("ticket_sentiment", f"{_TICKETS} SELECT ticket_id, sentiment FROM classified")
def ticket_sentiment(spark, sf_dir):
    return _classified(spark, sf_dir).select("ticket_id", "sentiment")


@query("ticket_urgency", f"{_TICKETS} SELECT ticket_id, issue_type, sentiment, urgency FROM classified")
def ticket_urgency(spark, sf_dir):
    return _classified(spark, sf_dir).select("ticket_id", "issue_type", "sentiment", "urgency")


@query(
    "entity_extract",
    f"{_TICKETS} SELECT ticket_id, extracted_order_id, extracted_customer_id FROM classified",
)
def entity_extract(spark, sf_dir):
    return _classified(spark, sf_dir).select("ticket_id", "extracted_order_id", "extracted_customer_id")


@query(
    "ticket_summary",
    f"WITH tickets AS (SELECT * FROM conversations) "
    f"SELECT conv_id, turn, substring({sql.STRIPPED}, 1, 140) AS summary FROM tickets",
)
def ticket_summary(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", rules.summary(F.col("text")).alias("summary")
    )


@query(
    "ticket_customer_join",
    f"{_TICKETS}, {data.ACCOUNTS}, {sql.WITH_CUSTOMER} "
    "SELECT ticket_id, customer_id, name, standing, customer_context_found FROM known",
)
def ticket_customer_join(spark, sf_dir):
    known = triage.join_customer(
        triage.resolve_customer(_classified(spark, sf_dir)), data.accounts(spark, sf_dir)
    )
    return known.select("ticket_id", "customer_id", "name", "standing", "customer_context_found")


@query(
    "relevant_order_amount",
    f"WITH {data.ORDER_TICKETS}, {sql.CLASSIFIED}, {data.ACCOUNTS}, {data.ORDER_HISTORY}, "
    f"{sql.WITH_CUSTOMER}, {sql.WITH_AMOUNT} "
    "SELECT ticket_id, customer_id, extracted_order_id, round(order_amount, 6) AS order_amount FROM core",
)
def relevant_order_amount(spark, sf_dir):
    core = triage.triage_core(
        data.order_tickets(spark, sf_dir), data.accounts(spark, sf_dir), data.orders(spark, sf_dir)
    )
    return core.select(
        "ticket_id", "customer_id", "extracted_order_id", F.round("order_amount", 6).alias("order_amount")
    )


def _context_sql(page_size: int) -> str:
    return f"""WITH {data.ACCOUNTS}, {data.ORDER_HISTORY}, placed AS (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id) AS place
      FROM history),
    pages AS (
      SELECT customer_id, (place - 1) // {page_size} AS page, count(*) AS n,
             string_agg(order_id || '@' || order_date::VARCHAR, ',' ORDER BY place) AS listed
      FROM placed GROUP BY ALL)
    SELECT a.customer_id, a.name, coalesce(p.page, 0) AS page, coalesce(p.n, 0) AS orders_on_page,
           coalesce(p.listed, '') AS recent_orders
    FROM accounts a LEFT JOIN pages p USING (customer_id)"""


def _context(spark, sf_dir, page_size: int):
    nested = triage.customer_context(data.accounts(spark, sf_dir), data.orders(spark, sf_dir), page_size)
    listed = F.transform(
        "recent_orders", lambda o: F.concat_ws("@", o["order_id"], o["order_date"].cast("string"))
    )
    return nested.select(
        "customer_id", "name", "page",
        F.size("recent_orders").cast("long").alias("orders_on_page"),
        F.array_join(listed, ",").alias("recent_orders"),
    )


@query("customer_context", _context_sql(1000))
def customer_context(spark, sf_dir):
    return _context(spark, sf_dir, 1000)


@query("customer_context_paged", _context_sql(3))
def customer_context_paged(spark, sf_dir):
    """Pages of three orders, which most given customers fill."""
    return _context(spark, sf_dir, 3)


@query(
    "draft_response",
    f"{_DRAFTED} SELECT ticket_id, draft, best_source, evidence FROM drafted",
)
def draft_response(spark, sf_dir):
    return reports(spark, sf_dir).select(
        "ticket_id", "draft",
        F.get("hits", F.lit(0))["source"].alias("best_source"),
        F.array_join("kb_chunks_used", ";").alias("evidence"),
    )


@query(
    "draft_validate",
    f"{_CHECKED} SELECT ticket_id, is_accurate, is_on_policy, tone_ok, issues FROM checked",
)
def draft_validate(spark, sf_dir):
    return reports(spark, sf_dir).select(
        "ticket_id", "is_accurate", "is_on_policy", "tone_ok",
        F.array_join("issues_found", "; ").alias("issues"),
    )


def _gate_inputs(spark, sf_dir) -> DataFrame:
    """Order tickets carry the owner's amounts; the confidence stands in for a passed validation."""
    core = triage.triage_core(
        data.order_tickets(spark, sf_dir), data.accounts(spark, sf_dir), data.orders(spark, sf_dir)
    )
    return core.withColumn("validation_passed", F.col("confidence") != 0.82)


_GATE_SQL = (
    f"WITH {data.ORDER_TICKETS}, {sql.CLASSIFIED}, {data.ACCOUNTS}, {data.ORDER_HISTORY}, "
    f"{sql.WITH_CUSTOMER}, {sql.WITH_AMOUNT}, "
    "inputs AS (SELECT *, confidence <> 0.82 AS validation_passed FROM core), "
    f"{sql.gates('inputs')}"
)


@query(
    "hard_gate",
    f"{_GATE_SQL} SELECT ticket_id, hard_reason IS NOT NULL AS fired, hard_reason AS reason FROM decided",
)
def hard_gate(spark, sf_dir):
    verdict = rules.hard_gate(*[F.col(c) for c in ("issue_type", "sentiment", "urgency", "order_amount")])
    return _gate_inputs(spark, sf_dir).select(
        "ticket_id", verdict.isNotNull().alias("fired"), verdict["reason"].alias("reason")
    )


@query(
    "soft_gate",
    f"{_GATE_SQL} SELECT ticket_id, soft_reason IS NOT NULL AS fired, soft_reason AS reason FROM decided",
)
def soft_gate(spark, sf_dir):
    verdict = rules.soft_gate(F.col("confidence"), F.col("validation_passed"))
    return _gate_inputs(spark, sf_dir).select(
        "ticket_id", verdict.isNotNull().alias("fired"), verdict["reason"].alias("reason")
    )


@query(
    "escalation_decision",
    f"{_GATE_SQL} SELECT ticket_id, should_escalate, reason, escalation_type, resolution_path FROM decided",
)
def escalation_decision(spark, sf_dir):
    return triage.decide(_gate_inputs(spark, sf_dir)).select("ticket_id", "escalation.*", "resolution_path")


_REPORT_COLUMNS = """ticket_id, customer_id, issue_type, urgency, sentiment, confidence,
  customer_context_found, evidence, draft, validation_passed, issues,
  round(order_amount, 6) AS order_amount, resolution_path, escalation_type, reason,
  CASE WHEN resolution_path = 'auto_resolved' THEN draft END AS final_response"""


@query("ticket_case_report", f"{_DECIDED} SELECT {_REPORT_COLUMNS} FROM decided")
def ticket_case_report(spark, sf_dir):
    return reports(spark, sf_dir).select(
        "ticket_id", "customer_id", "issue_type", "urgency", "sentiment", "confidence",
        "customer_context_found",
        F.array_join("kb_chunks_used", ";").alias("evidence"),
        "draft", "validation_passed",
        F.array_join("issues_found", "; ").alias("issues"),
        F.round("order_amount", 6).alias("order_amount"),
        "resolution_path", "escalation.escalation_type", "escalation.reason", "final_response",
    )


@query(
    "case_report_json",
    f"""{_DECIDED} SELECT ticket_id, issue_type, urgency, customer_context_found, draft AS draft_response,
      is_accurate, issues, round(order_amount, 6) AS order_amount, resolution_path, reason,
      evidence, 8::BIGINT AS steps, false AS holds_raw_text FROM decided""",
)
def case_report_json(spark, sf_dir):
    """The JSON records, read back field by field."""
    schema = """classification struct<issue_type string, urgency string>, customer_context_found boolean,
      draft_response string, validation struct<is_accurate boolean, issues_found array<string>>,
      order_amount_considered double, resolution_path string, escalation struct<reason string>,
      kb_chunks_used array<string>, agent_trace array<string>, text string"""
    parsed = triage.report_json(reports(spark, sf_dir)).select(
        "ticket_id", F.from_json("report", schema).alias("r")
    )
    return parsed.select(
        "ticket_id", "r.classification.issue_type", "r.classification.urgency",
        "r.customer_context_found", "r.draft_response", "r.validation.is_accurate",
        F.array_join("r.validation.issues_found", "; ").alias("issues"),
        F.round("r.order_amount_considered", 6).alias("order_amount"),
        "r.resolution_path", "r.escalation.reason",
        F.array_join("r.kb_chunks_used", ";").alias("evidence"),
        F.size("r.agent_trace").cast("long").alias("steps"),
        F.col("r.text").isNotNull().alias("holds_raw_text"),
    )


@query(
    "report_lines",
    f"""{_DECIDED} SELECT ticket_id,
      'Ticket: ' || ticket_id || '  |  Path: ' || upper(resolution_path) || chr(10)
      || 'Issue type: ' || issue_type || ' | Urgency: ' || urgency || ' | Sentiment: ' || sentiment
      || ' | Confidence: ' || printf('%.2f', confidence) || chr(10)
      || CASE WHEN resolution_path = 'auto_resolved' THEN 'Response: ' || draft
              ELSE 'ESCALATED — type: ' || escalation_type || ' | reason: ' || reason END || chr(10)
      || 'Agent trace: {' -> '.join(triage.STEPS)}' AS line
      FROM decided""",
)
def report_lines(spark, sf_dir):
    return triage.report_line(reports(spark, sf_dir))


@query(
    "evidence_labels",
    f"""{_DRAFTED}, labels_only AS (SELECT DISTINCT query_id, unnest(string_split(evidence, ';')) AS label FROM best)
      SELECT label, count(*) AS questions FROM labels_only GROUP BY label""",
)
def evidence_labels(spark, sf_dir):
    """How many distinct ticket questions each ``source#section`` label backs."""
    found = reports(spark, sf_dir).select("issue_type", "summary", "kb_chunks_used").distinct()
    labels = found.select("issue_type", "summary", F.explode("kb_chunks_used").alias("label")).distinct()
    return labels.groupBy("label").agg(F.count("*").alias("questions"))


@query(
    "case_summary_cube",
    f"""{_DECIDED} SELECT issue_type, urgency, grouping_id(issue_type, urgency)::BIGINT AS level,
      count(*) AS tickets, count(*) FILTER (resolution_path = 'escalated') AS escalated
      FROM decided GROUP BY CUBE (issue_type, urgency)""",
)
def case_summary_cube(spark, sf_dir):
    return triage.summary_cube(reports(spark, sf_dir))


_EXPECTED_SQL = """CASE WHEN issue_type IN ('fraud_suspected', 'complaint_escalation', 'payment_issue')
      THEN 'escalated' ELSE 'auto_resolved' END"""


@query(
    "suite_result",
    f"""{_DECIDED} SELECT issue_type, count(*) FILTER (resolution_path = {_EXPECTED_SQL}) AS passed,
      count(*) FILTER (resolution_path <> {_EXPECTED_SQL}) AS failed
      FROM decided GROUP BY issue_type""",
)
def suite_result(spark, sf_dir):
    """Pass and fail counts where the category alone is taken as the expected path."""
    expected = F.when(
        F.col("issue_type").isin(*rules.HARD_ISSUE_TYPES, "payment_issue"), "escalated"
    ).otherwise("auto_resolved")
    ok = F.col("resolution_path") == expected
    return (
        reports(spark, sf_dir)
        .groupBy("issue_type")
        .agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"))
    )


@query(
    "prior_ticket_count",
    """SELECT event_id, user_id,
      count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_tickets FROM events""",
)
def prior_ticket_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    counted = conversation.split_running(
        events, ["user_id"], ["ts", "event_id"], number="_place"
    )
    return counted.select("event_id", "user_id", (F.col("_place") - 1).alias("prior_tickets"))


@query(
    "account_lookup",
    f"""WITH {data.EVENT_TICKETS}, {data.ACCOUNTS}
      SELECT t.ticket_id, t.customer_id, a.name, a.standing
      FROM tickets t LEFT JOIN accounts a USING (customer_id)""",
)
def account_lookup(spark, sf_dir):
    """Point lookup of each ticket's customer, null where there is none."""
    tickets = data.event_tickets(spark, sf_dir).select("ticket_id", "customer_id")
    return joins.left_lookup(tickets, data.accounts(spark, sf_dir), "customer_id", "ticket_id").select(
        "ticket_id", "customer_id", "name", "standing"
    )


@query(
    "orders_by_customer",
    f"""WITH {data.ACCOUNTS}, {data.ORDER_HISTORY}
      SELECT customer_id, order_id, order_date::VARCHAR AS order_date, round(amount, 6) AS amount,
        row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id) AS place
      FROM history WHERE customer_id IN (SELECT customer_id FROM accounts)""",
)
def orders_by_customer(spark, sf_dir):
    placed = triage.orders_newest_first(data.accounts(spark, sf_dir), data.orders(spark, sf_dir))
    return placed.select(
        "customer_id", "order_id", F.col("order_date").cast("string").alias("order_date"),
        F.round("amount", 6).alias("amount"), "place",
    )


@query(
    "orphan_orders",
    """WITH shifted AS (SELECT o_orderkey, o_custkey + 100 AS o_custkey FROM orders)
      SELECT o_orderkey, o_custkey FROM shifted
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def orphan_orders(spark, sf_dir):
    """Foreign-key check; the owner is shifted by 100 because the given table has no orphan."""
    shifted = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") + 100).alias("o_custkey")
    )
    return joins.missing_parents(shifted, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")


@query(
    "customers_without_orders",
    """SELECT c_custkey, c_name FROM customer
      WHERE c_custkey NOT IN (SELECT o_custkey + 50 FROM orders)""",
)
def customers_without_orders(spark, sf_dir):
    """Order owners are shifted by 50, so that some customers are left without any order."""
    shifted = table(spark, sf_dir, "orders").select((F.col("o_custkey") + 50).alias("o_custkey"))
    return joins.without_children(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"), shifted, "c_custkey", "o_custkey"
    )


@query(
    "insert_or_ignore",
    """WITH incoming AS (
        SELECT o_custkey + 50 AS c_custkey, 'Order#' || o_orderkey::VARCHAR AS c_name, o_orderkey FROM orders),
      first AS (SELECT c_custkey, c_name FROM incoming
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) = 1)
      SELECT c_custkey, c_name FROM customer
      UNION ALL SELECT c_custkey, c_name FROM first
      WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def insert_or_ignore(spark, sf_dir):
    """Order owners, shifted by 50, arrive at the customer table; first arrival wins."""
    incoming = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 50).alias("c_custkey"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("c_name"),
        "o_orderkey",
    )
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.insert_or_ignore(target, incoming, "c_custkey", "o_orderkey")
