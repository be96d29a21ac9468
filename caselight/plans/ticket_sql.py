"""SQL twins of the triage steps, as named sub-queries to be chained."""

from __future__ import annotations

from caselight.functions import rules
from caselight.operators import triage
from caselight.plans.tickets_data import INTERNAL_SOURCE, STOP_WORDS
from caselight.registry import text_literal as lit

TOKENS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def _case(column: str, pairs: list[tuple[str, str]], fallback: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({column}, {lit(p)}) THEN {v}" for p, v in pairs)
    return f"CASE {whens} ELSE {fallback} END"


_LOW = "lower(text)"
STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_ISSUE = _case(_LOW, [(r.pattern, lit(r.issue_type)) for r in rules.ISSUE_RULES], lit(rules.DEFAULT_ISSUE))
_CONFIDENCE = _case(
    _LOW,
    [(r.pattern, f"{r.confidence}::DOUBLE") for r in rules.ISSUE_RULES],
    rf"CASE WHEN len(regexp_extract_all(text, '\S+')) < {rules.SHORT_TEXT_WORDS} "
    f"THEN {rules.DEFAULT_CONFIDENCE_SHORT}::DOUBLE ELSE {rules.DEFAULT_CONFIDENCE_LONG}::DOUBLE END",
)
_SENTIMENT = _case(
    _LOW, [(rules.ANGRY_PATTERN, "'angry'"), (rules.FRUSTRATED_PATTERN, "'frustrated'")], "'neutral'"
)

CLASSIFIED = f"""
labelled AS (
  SELECT *, {_ISSUE} AS issue_type, {_CONFIDENCE} AS confidence, {_SENTIMENT} AS sentiment,
         upper(nullif(regexp_extract(text, '(?i)ORD[0-9]{{3,}}'), '')) AS extracted_order_id,
         upper(nullif(regexp_extract(text, '(?i)CUST[0-9]{{3,}}'), '')) AS extracted_customer_id,
         substring({STRIPPED}, 1, 140) AS summary
  FROM tickets),
classified AS (
  SELECT *, CASE WHEN sentiment = 'angry' THEN 'critical'
                 WHEN issue_type IN ('fraud_suspected', 'complaint_escalation') THEN 'high'
                 WHEN issue_type IN ('payment_issue', 'damaged_item') THEN 'high'
                 WHEN issue_type = 'order_status' THEN 'low' ELSE 'medium' END AS urgency
  FROM labelled)"""

WITH_CUSTOMER = """
resolved AS (
  SELECT * REPLACE (coalesce(nullif(customer_id, ''), extracted_customer_id) AS customer_id)
  FROM classified),
known AS (
  SELECT r.*, a.name, a.standing, a.customer_id IS NOT NULL AS customer_context_found
  FROM resolved r LEFT JOIN accounts a ON a.customer_id = r.customer_id)"""

WITH_AMOUNT = """
latest AS (
  SELECT customer_id, amount FROM history
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1),
core AS (
  SELECT k.*, coalesce(m.amount, l.amount, 0.0) AS order_amount
  FROM known k
  LEFT JOIN history m ON upper(m.order_id) = k.extracted_order_id AND m.customer_id = k.customer_id
  LEFT JOIN latest l ON l.customer_id = k.customer_id)"""

_STOP = ", ".join(lit(w) for w in STOP_WORDS)


def tfidf(chunks: str, queries: str, stop: bool) -> str:
    """``pairs(query_id, source, ordinal, score)`` from ``chunks`` and ``queries`` sub-queries."""
    keep = f"WHERE term NOT IN ({_STOP})" if stop else ""
    words = TOKENS.format(text="text")
    return f"""
chunk_tokens AS (
  SELECT source, ordinal, term FROM (SELECT source, ordinal, unnest({words}) AS term FROM {chunks}) {keep}),
chunk_tf AS (SELECT source, ordinal, term, count(*) AS tf FROM chunk_tokens GROUP BY ALL),
idf AS (
  SELECT term, count(*) AS df,
         ln((1 + (SELECT count(*) FROM {chunks})) / (1 + count(*))::DOUBLE) + 1 AS idf
  FROM chunk_tf GROUP BY term),
chunk_raw AS (SELECT source, ordinal, term, tf * idf AS w FROM chunk_tf JOIN idf USING (term)),
chunk_norm AS (SELECT source, ordinal, sqrt(sum(w * w)) AS norm FROM chunk_raw GROUP BY ALL),
weights AS (
  SELECT source, ordinal, term, w / norm AS weight FROM chunk_raw JOIN chunk_norm USING (source, ordinal)),
query_tokens AS (
  SELECT query_id, term FROM (SELECT query_id, unnest({words}) AS term FROM {queries}) {keep}),
query_tf AS (SELECT query_id, term, count(*) AS tf FROM query_tokens GROUP BY ALL),
query_raw AS (SELECT query_id, term, tf * idf AS w FROM query_tf JOIN idf USING (term)),
query_norm AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM query_raw GROUP BY ALL),
query_weights AS (SELECT query_id, term, w / norm AS weight FROM query_raw JOIN query_norm USING (query_id)),
pairs AS (
  SELECT q.query_id, c.source, c.ordinal, sum(q.weight * c.weight) AS score
  FROM query_weights q JOIN weights c USING (term) GROUP BY ALL)"""


RANK = "floor(score * 1e9 + 0.5)"


def ranked(source: str, k: str, where: str = "true", name: str = "hits") -> str:
    return f"""
{name} AS (
  SELECT query_id, source, ordinal, score,
         row_number() OVER (PARTITION BY query_id ORDER BY {RANK} DESC, source, ordinal) AS rank
  FROM {source} WHERE {where}
  QUALIFY rank <= {k})"""


# Tickets with equal query text share their hits, so the SQL scores distinct texts.
KNOWLEDGE = (
    """
asked AS (SELECT ticket_id, issue_type || ' ' || summary AS query_id FROM core),
questions AS (SELECT DISTINCT query_id, query_id AS text FROM asked),"""
    + tfidf("chunks", "questions", True)
    + ","
    + ranked("pairs", "3", f"source <> {lit(INTERNAL_SOURCE)}")
    + """,
best AS (
  SELECT h.query_id, max(CASE WHEN rank = 1 THEN h.source END) AS best_source,
         max(CASE WHEN rank = 1 THEN c.text END) AS best_text,
         string_agg(h.source || '#' || c.section, ';' ORDER BY rank) AS evidence
  FROM hits h JOIN chunks c USING (source, ordinal) GROUP BY h.query_id),
grounded AS (
  SELECT c.*, b.best_source, b.best_text, coalesce(b.evidence, '') AS evidence,
         b.query_id IS NOT NULL AS grounded
  FROM core c JOIN asked a USING (ticket_id) LEFT JOIN best b USING (query_id))"""
)

DRAFTED = f"""
drafted AS (
  SELECT *, 'Hi ' || coalesce(split_part(name, ' ', 1), 'there') || ', '
    || CASE WHEN sentiment IN ('angry', 'frustrated') THEN {lit(triage.OPENER_SORRY)}
            ELSE {lit(triage.OPENER_THANKS)} END || '.'
    || coalesce(' Based on our policy (' || replace(replace(best_source, '_', ' '), '.md', '') || '): '
                || trim(string_split(best_text, chr(10))[-1]), {lit(triage.NO_POLICY_LINE)})
    || {lit(triage.CLOSING_LINE)} AS draft
  FROM grounded)"""

VALIDATED = rf"""
flags AS (
  SELECT *, NOT grounded AND issue_type NOT IN ('general_inquiry', 'order_status') AS ungrounded,
    NOT contains(lower(draft), 'sorry') AND sentiment IN ('angry', 'frustrated') AS cold,
    regexp_matches(lower(draft), '\bguarantee\b|\bpromise\b') AS absolute
  FROM drafted),
checked AS (
  SELECT *, NOT ungrounded AS is_accurate, NOT absolute AS is_on_policy, NOT cold AS tone_ok,
    NOT (ungrounded OR absolute OR cold) AS validation_passed,
    concat_ws('; ', CASE WHEN ungrounded THEN {lit(triage.ISSUE_NO_GROUNDING)} END,
      CASE WHEN cold THEN {lit(triage.ISSUE_TONE)} END,
      CASE WHEN absolute THEN {lit(triage.ISSUE_ABSOLUTE)} END) AS issues
  FROM flags)"""


def gates(source: str) -> str:
    """``gated`` and ``decided`` from a sub-query with the six inputs of the decision."""
    return f"""
gated AS (
  SELECT *,
    CASE WHEN issue_type IN ('fraud_suspected', 'complaint_escalation')
           THEN 'issue_type ''' || issue_type || ''' is always escalated regardless of confidence'
         WHEN issue_type = 'payment_issue' THEN {lit(rules.REASON_PAYMENT)}
         WHEN issue_type = 'refund_request' AND order_amount > {rules.HIGH_VALUE_THRESHOLD}
           THEN 'refund request for ₹' || printf('%.2f', order_amount) || ' exceeds the ₹5000 manual-review threshold'
         WHEN sentiment = 'angry' AND urgency = 'critical' THEN {lit(rules.REASON_ANGRY)} END AS hard_reason,
    CASE WHEN confidence < {rules.CONFIDENCE_THRESHOLD}
           THEN 'classifier confidence ' || printf('%.2f', confidence) || ' is below threshold 0.75'
         WHEN NOT validation_passed THEN {lit(rules.REASON_VALIDATION)} END AS soft_reason
  FROM {source}),
decided AS (
  SELECT *, hard_reason IS NOT NULL OR soft_reason IS NOT NULL AS should_escalate,
    coalesce(hard_reason, soft_reason, {lit(rules.REASON_PASSED)}) AS reason,
    CASE WHEN hard_reason IS NOT NULL THEN 'hard_category'
         WHEN confidence < {rules.CONFIDENCE_THRESHOLD} THEN 'low_confidence'
         WHEN soft_reason IS NOT NULL THEN 'validation_failed' END AS escalation_type,
    CASE WHEN hard_reason IS NOT NULL OR soft_reason IS NOT NULL THEN 'escalated'
         ELSE 'auto_resolved' END AS resolution_path
  FROM gated)"""
