"""Ordered text rules: issue type, sentiment, urgency, ids and the two escalation gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselight.functions.text import strip, word_count


@dataclass(frozen=True)
class Rule:
    pattern: str
    issue_type: str
    confidence: float


# The first rule whose pattern occurs in the lower-cased text gives the label.
ISSUE_RULES = [
    Rule(
        r"don'?t recognize|didn'?t make this|unauthorized transaction|not my transaction|"
        r"not sure (it|this) was me|wasn'?t me|not sure i made|don'?t think i made|"
        r"(double check|make sure).*(charge|transaction)",
        "fraud_suspected",
        0.9,
    ),
    Rule(r"charged twice|double charged|duplicate charge", "payment_issue", 0.9),
    Rule(r"payment failed|money (was )?deducted|debited but", "payment_issue", 0.85),
    Rule(r"manager|legal action|consumer court|media|news", "complaint_escalation", 0.9),
    Rule(r"refund", "refund_request", 0.85),
    Rule(r"damaged|broken|defective", "damaged_item", 0.85),
    Rule(r"where is my order|track my order|order status|not delivered yet", "order_status", 0.9),
    Rule(r"locked out|can'?t log ?in|reset password|account access", "account_access", 0.85),
]
DEFAULT_ISSUE = "general_inquiry"
DEFAULT_CONFIDENCE_SHORT = 0.5
DEFAULT_CONFIDENCE_LONG = 0.82
SHORT_TEXT_WORDS = 6

# Sentiment tiers, tried in this order.
ANGRY_PATTERN = r"furious|unacceptable|ridiculous|scam|worst|disgusted|angry"
FRUSTRATED_PATTERN = r"frustrat|annoyed|disappointed|not happy"

# Closed domains of a classification.
ISSUE_TYPES = [
    "order_status", "refund_request", "damaged_item", "payment_issue",
    "account_access", "fraud_suspected", "general_inquiry", "complaint_escalation",
]
URGENCIES = ["low", "medium", "high", "critical"]
SENTIMENTS = ["neutral", "frustrated", "angry", "satisfied"]

# Thresholds and reasons of the gates.
CONFIDENCE_THRESHOLD = 0.75
HIGH_VALUE_THRESHOLD = 5000.0
HARD_ISSUE_TYPES = ["fraud_suspected", "complaint_escalation"]
REASON_CATEGORY = ("issue_type '", "' is always escalated regardless of confidence")
REASON_VALUE = ("refund request for ₹", f" exceeds the ₹{HIGH_VALUE_THRESHOLD:.0f} manual-review threshold")
REASON_CONFIDENCE = ("classifier confidence ", f" is below threshold {CONFIDENCE_THRESHOLD}")
REASON_PAYMENT = (
    "payment issues (duplicate charge, unrecognized transaction) are always escalated "
    "to the payments/fraud team"
)
REASON_ANGRY = "critical urgency combined with angry sentiment requires human handling"
REASON_VALIDATION = "draft response failed validation (accuracy, policy, or tone check)"
REASON_PASSED = "passed all checks"


def occurs(text: Column, pattern: str) -> Column:
    """Regex search where only a line feed ends a line."""
    return F.rlike(text, F.lit("(?d)" + pattern))


def issue(text: Column, rules: list[Rule] = ISSUE_RULES) -> Column:
    """Struct (issue_type, confidence) of the first rule that occurs in the text.

    One CASE WHEN in rule order, so evaluation stops at the first hit and no pattern runs twice.
    """
    low = F.lower(text)
    short = word_count(text) < SHORT_TEXT_WORDS
    confidence = F.when(short, DEFAULT_CONFIDENCE_SHORT).otherwise(DEFAULT_CONFIDENCE_LONG)
    outcome = lambda label, sure: F.struct(label.alias("issue_type"), sure.alias("confidence"))
    fallback = outcome(F.lit(DEFAULT_ISSUE), confidence)
    chain = None
    for rule in rules:
        test, then = occurs(low, rule.pattern), outcome(F.lit(rule.issue_type), F.lit(rule.confidence))
        chain = F.when(test, then) if chain is None else chain.when(test, then)
    return fallback if chain is None else chain.otherwise(fallback)


def word_bounded(rules: list[Rule]) -> list[Rule]:
    """The same rules on whole words only, so that ``immediately`` is no ``media``."""
    return [Rule(rf"\b(?:{r.pattern})\b", r.issue_type, r.confidence) for r in rules]


def sentiment(text: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(occurs(low, ANGRY_PATTERN), "angry")
        .when(occurs(low, FRUSTRATED_PATTERN), "frustrated")
        .otherwise("neutral")
    )


def urgency(issue: Column, mood: Column) -> Column:
    return (
        F.when(mood == "angry", "critical")
        .when(issue.isin(HARD_ISSUE_TYPES), "high")
        .when(issue.isin("payment_issue", "damaged_item"), "high")
        .when(issue == "order_status", "low")
        .otherwise("medium")
    )


def entity(text: Column, prefix: str) -> Column:
    """First id such as ``ORD0012``, in capitals, or null."""
    found = F.regexp_extract(text, rf"(?i){prefix}[0-9]{{3,}}", 0)
    return F.upper(F.nullif(found, F.lit("")))


def summary(text: Column, chars: int = 140) -> Column:
    return F.substring(strip(text), 1, chars)


def _verdict(reason: Column, kind: str | Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(
        F.lit(True).alias("should_escalate"), reason.alias("reason"), kind.alias("escalation_type")
    )


def _around(parts: tuple[str, str], value: Column) -> Column:
    return F.concat(F.lit(parts[0]), value, F.lit(parts[1]))


def hard_gate(issue: Column, mood: Column, urgent: Column, amount: Column) -> Column:
    """Verdict struct when a category or value rule fires, else null."""
    category = _around(REASON_CATEGORY, issue)
    value = _around(REASON_VALUE, F.format_string("%.2f", amount))
    reason = (
        F.when(issue.isin(HARD_ISSUE_TYPES), category)
        .when(issue == "payment_issue", F.lit(REASON_PAYMENT))
        .when((issue == "refund_request") & (amount > HIGH_VALUE_THRESHOLD), value)
        .when((mood == "angry") & (urgent == "critical"), F.lit(REASON_ANGRY))
    )
    return F.when(reason.isNotNull(), _verdict(reason, "hard_category"))


def soft_gate(confidence: Column, validation_passed: Column) -> Column:
    """Verdict struct on low confidence or a failed validation, else null."""
    low = confidence < CONFIDENCE_THRESHOLD
    reason = F.when(
        low, _around(REASON_CONFIDENCE, F.format_string("%.2f", confidence))
    ).when(~validation_passed, F.lit(REASON_VALIDATION))
    kind = F.when(low, "low_confidence").otherwise("validation_failed")
    return F.when(reason.isNotNull(), _verdict(reason, kind))


def escalation(
    issue: Column, mood: Column, urgent: Column, confidence: Column, passed: Column, amount: Column
) -> Column:
    """Both gates in one struct; the hard gate wins."""
    calm = F.struct(
        F.lit(False).alias("should_escalate"),
        F.lit(REASON_PASSED).alias("reason"),
        F.lit(None).cast("string").alias("escalation_type"),
    )
    return F.coalesce(
        hard_gate(issue, mood, urgent, amount), soft_gate(confidence, passed), calm
    )


# Fields of an intake record and their closed domains.
INTAKE_DOMAINS = {
    "query_type": [
        "complaint", "submission", "variation", "safety_signal",
        "label_update", "inspection", "general_enquiry",
    ],
    "regulation_ref": [
        "FDA_21CFR", "EMA_CTR", "ICH_E2A", "ICH_Q10", "CDSCO_NDC", "GxP_GMP", "GxP_GCP", "other",
    ],
    "product_area": [
        "oncology", "cardiovascular", "infectious_disease", "cmc", "clinical", "labelling", "general",
    ],
    "urgency": ["routine", "standard", "urgent", "critical"],
}
TEAM_FIELD = "submitting_team"
INTAKE_FIELDS = [*INTAKE_DOMAINS, TEAM_FIELD]
NON_DOMAIN_MARKER = "non_regulatory_input"

# Days up to which a stated deadline has that urgency; later deadlines are routine.
DEADLINE_TIERS = [(7, "critical"), (15, "urgent"), (90, "standard")]
DEADLINE_PATTERN = r"(?i)([0-9]+)[ -]*(?:business |working |calendar )?days?\b"


def deadline_urgency(text: Column, tiers: list[tuple[int, str]] = DEADLINE_TIERS) -> Column:
    """Urgency from an explicit number of days only; null when none is stated."""
    days = F.regexp_extract(text, DEADLINE_PATTERN, 1).try_cast("long")
    chain = F.when(days.isNull(), F.lit(None).cast("string"))
    for limit, name in tiers:
        chain = chain.when(days <= limit, name)
    return chain.otherwise("routine")
