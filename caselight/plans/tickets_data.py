"""Ticket, account, order and knowledge tables drawn from the given tables, in Spark and in SQL.

The given texts hold none of the rule words, so ticket texts are filled from templates;
every event (or order) gives one ticket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.functions.text import fill_template
from caselight.registry import table, text_literal

TEMPLATES = [
    "Nothing moves on the parcel page of {order}; could somebody check that for me?",
    "The {product} from {order} is the wrong size, so a refund would be best.",
    "Out of the box the {product} was broken, which left me disappointed.",
    "My bank shows the {product} was charged twice; kindly correct that.",
    "Customer {customer} here: there is a card entry I don't recognize at all.",
    "Worst handling of {order} so far, connect me to a manager now!",
    "  {customer} asking: where is my order {order}? Two weeks have gone by.  ",
    "quick question",
    "Since this morning I can't log in, so account access for the {product} is gone.",
    "Which sizes of the {product} do you stock for a small workshop?",
    "Checkout says payment failed, yet the money was deducted, so I am not happy.",
    "Ridiculous: the {product} I bought is useless and I expect a refund.",
    "Could you double check the small charge for {order} on my card?",
    "A defective {product} came with {order}; can a new one be sent immediately?",
]
ADJECTIVES = ["small", "red", "blue", "hot", "old", "large", "new", "cold"]
NOUNS = ["ring", "widget", "bolt", "gear", "gizmo", "plate", "anvil", "spring"]
STOP_WORDS = [
    "a", "an", "and", "are", "at", "be", "but", "can", "do", "for", "from", "has", "have", "he",
    "i", "in", "is", "it", "its", "my", "not", "of", "on", "or", "she", "that", "the", "they",
    "this", "to", "was", "were", "will", "with", "you", "your",
]
INTERNAL_SOURCE = "catalogue_promo.md"


def _padded(key: Column, width: int) -> Column:
    """Zeros up to the width; a longer number stays whole, which plain ``lpad`` would cut."""
    digits = key.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0")


def customer_code(key: Column) -> Column:
    return F.concat(F.lit("CUST"), _padded(key, 6))


def order_code(key: Column) -> Column:
    return F.concat(F.lit("ORD"), _padded(key, 7))


def _choose(values: list[str], number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def ticket_text(number: Column, order: Column, customer: Column, product: Column) -> Column:
    return fill_template(
        _choose(TEMPLATES, number), {"order": order, "customer": customer, "product": product}
    )


def event_tickets_of(events: DataFrame) -> DataFrame:
    """One ticket per event; events of type ``error`` carry no customer id."""
    k = F.get_json_object("props", "$.k").cast("long")
    customer = customer_code(F.col("user_id"))
    product = F.concat_ws(
        " ", _choose(ADJECTIVES, k), _choose(NOUNS, F.floor(k / len(ADJECTIVES)))
    )
    return events.select(
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("ticket_id"),
        F.when(F.col("event_type") != "error", customer).alias("customer_id"),
        ticket_text(F.col("event_id"), order_code(F.col("event_id")), customer, product).alias("text"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def event_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_tickets_of(table(spark, sf_dir, "events"))


def order_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per order, by its owner; every third order number belongs to another order."""
    key = F.col("o_orderkey")
    mentioned = order_code(F.when(key % 3 == 0, key + 1).otherwise(key))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("R"), key.cast("string")).alias("ticket_id"),
        customer_code(F.col("o_custkey")).alias("customer_id"),
        ticket_text(
            key, mentioned, customer_code(F.col("o_custkey")), F.lit("blue bolt")
        ).alias("text"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    standing = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "flagged")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "vip")
        .otherwise("good")
    )
    return table(spark, sf_dir, "customer").select(
        customer_code(F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("name"),
        standing.alias("standing"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        order_code(F.col("o_orderkey")).alias("order_id"),
        customer_code(F.col("o_custkey")).alias("customer_id"),
        (F.floor("o_totalprice") / 20).alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def catalogue_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product knowledge base: one chunk per part, one source per product type."""
    text = F.concat(
        F.lit("## "), F.col("p_brand"), F.lit("\n"), F.col("p_name"), F.lit("\nThe "),
        F.col("p_name"), F.lit(" comes in measure "), F.col("p_size").cast("string"), F.lit("."),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("catalogue_"), F.lower("p_type"), F.lit(".md")).alias("source"),
        F.col("p_partkey").alias("ordinal"),
        F.col("p_brand").alias("section"),
        text.alias("text"),
    )


# ---- the same tables in SQL -------------------------------------------------------------


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(text_literal(v) for v in values) + "]"


def _sql_choose(values: list[str], number: str) -> str:
    return f"({_sql_list(values)})[({number}) % {len(values)} + 1]"


def _sql_ticket_text(number: str, order: str, customer: str, product: str) -> str:
    return (
        f"replace(replace(replace({_sql_choose(TEMPLATES, number)}, '{{order}}', {order}), "
        f"'{{customer}}', {customer}), '{{product}}', {product})"
    )


def _sql_padded(key: str, width: int) -> str:
    return f"lpad(({key})::VARCHAR, greatest(length(({key})::VARCHAR), {width})::INTEGER, '0')"


def _sql_cust(key: str) -> str:
    return f"('CUST' || {_sql_padded(key, 6)})"


def _sql_order(key: str) -> str:
    return f"('ORD' || {_sql_padded(key, 7)})"


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_PRODUCT = (
    f"({_sql_choose(ADJECTIVES, _K)} || ' ' || "
    f"{_sql_choose(NOUNS, f'({_K} // {len(ADJECTIVES)})')})"
)

EVENT_TICKETS = f"""
tickets AS (
  SELECT 'T' || event_id::VARCHAR AS ticket_id,
         CASE WHEN event_type <> 'error' THEN {_sql_cust('user_id')} END AS customer_id,
         {_sql_ticket_text('event_id', _sql_order('event_id'), _sql_cust('user_id'), _PRODUCT)} AS text,
         ts AS created_at
  FROM events)"""

ORDER_TICKETS = f"""
tickets AS (
  SELECT 'R' || o_orderkey::VARCHAR AS ticket_id,
         {_sql_cust('o_custkey')} AS customer_id,
         {_sql_ticket_text('o_orderkey',
                           _sql_order('CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1 ELSE o_orderkey END'),
                           _sql_cust('o_custkey'), "'blue bolt'")} AS text,
         o_orderdate AS created_at
  FROM orders)"""

ACCOUNTS = f"""
accounts AS (
  SELECT {_sql_cust('c_custkey')} AS customer_id, c_name AS name,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'flagged' WHEN 'AUTOMOBILE' THEN 'vip'
              ELSE 'good' END AS standing
  FROM customer)"""

ORDER_HISTORY = f"""
history AS (
  SELECT {_sql_order('o_orderkey')} AS order_id, {_sql_cust('o_custkey')} AS customer_id,
         floor(o_totalprice) / 20 AS amount, CAST(o_orderdate AS DATE) AS order_date
  FROM orders)"""

CATALOGUE = """
chunks AS (
  SELECT 'catalogue_' || lower(p_type) || '.md' AS source, p_partkey AS ordinal, p_brand AS section,
         '## ' || p_brand || chr(10) || p_name || chr(10) || 'The ' || p_name || ' comes in measure '
         || p_size::VARCHAR || '.' AS text
  FROM part)"""
