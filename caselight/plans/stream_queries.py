"""Checked queries on streams and on models: streams must give what their batch twins give."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselight.functions.text import tokens
from caselight.operators import hooks
from caselight.plans import ticket_queries as tickets
from caselight.plans import tickets_data as data
from caselight.plans.ticket_sql import TOKENS
from caselight.registry import ORACLE, query, table
from caselight.session import scratch_path
from caselight.streaming import triage


@query("stream_triage", ORACLE["ticket_case_report"])
def stream_triage(spark, sf_dir):
    """Case reports of tickets that arrive as a stream."""
    chunks = data.catalogue_chunks(spark, sf_dir)
    reports = triage.triage_stream(
        spark, f"{sf_dir}/events.parquet", data.event_tickets_of, scratch_path(spark, "stream-triage"),
        accounts=data.accounts(spark, sf_dir), orders=data.orders(spark, sf_dir), chunks=chunks,
        internal_source=data.INTERNAL_SOURCE, stop_words=data.STOP_WORDS,
    )
    return reports.select(
        "ticket_id", "customer_id", "issue_type", "urgency", "sentiment", "confidence",
        "customer_context_found",
        F.array_join("kb_chunks_used", ";").alias("evidence"),
        "draft", "validation_passed",
        F.array_join("issues_found", "; ").alias("issues"),
        F.round("order_amount", 6).alias("order_amount"),
        "resolution_path", "escalation.escalation_type", "escalation.reason", "final_response",
    )


@query(
    "stream_volume",
    f"""{tickets._TICKETS} SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S') AS hour,
      issue_type, count(*) AS tickets FROM classified GROUP BY ALL""",
)
def stream_volume(spark, sf_dir):
    """Tickets per hour and issue type, counted on the stream under a watermark."""
    counts = triage.volume_stream(
        spark, f"{sf_dir}/events.parquet", data.event_tickets_of, scratch_path(spark, "stream-volume")
    )
    return counts.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "issue_type", "tickets")


@query(
    "word2vec_vectors",
    f"""SELECT DISTINCT unnest({TOKENS.format(text='text')}) AS word, 10::BIGINT AS numbers, true AS all_finite
      FROM documents""",
)
def word2vec_vectors(spark, sf_dir):
    """A vector of ten numbers for each word of the documents; the numbers depend on the run, their shape does not."""
    words = table(spark, sf_dir, "documents").select(tokens(F.col("text")).alias("words"))
    vectors = hooks.word_vectors(words, "words")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x))
    return vectors.select("word", F.size("vector").cast("long").alias("numbers"), finite.alias("all_finite"))


@query(
    "pandas_udf_embed",
    r"""WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\S+')) AS word FROM documents),
      coded AS (SELECT doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT AS code FROM words),
      counts AS (SELECT doc_id, code % 64 AS place, sum(CASE WHEN code >= 2147483648 THEN 1.0 ELSE -1.0 END)::DOUBLE AS n
        FROM coded GROUP BY ALL),
      norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY doc_id)
      SELECT doc_id, place, round(n / norm, 6) AS x FROM counts JOIN norms USING (doc_id) WHERE n <> 0""",
)
def pandas_udf_embed(spark, sf_dir):
    """Documents through a batched embedding hook; the default hashes words into 64 numbers, shown where not zero."""
    embedded = hooks.embed(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", number="double")
    numbers = embedded.select("doc_id", F.posexplode("embedding").alias("place", "x")).filter("x <> 0")
    return numbers.select("doc_id", F.col("place").cast("long").alias("place"), F.round("x", 6).alias("x"))


@query(
    "plugged_in_models",
    r"""WITH asked AS (SELECT item_id, text FROM benchmark),
      pairs AS (SELECT doc_id, text, (SELECT text FROM asked ORDER BY item_id LIMIT 1) AS question FROM documents)
      SELECT doc_id, CASE WHEN length(text) > 1000 THEN 'long' ELSE 'short' END AS kind,
        abs(length(text) - length(question))::DOUBLE AS score FROM pairs""",
)
def plugged_in_models(spark, sf_dir):
    """The classifying and the re-ranking hook, with stand-ins for models that SQL can repeat."""
    question = table(spark, sf_dir, "benchmark").agg(F.min_by("text", "item_id").alias("q")).scalar()
    pairs = table(spark, sf_dir, "documents").select("doc_id", "text", question.alias("question"))
    sorted_out = hooks.classify_with(pairs, "text", lambda texts: ["long" if len(t) > 1000 else "short" for t in texts], "kind")
    scored = hooks.score_with(
        sorted_out, "question", "text", lambda asked, found: [float(abs(len(f) - len(a))) for a, f in zip(asked, found)]
    )
    return scored.select("doc_id", "kind", "score")
