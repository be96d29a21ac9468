"""Checked queries on text retrieval: documents are the knowledge base, benchmark texts the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.functions import expansion
from caselight.functions.text import fill_template
from caselight.operators import evaluation, hits, term_index
from caselight.plans.indexes import stored_index
from caselight.plans.ticket_sql import TOKENS, ranked, tfidf
from caselight.registry import query, table, text_literal
from caselight.sources.rows import metadata

INTERNAL = "src0"

_INPUTS = """
chunks AS (SELECT source, doc_id AS ordinal, lang, text FROM documents),
questions AS (SELECT item_id AS query_id, text FROM benchmark)"""
_PAIRS = f"WITH {_INPUTS}, {tfidf('chunks', 'questions', False)}"
_HITS = f"{_PAIRS}, {ranked('pairs', '3')}"
_SHOWN = "query_id, source, ordinal, round(score, 6) AS score, rank"


def knowledge(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "source", F.col("doc_id").alias("ordinal"), "lang", "text"
    )


def questions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def knowledge_index(spark, sf_dir) -> term_index.TermIndex:
    return stored_index(
        spark, "documents", f"{sf_dir}/documents.parquet", lambda: knowledge(spark, sf_dir)
    )


def found_chunks(spark, sf_dir, k: int = 3, exclude: str | None = None) -> DataFrame:
    return term_index.search(questions(spark, sf_dir), knowledge_index(spark, sf_dir), k, exclude)


def _shown(found: DataFrame) -> DataFrame:
    return found.select("query_id", "source", "ordinal", F.round("score", 6).alias("score"), "rank")


@query(
    "term_frequency",
    f"""SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS.format(text='text')}) AS term
      FROM documents) GROUP BY ALL""",
)
def term_frequency(spark, sf_dir):
    return term_index.term_frequency(table(spark, sf_dir, "documents"), ["doc_id"])


@query("tfidf_weights", f"{_PAIRS} SELECT source, ordinal, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, sf_dir):
    weights = knowledge_index(spark, sf_dir).weights()
    return weights.select("source", "ordinal", "term", F.round("weight", 6).alias("weight"))


@query(
    "vocab_stats",
    f"""SELECT count(DISTINCT term) AS vocabulary, (SELECT count(*) FROM documents) AS chunks, count(*) AS tokens,
      true AS estimate_is_close
      FROM (SELECT unnest({TOKENS.format(text='text')}) AS term FROM documents)""",
)
def vocab_stats(spark, sf_dir):
    stats = term_index.vocabulary_stats(knowledge(spark, sf_dir))
    off = F.abs(F.col("vocabulary_approx") - F.col("vocabulary")) / F.col("vocabulary")
    return stats.select("vocabulary", "chunks", "tokens", (off < 0.05).alias("estimate_is_close"))


@query("tfidf_topk", f"{_HITS} SELECT {_SHOWN} FROM hits")
def tfidf_topk(spark, sf_dir):
    return _shown(found_chunks(spark, sf_dir))


@query("tfidf_topk_pruned", f"{_HITS} SELECT {_SHOWN} FROM hits")
def tfidf_topk_pruned(spark, sf_dir):
    """The same hits by the search that prunes on score bounds."""
    return _shown(term_index.search_pruned(questions(spark, sf_dir), knowledge_index(spark, sf_dir)))


@query(
    "tfidf_topk_external",
    f"{_PAIRS}, {ranked('pairs', '3', f'source <> {text_literal(INTERNAL)}')} SELECT {_SHOWN} FROM hits",
)
def tfidf_topk_external(spark, sf_dir):
    return _shown(found_chunks(spark, sf_dir, exclude=INTERNAL))


@query(
    "tfidf_topk_scoped",
    f"""{_PAIRS}, scope AS (SELECT q.query_id, c.source, c.ordinal, coalesce(p.score, 0.0) AS score
        FROM questions q CROSS JOIN chunks c LEFT JOIN pairs p USING (query_id, source, ordinal)
        WHERE c.source = {text_literal(INTERNAL)}),
      {ranked('scope', '2')} SELECT {_SHOWN} FROM hits""",
)
def tfidf_topk_scoped(spark, sf_dir):
    index = knowledge_index(spark, sf_dir)
    return _shown(
        term_index.search_scoped(questions(spark, sf_dir), knowledge(spark, sf_dir), index, INTERNAL)
    )


def _with_text(spark, sf_dir, k: int = 3) -> DataFrame:
    return found_chunks(spark, sf_dir, k).join(knowledge(spark, sf_dir), ["source", "ordinal"])


@query(
    "context_stuff",
    f"""{_HITS} SELECT query_id, string_agg(c.text, chr(10) || chr(10) ORDER BY rank) AS context
      FROM hits JOIN chunks c USING (source, ordinal) GROUP BY query_id""",
)
def context_stuff(spark, sf_dir):
    return hits.stuff_context(_with_text(spark, sf_dir))


_LABEL = """CASE WHEN lang = 'en' THEN source || ' [Product: ' || ordinal::VARCHAR || ']'
  WHEN lang = 'fr' THEN source || ' [§ ' || lang || ']'
  WHEN lang = 'de' THEN source || ' [faq-' || ordinal::VARCHAR || ']' ELSE source END"""


@query(
    "citation_format",
    f"""{_HITS} SELECT q.query_id, coalesce(string_agg({_LABEL}, ' | ' ORDER BY rank), 'No sources') AS citations
      FROM questions q LEFT JOIN hits h USING (query_id) LEFT JOIN chunks c USING (source, ordinal)
      GROUP BY q.query_id""",
)
def citation_format(spark, sf_dir):
    """The metadata of a chunk differ by language, so that every precedence occurs."""
    lang, ordinal = F.col("lang"), F.col("ordinal").cast("string")
    described = _with_text(spark, sf_dir).withColumn(
        "metadata",
        metadata(
            source_file=F.col("source"),
            product_id=F.when(lang == "en", ordinal),
            section_heading=F.when(lang.isin("en", "fr"), lang),
            question_number=F.when(lang == "de", F.concat(F.lit("faq-"), ordinal)),
        ),
    )
    return hits.citations(questions(spark, sf_dir), described)


@query(
    "distinct_sources",
    f"""{_HITS} SELECT query_id, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources
      FROM hits GROUP BY query_id""",
)
def distinct_sources(spark, sf_dir):
    found = hits.distinct_sources(found_chunks(spark, sf_dir))
    return found.select("query_id", F.array_join("sources", ",").alias("sources"))


PROMPT = "Answer from the context only.\n\nContext:\n{context}\n\nQuestion: {question}\n\nAnswer:"


@query(
    "prompt_fill",
    f"""{_HITS}, stuffed AS (SELECT query_id, string_agg(c.text, chr(10) || chr(10) ORDER BY rank) AS context
        FROM hits JOIN chunks c USING (source, ordinal) GROUP BY query_id)
      SELECT query_id, replace(replace({text_literal(PROMPT)}, '{{context}}', context), '{{question}}', q.text)
        AS prompt FROM stuffed JOIN questions q USING (query_id)""",
)
def prompt_fill(spark, sf_dir):
    contexts = hits.stuff_context(_with_text(spark, sf_dir)).join(questions(spark, sf_dir), "query_id")
    filled = fill_template(F.lit(PROMPT), {"context": F.col("context"), "question": F.col("text")})
    return contexts.select("query_id", filled.alias("prompt"))


# The lead sentence of a document is its summary, the child that points at the parent.
_LEAD = r"coalesce(nullif(regexp_extract(text, '^([^.\n]*[.\n])', 1), ''), text)"
_CHILDREN = f"""
questions AS (SELECT item_id AS query_id, text FROM benchmark),
leads AS (SELECT source, doc_id AS ordinal, {_LEAD} AS text FROM documents)"""


def _lead_hits(spark, sf_dir, k: int = 3) -> DataFrame:
    lead = F.regexp_extract("text", r"^([^.\n]*[.\n])", 1)
    children = knowledge(spark, sf_dir).withColumn(
        "text", F.coalesce(F.nullif(lead, F.lit("")), F.col("text"))
    )
    index = stored_index(spark, "leads", f"{sf_dir}/documents.parquet", lambda: children)
    return term_index.search(questions(spark, sf_dir), index, k)


@query(
    "parent_of_child_hits",
    f"""WITH {_CHILDREN}, {tfidf('leads', 'questions', False)}, {ranked('pairs', '5')}
      SELECT query_id, h.ordinal AS doc_id, rank, d.text FROM hits h JOIN documents d ON d.doc_id = h.ordinal""",
)
def parent_of_child_hits(spark, sf_dir):
    children = _lead_hits(spark, sf_dir, 5).withColumnRenamed("ordinal", "doc_id")
    parents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hits.parents_of_hits(children, parents, 5).select("query_id", "doc_id", "rank", "text")


@query(
    "hybrid_union",
    f"""WITH {_CHILDREN}, by_summary AS (WITH {tfidf('leads', 'questions', False)}, {ranked('pairs', '3')}
        SELECT query_id, source, ordinal, rank FROM hits),
      chunks AS (SELECT source, doc_id AS ordinal, text FROM documents),
      by_text AS (WITH {tfidf('chunks', 'questions', False)}, {ranked('pairs', '3')}
        SELECT query_id, source, ordinal, rank FROM hits)
      SELECT *, 'summary' AS origin, 0::BIGINT AS origin_order FROM by_summary
      UNION ALL SELECT *, 'full_text', 1::BIGINT FROM by_text""",
)
def hybrid_union(spark, sf_dir):
    columns = ["query_id", "source", "ordinal", "rank"]
    return hits.hybrid_union(
        _lead_hits(spark, sf_dir).select(*columns), found_chunks(spark, sf_dir).select(*columns)
    )


_SYN_ROWS = ", ".join(
    f"({i}, {text_literal(t)}, {text_literal(s[0])})" for i, (t, s) in enumerate(expansion.PART_SYNONYMS)
)


@query(
    "synonym_expand",
    f"""WITH syn(ord, term, synonym) AS (VALUES {_SYN_ROWS}),
      named AS (SELECT p_partkey, p_name || ' with ANC' AS q FROM part),
      grown AS (SELECT p_partkey, ord + 1 AS ord,
          regexp_replace(q, term, synonym, 'gi') AS variant FROM named, syn
          WHERE contains(lower(q), lower(term))
        UNION ALL SELECT p_partkey, 0, q FROM named),
      firsts AS (SELECT p_partkey, variant, min(ord) AS ord FROM grown GROUP BY ALL)
      SELECT p_partkey, variant, row_number() OVER (PARTITION BY p_partkey ORDER BY ord) - 1 AS place FROM firsts
      QUALIFY place < 3""",
)
def synonym_expand(spark, sf_dir):
    """Part names as shopping queries, each with up to three variants."""
    named = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" with ANC")).alias("q"))
    variants = expansion.variants(F.col("q"), expansion.PART_SYNONYMS, 1, 3)
    return named.select("p_partkey", F.posexplode(variants).alias("place", "variant")).withColumn(
        "place", F.col("place").cast("long")
    )


@query(
    "template_select",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'support' WHEN '2-HIGH' THEN 'seller'
        ELSE 'shopper' END AS persona,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Help the agent with order ' WHEN '2-HIGH'
        THEN 'Advise the seller on order ' ELSE 'Help the shopper with order ' END || o_orderkey::VARCHAR AS prompt
      FROM orders""",
)
def template_select(spark, sf_dir):
    """Personas by order priority; an unknown one falls back to the shopper's."""
    asked = F.when(F.col("o_orderpriority") == "1-URGENT", "support").when(
        F.col("o_orderpriority") == "2-HIGH", "seller"
    ).otherwise(F.col("o_orderpriority"))
    chosen, template = expansion.template_for(asked)
    filled = fill_template(template, {"order": F.col("o_orderkey").cast("string")})
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", chosen.alias("persona"), filled.alias("prompt")
    )


def _retrieve_sql(chunks: str) -> str:
    return f"""WITH {chunks}, questions AS (SELECT item_id AS query_id, text FROM benchmark),
  variants AS (SELECT query_id || '/0' AS query_id, text FROM questions
    UNION ALL SELECT query_id || '/1', regexp_replace(text, 'tion', 'sion', 'gi') FROM questions
      WHERE contains(lower(text), 'tion') AND regexp_replace(text, 'tion', 'sion', 'gi') <> text),
  {tfidf('chunks', 'variants', False)}, {ranked('pairs', '5', name='variant_hits')},
  told AS (SELECT split_part(h.query_id, '/', 1)::BIGINT AS query_id, source, ordinal, c.text,
      sqrt(greatest(2 * (1 - score), 0)) AS distance FROM variant_hits h JOIN chunks c USING (source, ordinal)),
  best AS (SELECT * FROM told
    QUALIFY row_number() OVER (PARTITION BY query_id, text ORDER BY floor(distance * 1e9 + 0.5), source, ordinal) = 1),
  merged AS (SELECT * FROM best
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY floor(distance * 1e9 + 0.5), source, ordinal) <= 5),
  second AS (SELECT m.query_id, m.source, m.ordinal, m.text,
      len(list_intersect(list_distinct({TOKENS.format(text='q.text')}), {TOKENS.format(text='m.text')}))
        / len(list_distinct({TOKENS.format(text='q.text')}))::DOUBLE AS score
    FROM merged m JOIN questions q USING (query_id)),
  kept AS (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY floor(score * 1e9 + 0.5) DESC, source, ordinal) AS rank
    FROM second QUALIFY rank <= 3)
  SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(source || ' [Product: ' || ordinal::VARCHAR || ']', ' | ' ORDER BY rank) AS citations
  FROM kept GROUP BY query_id"""


@query("retrieve_context", _retrieve_sql("chunks AS (SELECT source, doc_id AS ordinal, text FROM documents)"))
def retrieve_context(spark, sf_dir):
    """Expand, search per variant, merge, re-rank by word overlap, stuff and cite."""
    from caselight.plans.retrieve import retrieve_and_stuff

    return retrieve_and_stuff(
        questions(spark, sf_dir), knowledge(spark, sf_dir), knowledge_index(spark, sf_dir),
        synonyms=[("tion", ["sion"])],
    )


@query(
    "retrieve_repeated_ordinals",
    _retrieve_sql(
        "chunks AS (SELECT 'book' || (doc_id % 7)::VARCHAR AS source, doc_id // 7 AS ordinal, text FROM documents)"
    ),
)
def retrieve_repeated_ordinals(spark, sf_dir):
    """The same over seven sources that count their chunks alike: an ordinal alone names no chunk."""
    from caselight.plans.retrieve import retrieve_and_stuff

    chunks = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("book"), (F.col("doc_id") % 7).cast("string")).alias("source"),
        F.expr("doc_id div 7").alias("ordinal"),
        "text",
    )
    index = stored_index(spark, "books", f"{sf_dir}/documents.parquet", lambda: chunks)
    return retrieve_and_stuff(questions(spark, sf_dir), chunks, index, synonyms=[("tion", ["sion"])])


@query(
    "lexical_faithfulness",
    f"""{_HITS}, stuffed AS (SELECT query_id, string_agg(c.text, chr(10) || chr(10) ORDER BY rank) AS context
        FROM hits JOIN chunks c USING (source, ordinal) GROUP BY query_id)
      SELECT query_id, round(len(list_intersect(list_distinct({TOKENS.format(text='q.text')}),
          {TOKENS.format(text='context')})) / len(list_distinct({TOKENS.format(text='q.text')}))::DOUBLE, 6) AS score
      FROM stuffed JOIN questions q USING (query_id)""",
)
def lexical_faithfulness(spark, sf_dir):
    """Share of the words of each benchmark text, taken as an answer, that its found context holds."""
    contexts = hits.stuff_context(_with_text(spark, sf_dir)).join(questions(spark, sf_dir), "query_id")
    share = evaluation.lexical_share(F.col("text"), F.col("context"))
    return contexts.select("query_id", F.round(share, 6).alias("score"))
