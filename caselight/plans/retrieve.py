"""Retrieve and stuff: expand, search, merge, re-rank, join the texts and cite them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.functions import expansion
from caselight.functions import vectors as vx
from caselight.operators import dense, evaluation, hits, term_index
from caselight.sources.rows import metadata


def retrieve_and_stuff(
    queries: DataFrame,
    chunks: DataFrame,
    index: term_index.TermIndex,
    synonyms: list = expansion.SYNONYMS,
    per_variant: int = 5,
    keep: int = 3,
) -> DataFrame:
    """(query_id, context, citations) for queries with at least one hit.

    A chunk is known by (source, ordinal). Hits of several variants, and chunks with the same text, are merged by
    ``dense.content_key``: the product id where there is one, else a hash of the whole text.
    """
    variants = queries.select(
        "query_id", F.posexplode(expansion.variants(F.col("text"), synonyms)).alias("n", "text")
    ).select(F.concat_ws("/", "query_id", "n").alias("query_id"), "text")
    found = term_index.search(variants, index, per_variant)
    id_type = queries.schema["query_id"].dataType
    texts = chunks.select("source", "ordinal", "text")
    keyed = found.join(texts, term_index.CHUNK_KEY).select(
        F.split_part("query_id", F.lit("/"), F.lit(1)).cast(id_type).alias("query_id"),
        dense.content_key(F.col("text")).alias("key"),
        F.struct("source", "ordinal").alias("id"),
        vx.angular_distance(F.col("score")).alias("distance"),
    )
    merged = dense.merge_variants(keyed, per_variant)
    asked = queries.select("query_id", F.col("text").alias("question"))
    candidates = (
        merged.withColumns({"score": 1 - F.col("distance"), "source": F.col("id.source"), "ordinal": F.col("id.ordinal")})
        .join(texts, term_index.CHUNK_KEY)
        .join(asked, "query_id")
    )
    best = dense.rerank(candidates, evaluation.lexical_share(F.col("question"), F.col("text")), keep)
    described = best.withColumn(
        "metadata",
        metadata(
            source_file=F.col("source"), product_id=F.col("ordinal"),
            section_heading=F.lit(None).cast("string"), question_number=F.lit(None).cast("string"),
        ),
    ).withColumn("label", hits.citation(F.col("metadata")))
    return described.groupBy("query_id").agg(
        hits.in_rank_order("text", "\n\n").alias("context"),
        hits.in_rank_order("label", " | ").alias("citations"),
    )
