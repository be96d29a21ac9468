"""What is made of ranked hits: contexts, citations, unions, parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_rank_order(text: str, separator: str) -> Column:
    """Aggregate: the texts of one query joined by rank."""
    items = F.array_sort(F.collect_list(F.struct("rank", text)))
    return F.array_join(F.transform(items, lambda i: i[text]), separator)


def stuff_context(hits: DataFrame, text: str = "text") -> DataFrame:
    """One context per query: its k chunks, a blank line between them."""
    return hits.groupBy("query_id").agg(in_rank_order(text, "\n\n").alias("context"))


def citation(meta: Column) -> Column:
    """Label of one chunk by its most telling metadata."""
    # The forms of a citation.
    source = F.coalesce(meta["source_file"], F.lit("?"))
    present = lambda key: F.length(F.coalesce(meta[key], F.lit(""))) > 0
    return (
        F.when(present("product_id"), F.concat(source, F.lit(" [Product: "), meta["product_id"], F.lit("]")))
        .when(present("section_heading"), F.concat(source, F.lit(" [§ "), meta["section_heading"], F.lit("]")))
        .when(present("question_number"), F.concat(source, F.lit(" ["), meta["question_number"], F.lit("]")))
        .otherwise(source)
    )


NO_SOURCES = "No sources"  # fixed value


def citations(queries: DataFrame, hits: DataFrame, meta: str = "metadata") -> DataFrame:
    """One citation line per query, also for a query without hits."""
    labelled = hits.withColumn("label", citation(F.col(meta)))
    lines = labelled.groupBy("query_id").agg(in_rank_order("label", " | ").alias("citations"))
    return queries.select("query_id").join(lines, "query_id", "left").withColumn(
        "citations", F.coalesce("citations", F.lit(NO_SOURCES))
    )


def distinct_sources(hits: DataFrame, source: str = "source") -> DataFrame:
    kept = F.collect_set(F.when(F.length(source) > 0, F.col(source)))
    return hits.groupBy("query_id").agg(F.array_sort(kept).alias("sources"))


def parents_of_hits(child_hits: DataFrame, parents: DataFrame, k: int) -> DataFrame:
    """Parents of the hit children, each once, by the best rank among its children."""
    best = child_hits.groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank")).filter(F.col("rank") <= k)
    return best.join(parents, "doc_id")


def hybrid_union(summary_hits: DataFrame, text_hits: DataFrame) -> DataFrame:
    """Both hit lists one after the other; a chunk found twice stays twice."""
    tagged = lambda hits, name, place: hits.withColumns(
        {"origin": F.lit(name), "origin_order": F.lit(place).cast("long")}
    )
    return tagged(summary_hits, "summary", 0).unionByName(tagged(text_hits, "full_text", 1))
