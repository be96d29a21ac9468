"""Rows of tables, web pages and files as chunks with metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.functions.text import collapse_space, decode_entities, drop_hidden, drop_tags, strip

TEXT_KINDS = ["md", "txt"]


def key_value_text(columns: list[str]) -> Column:
    """``name: value`` per line in column order; null reads as empty."""
    parts = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    return F.concat_ws("\n", *parts)


def labelled_lines(parts: list[tuple[str, Column]]) -> Column:
    return F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), value) for label, value in parts])


def metadata(**entries: Column) -> Column:
    """A string map; entries with a null value are left out."""
    pairs = []
    for key, value in entries.items():
        pairs += [F.lit(key), value.cast("string")]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def product_chunks(catalogue: DataFrame, source_file: str) -> DataFrame:
    """One chunk per product row, from the columns of a full catalogue."""
    # The labels of the lines and their fallbacks.
    yes_no = lambda c: F.when(F.col(c), "Yes").otherwise("No")
    say = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit(other))
    text = labelled_lines(
        [
            ("Product", say("name", "")),
            ("Brand", say("brand", "")),
            ("Category", F.concat(say("category", ""), F.lit(" > "), say("subcategory", ""))),
            ("Price", F.concat(F.lit("₹"), say("price_inr", "N/A"))),
            ("Rating", F.concat(say("rating", "N/A"), F.lit("/5 ("), say("rating_count", "0"), F.lit(" reviews)"))),
            ("Specs", say("specs", "N/A")),
            ("Warranty", F.concat(say("warranty_months", "0"), F.lit(" months"))),
            (
                "Returnable",
                F.concat(yes_no("returnable"), F.lit(" ("), say("return_window_days", "0"), F.lit("-day window)")),
            ),
            ("Seller ID", F.concat(say("seller_id", ""), F.lit(" (Verified: "), yes_no("seller_verified"), F.lit(")"))),
            ("Description", say("description", "")),
        ]
    )
    return catalogue.select(
        text.alias("text"),
        metadata(
            source_file=F.lit(source_file),
            file_type=F.lit("csv"),
            product_id=say("product_id", "UNKNOWN"),
            product_name=say("name", ""),
            category=say("category", ""),
            price_inr=F.coalesce(F.col("price_inr").cast("double"), F.lit(0.0)),
        ).alias("metadata"),
    )


def review_chunks(reviews: DataFrame, source_file: str) -> DataFrame:
    """One chunk per review theme: ``product_id, theme, sentiment, mention_count, summary, quote``."""
    # The labels of the lines.
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Product Review Summary — Product ID: "), F.col("product_id")),
        F.concat(F.lit("Theme: "), F.col("theme"), F.lit(" | Sentiment: "), F.col("sentiment")),
        F.concat(F.lit("Mentions: "), F.col("mention_count").cast("string")),
        F.concat(F.lit("Summary: "), F.col("summary")),
        F.concat(F.lit("Representative quote: "), F.col("quote")),
    )
    return reviews.select(
        text.alias("text"),
        metadata(
            source_file=F.lit(source_file), file_type=F.lit("csv"),
            product_id=F.col("product_id"), theme=F.col("theme"),
        ).alias("metadata"),
    )


def field_from_text(text: Column, label: str, unknown: str = "Unknown") -> Column:
    """Value of a ``Label: value`` line."""
    found = F.regexp_extract(text, rf"(?m)^{label}: (.*)$", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(unknown))


def faq_articles(html: Column) -> Column:
    """Articles of a page in order as (question_number, section, text).

    A heading of level 2 names the section of the articles after it. The pieces of one page are
    folded inside its row.
    """
    pieces = F.regexp_extract_all(
        drop_hidden(html), F.lit(r"(?is)<h2\b[^>]*>.*?</h2\s*>|<article\b[^>]*>.*?</article\s*>"), F.lit(0)
    )
    plain = lambda piece: collapse_space(decode_entities(drop_tags(piece, " ")))
    joined = lambda piece: strip(decode_entities(drop_tags(piece, "")))
    start = F.struct(
        F.lit("General").alias("section"),
        F.array().cast("array<struct<question_number:string,section:string,text:string>>").alias("done"),
    )

    def step(state: Column, piece: Column) -> Column:
        number = F.regexp_extract(piece, r"""(?is)^<article\b[^>]*\bid\s*=\s*["']([^"']*)["']""", 1)
        article = F.struct(
            F.coalesce(F.nullif(number, F.lit("")), F.lit("faq-unknown")).alias("question_number"),
            state["section"].alias("section"),
            plain(piece).alias("text"),
        )
        is_heading = F.startswith(F.lower(piece), F.lit("<h2"))
        return F.when(
            is_heading, F.struct(joined(piece).alias("section"), state["done"].alias("done"))
        ).otherwise(
            F.struct(
                state["section"].alias("section"), F.concat(state["done"], F.array(article)).alias("done")
            )
        )

    return F.aggregate(pieces, start, step, lambda s: s["done"])


def category_of(relative_path: Column) -> Column:
    """First folder of a path below the base, ``general`` for a file in the base itself."""
    folder = F.regexp_extract(relative_path, r"^([^/]+)/", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.lit("general"))


def file_kind(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def is_hidden(path: Column) -> Column:
    return F.startswith(F.element_at(F.split(path, "/"), -1), F.lit("."))


def load_text_folder(spark: SparkSession, folder: str, pattern: str = "*.md", by_parent: bool = False) -> DataFrame:
    """Whole files of a folder as (source, text), in the order of their names.

    ``by_parent`` takes trees in which each text has a folder of its own and names it by that folder.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    if by_parent:
        reader = reader.option("recursiveFileLookup", "true")
    name = F.element_at(F.split("_metadata.file_path", "/"), -2) if by_parent else F.col("_metadata.file_name")
    named = reader.text(folder, wholetext=True).select(name.alias("source"), F.col("value").alias("text"))
    return named.orderBy("source")


MOST_TEXT_BYTES = 64 << 20


def _any_case(kind: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in kind)


def ingest_folder(spark: SparkSession, base: str, most_bytes: int = MOST_TEXT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects) below a folder; hidden files are neither.

    Rejected are other kinds than text, files over ``most_bytes`` and text that is no UTF-8. Only the content of
    text files of accepted size is read; the rest is judged by name and size.
    """
    below = F.regexp_replace(F.col("path"), "^.*?" + re.escape(base.rstrip("/")) + "/", "")

    def files(*columns: str, pattern: str = "*") -> DataFrame:
        read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        listed = read.load(base).select("path", "length", *columns).withColumn("source", below)
        return listed.filter(~is_hidden(F.col("source"))).withColumn("kind", file_kind(F.col("source")))

    kinds = "*.{" + ",".join(map(_any_case, TEXT_KINDS)) + "}"
    texts = files("content", pattern=kinds).filter(F.col("length") <= most_bytes)
    read = texts.withColumn("text", F.try_validate_utf8(F.col("content").cast("string")))
    documents = read.filter(F.col("text").isNotNull()).select(
        "source", category_of(F.col("source")).alias("category"), "text"
    )
    is_text = F.col("kind").isin(TEXT_KINDS)
    unread = files().filter(~is_text | (F.col("length") > most_bytes))
    reason = F.when(is_text, "too large").otherwise("unsupported kind")
    rejects = unread.select("source", "kind", reason.alias("reason")).unionByName(
        read.filter(F.col("text").isNull()).select("source", "kind", F.lit("unreadable text").alias("reason"))
    )
    return documents, rejects
