"""Chunkers. Each works inside the row that holds the document, so none needs a shuffle.

They return an array column; ``explode_chunks`` turns it into rows ``(ordinal, chunk)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.functions.text import let, strip, words

# Break points by priority.
SEPARATORS = ["\n\n", "\n", ". ", " "]


def explode_chunks(rows: DataFrame, chunks: Column, *keep: str) -> DataFrame:
    """One row per chunk with its ``ordinal`` from 0."""
    return rows.select(*keep, F.posexplode(chunks).alias("ordinal", "chunk")).withColumn(
        "ordinal", F.col("ordinal").cast("long")
    )


def md_sections(text: Column) -> Column:
    """Level-2 sections as (section, text); title blocks and blanks are dropped."""
    blocks = F.transform(F.split(text, r"\n(?=## )"), strip)
    kept = F.filter(blocks, lambda b: (F.length(b) > 0) & ~F.startswith(b, F.lit("# ")))
    heading = lambda b: strip(F.regexp_extract(b, r"^##\s+(.+)", 1))
    return F.transform(
        kept,
        lambda b: F.struct(
            F.coalesce(F.nullif(heading(b), F.lit("")), F.lit("Introduction")).alias("section"),
            b.alias("text"),
        ),
    )


def md_header_paths(text: Column) -> Column:
    """Sections at levels 1 to 3 as (h1, section_heading, subsection_heading, text).

    A heading opens a section, stays in its text, and clears the deeper levels. Splitting level by
    level gives each piece its path without carrying anything from line to line.
    """

    def blocks(part: Column, level: int) -> Column:
        return F.split(part, rf"\n(?=#{{{level}}}\s+\S)")

    def title(part: Column, level: int) -> Column:
        return F.nullif(strip(F.regexp_extract(part, rf"^#{{{level}}}\s+([^\n]*)", 1)), F.lit(""))

    def section(one: Column, two: Column, three: Column) -> Column:
        return F.struct(
            title(one, 1).alias("h1"),
            title(two, 2).alias("section_heading"),
            title(three, 3).alias("subsection_heading"),
            strip(three).alias("text"),
        )

    nested = F.transform(
        blocks(text, 1),
        lambda one: F.flatten(
            F.transform(
                blocks(one, 2),
                lambda two: F.transform(blocks(two, 3), lambda three: section(one, two, three)),
            )
        ),
    )
    return F.filter(F.flatten(nested), lambda s: F.length(s["text"]) > 0)


def word_windows(text: Column, size: int = 100) -> Column:
    """Consecutive windows of ``size`` words, joined by single blanks."""
    none = F.array().cast("array<int>")

    def windows(pieces: Column) -> Column:
        starts = F.when(
            F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces), F.lit(size))
        ).otherwise(none)
        return F.transform(starts, lambda s: F.array_join(F.slice(pieces, s, F.lit(size)), " "))

    return let(words(text), windows)


def char_windows(text: Column, size: int = 512, overlap: int = 50) -> Column:
    """Windows of ``size`` characters that step by ``size - overlap``; the last one ends the text."""
    last = F.greatest(F.lit(1), F.length(text) - overlap)
    starts = F.sequence(F.lit(1), last, F.lit(size - overlap))
    return F.when(
        F.length(text) > 0, F.transform(starts, lambda s: F.substring(text, s, F.lit(size)))
    ).otherwise(F.array().cast("array<string>"))


def recursive_cuts(text: Column, size: int, overlap: int) -> Column:
    """(start, length) of chunks of at most ``size`` characters that share ``overlap`` characters.

    A window of ``size`` is cut after its last paragraph break, else line, sentence or word break,
    where that lies in the second half; a window without any is cut at its full size.
    """
    if overlap * 2 >= size:
        raise ValueError("the overlap must be under half the size")
    half = size // 2

    def cut_of(window: Column) -> Column:
        """Length up to the last break of the best kind, the whole window when there is none."""
        heads = [
            F.length(F.regexp_extract(window, f"(?s)^(.*{separator.replace('.', '[.]')})", 1))
            for separator in SEPARATORS
        ]
        kept = [F.when(head > half, head) for head in heads]
        return F.coalesce(*[let(k, lambda x: x) for k in kept], F.lit(size))

    def cuts(total: Column) -> Column:
        most = F.ceil(total / (half - overlap)).cast("int") + 1
        start = F.struct(
            F.lit(1).alias("at"), F.array().cast("array<struct<first:int,chars:int>>").alias("done")
        )

        def grow(state: Column, chars: Column) -> Column:
            piece = F.struct(state["at"].alias("first"), chars.alias("chars"))
            ends = state["at"] + chars > total
            return F.struct(
                F.when(ends, total + 1).otherwise(state["at"] + chars - overlap).alias("at"),
                F.concat(state["done"], F.array(piece)).alias("done"),
            )

        def step(state: Column, _: Column) -> Column:
            left = total - state["at"] + 1
            chars = F.when(left <= size, left).otherwise(
                let(F.substring(text, state["at"], F.lit(size)), cut_of)
            )
            return F.when(left <= 0, state).otherwise(let(chars, lambda c: grow(state, c)))

        return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["done"])

    return let(F.length(text), cuts)


def recursive_chunks(text: Column, size: int = 900, overlap: int = 120) -> Column:
    cuts = F.when(F.length(text) > 0, recursive_cuts(text, size, overlap))
    pieces = F.transform(cuts, lambda c: F.substring(text, c["first"], c["chars"]))
    return F.coalesce(pieces, F.array().cast("array<string>"))


def resplit_oversize(text: Column, size: int = 1500, overlap: int = 150) -> Column:
    """The text alone when it fits, else its recursive chunks."""
    return F.when(F.length(text) > size, recursive_chunks(text, size, overlap)).otherwise(F.array(text))


def paragraph_chunks(text: Column, size: int = 1000, overlap: int = 100, separator: str = "\n\n") -> Column:
    """Paragraphs merged up to ``size``; a longer one stays whole.

    A new chunk starts with the trailing paragraphs of the last one that fit in ``overlap``. The
    fold carries paragraph numbers and running lengths only; texts are joined at the end.
    """
    gap = len(separator)
    none = F.array().cast("array<string>")

    def merged(pieces: Column) -> Column:
        def span(first: Column, last: Column) -> Column:
            """Length of paragraphs first..last joined, 0 when there is none."""
            chars = F.aggregate(
                F.slice(pieces, first, F.greatest(last - first + 1, F.lit(0))),
                F.lit(0),
                lambda total, p: total + F.length(p) + gap,
            )
            return F.greatest(chars - gap, F.lit(0))

        def carried_from(first: Column, i: Column) -> Column:
            """First paragraph of the longest tail of first..i-1 that fits, or i for none."""
            fits = lambda j: (span(j, i - 1) <= overlap) & (span(j, i) <= size)
            return F.coalesce(F.get(F.filter(F.sequence(first, i - 1), fits), F.lit(0)), i)

        start = F.struct(
            F.array().cast("array<struct<first:int,last:int>>").alias("done"), F.lit(1).alias("first")
        )

        def step(state: Column, i: Column) -> Column:
            full = (i > state["first"]) & (span(state["first"], i) > size)
            group = F.struct(state["first"].alias("first"), (i - 1).alias("last"))
            moved = F.struct(
                F.concat(state["done"], F.array(group)).alias("done"),
                carried_from(state["first"], i).alias("first"),
            )
            return F.when(full, moved).otherwise(state)

        def close(state: Column) -> Column:
            rest = F.struct(state["first"].alias("first"), F.size(pieces).alias("last"))
            return F.concat(state["done"], F.array(rest))

        groups = F.aggregate(F.sequence(F.lit(1), F.size(pieces)), start, step, close)
        text_of = lambda g: F.slice(pieces, g["first"], g["last"] - g["first"] + 1)
        joined = F.transform(groups, lambda g: F.array_join(text_of(g), separator))
        return F.when(F.size(pieces) > 0, joined).otherwise(none)

    pieces = F.filter(F.transform(F.split(text, separator), strip), lambda p: F.length(p) > 0)
    return let(pieces, merged)


def chunk_stats(chunks: DataFrame, kind: str, text: str = "chunk") -> DataFrame:
    """Count, floor of the mean, least, most and all characters per kind; a null kind is the total."""
    chars = F.length(text).cast("long")
    return chunks.rollup(kind).agg(
        F.count("*").alias("chunks"),
        F.floor(F.avg(chars)).alias("mean_chars"),
        F.min(chars).alias("min_chars"),
        F.max(chars).alias("max_chars"),
        F.sum(chars).alias("total_chars"),
    )


def compare_strategies(named: dict[str, DataFrame], by: str) -> DataFrame:
    """The same figures for several chunkers side by side."""
    parts = [d.select(by, "chunk", F.lit(name).alias("strategy")) for name, d in named.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    chars = F.length("chunk").cast("long")
    return (
        every.groupBy(by)
        .pivot("strategy", list(named))
        .agg(
            F.count(F.lit(1)).alias("chunks"),
            F.floor(F.avg(chars)).alias("mean"),
            F.max(chars).alias("max"),
        )
    )
