"""Ordered sessions: running values, bounded memory windows, history pages.

A session may hold a large part of all rows. Running values are therefore found in two levels:
inside blocks of consecutive rows, and over one summary row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselight.functions.text import collapse_space
from caselight.session import cut_lineage


def number_block(column: str, size: int = 1000) -> Column:
    return F.floor(F.col(column) / size)


def join_nulls_too(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys match; the columns of ``left``, then the others of ``right``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_r_{k}" for k in keys])


def in_parts(rows: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Range-partition by ``keys`` and ``order`` and fix the result; ``_part`` numbers the parts.

    A long session spans as many parts as its rows fill, a burst of rows with one time included, if ``order`` ends in
    something unique. The result is fixed because both levels of a running value must see the same borders.
    """
    count = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(count, *keys, *order)
    return cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))


def split_running(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column | None = None,
    lasts: list[str] = (),
    sums: list[str] = (),
    number: str | None = None,
) -> DataFrame:
    """Running values up to and with each row, per ``keys`` in ``order``; null keys are a session, null times come first.

    ``lasts``: ``<c>_so_far``, the last non-null value; ``sums``: ``<c>_running``;
    ``number``: a column for the place of the row, from 1. ``block`` must not decrease along
    ``order`` and should split long sessions; only summaries of blocks meet in one task. Without it the
    blocks are range partitions, so their size is measured and not guessed.
    """
    if block is None:
        blocked = in_parts(rows, keys, order).withColumnRenamed("_part", "_block")
    else:
        blocked = rows.withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"_l_{c}": F.last(c, ignorenulls=True).over(up_to) for c in lasts}
    local |= {f"_s_{c}": F.sum(c).over(up_to) for c in sums}
    if number:
        local["_n"] = F.row_number().over(inside).cast("long")

    place = F.struct(*order)
    summary = [F.count("*").alias("_count")]
    summary += [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_bl_{c}") for c in lasts
    ]
    summary += [F.sum(c).alias(f"_bs_{c}") for c in sums]
    blocks = blocked.groupBy(*keys, "_block").agg(*summary)
    earlier = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = [F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_c_n")]
    carried += [F.last(f"_bl_{c}", ignorenulls=True).over(earlier).alias(f"_c_l_{c}") for c in lasts]
    carried += [F.sum(f"_bs_{c}").over(earlier).alias(f"_c_s_{c}") for c in sums]
    carry = blocks.select(*keys, "_block", *carried)

    joined = join_nulls_too(blocked.withColumns(local), carry, [*keys, "_block"]) if local else blocked
    result = {f"{c}_so_far": F.coalesce(f"_l_{c}", f"_c_l_{c}") for c in lasts}
    result |= {
        f"{c}_running": F.coalesce(F.col(f"_s_{c}") + F.col(f"_c_s_{c}"), f"_s_{c}", f"_c_s_{c}") for c in sums
    }
    if number:
        result[number] = F.col("_n") + F.col("_c_n")
    return joined.select(*rows.columns, *[v.alias(k) for k, v in result.items()])


def numbered(messages: DataFrame, block_size: int = 1000) -> DataFrame:
    """User and assistant messages with their place ``n`` in the session, from 0."""
    spoken = messages.filter(F.col("role").isin("user", "assistant"))
    placed = split_running(
        spoken, ["conv_id"], ["turn"], number_block("turn", block_size), number="_place"
    )
    return placed.withColumn("n", F.col("_place") - 1).drop("_place")


def spoken_line(role: Column, text: Column) -> Column:
    return F.concat(F.when(role == "user", "Human: ").otherwise("AI: "), text)


def memory_window(messages: DataFrame, k: int = 5, block_size: int = 1000) -> DataFrame:
    """Adds ``memory``: the last k exchanges (2k messages) before each message.

    A block is handed the last 2k messages of the block before it, so blocks of one session
    can be treated apart.
    """
    back = 2 * k
    if block_size < back:
        raise ValueError("a block must hold the whole memory")
    rows = numbered(messages, block_size).withColumn("line", spoken_line(F.col("role"), F.col("text")))
    own = F.floor(F.col("n") / block_size)
    home = rows.withColumn("_block", own).withColumn("_own", F.lit(True))
    lent = (
        rows.filter(F.pmod("n", F.lit(block_size)) >= block_size - back)
        .withColumn("_block", own + 1)
        .withColumn("_own", F.lit(False))
    )
    frame = Window.partitionBy("conv_id", "_block").orderBy("n").rowsBetween(-back, -1)
    seen = home.unionByName(lent).withColumn("memory", F.collect_list("line").over(frame))
    return seen.filter("_own").drop("_block", "_own")


EMPTY_HISTORY = "No previous conversation."  # fixed value


def _with_history(rows: DataFrame, at: str, page_size: int) -> DataFrame:
    """Adds ``pages_before`` and ``history``: the number of full pages before a row, and the lines after those.

    ``at`` counts the lines before the row. Only row 0 has no line to show: a row that follows a full page shows
    that page, which is lent to it by its first line, and names the pages before it.
    """
    group = F.floor((F.col(at) - 1) / page_size)
    home = rows.withColumn("_group", group).withColumn("_own", F.lit(True))
    lent = rows.filter(F.pmod(at, F.lit(page_size)) == 0).withColumn("_group", F.floor(F.col(at) / page_size))
    frame = Window.partitionBy("conv_id", "_group").orderBy(at, "_own").rowsBetween(Window.unboundedPreceding, -1)
    seen = home.unionByName(lent.withColumn("_own", F.lit(False))).withColumn(
        "history", F.array_join(F.collect_list("line").over(frame), "\n")
    )
    pages = F.greatest(F.col("_group"), F.lit(0))
    return seen.filter("_own").withColumn("pages_before", pages).drop("_own", "_group")


def _full_pages(rows: DataFrame, at: str, page_size: int) -> DataFrame:
    pages = rows.groupBy("conv_id", F.floor(F.col(at) / page_size).alias("page")).agg(
        F.count("*").alias("lines"), F.array_sort(F.collect_list(F.struct(at, "line"))).alias("_items")
    )
    return pages.filter(F.col("lines") == page_size).select(
        "conv_id", "page", F.array_join(F.transform("_items", lambda i: i["line"]), "\n").alias("text")
    )


def _lined(messages: DataFrame, page_size: int) -> DataFrame:
    return numbered(messages, page_size).withColumn("line", spoken_line(F.col("role"), F.col("text")))


def memory_full(messages: DataFrame, page_size: int = 1000) -> DataFrame:
    """The whole history before each message, as pages.

    Repeating it in every row would grow with the square of the session. A row names the number
    of full pages before it (``history_pages``) and holds the rest; sessions up to
    ``page_size`` messages have the whole text in ``history``. ``with_pages`` puts both together.
    """
    opened = _with_history(_lined(messages, page_size), "n", page_size)
    text = F.when(F.col("n") == 0, F.lit(EMPTY_HISTORY)).otherwise(F.col("history"))
    return opened.withColumn("history", text).drop("line")


def history_pages(messages: DataFrame, page_size: int = 1000) -> DataFrame:
    """(conv_id, page, text): the full pages that later messages refer to."""
    return _full_pages(_lined(messages, page_size), "n", page_size)


def with_pages(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of ``memory_full`` or ``memory_switch`` with the whole text in ``history``, their pages put before it.

    The texts together grow with the square of a session; meant for the sessions that are looked at.
    """
    keyed = rows.withColumn("_row", F.struct("conv_id", "n"))
    asked = keyed.filter("pages_before > 0").select(
        "_row", "conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages_before") - 1)).alias("page")
    )
    found = join_nulls_too(asked, pages, ["conv_id", "page"]).groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("page", "text"))).alias("_pages")
    )
    before = F.transform("_pages", lambda p: p["text"])
    whole = F.when(F.col("_pages").isNull(), F.col("history")).otherwise(
        F.array_join(F.concat(before, F.array("history")), "\n")
    )
    joined = keyed.join(found.withColumnRenamed("_row", "_asked"), F.col("_row").eqNullSafe(F.col("_asked")), "left")
    return joined.withColumn("history", whole).select(*rows.columns)


def first_sentence(text: Column) -> Column:
    flat = collapse_space(text)
    found = F.regexp_extract(flat, r"^(.*?[.!?])(\s|$)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), flat)


def _switched(messages: DataFrame, limit: int, page_size: int) -> DataFrame:
    """Numbered messages with the line stored of each: verbatim up to turn ``limit``, then its first sentence."""
    rows = numbered(messages, page_size)
    stored = F.when(
        F.col("n") + 1 < limit, spoken_line(F.col("role"), F.col("text"))
    ).otherwise(first_sentence(F.col("text")))
    return rows.withColumn("line", stored).withColumn("m", F.col("n") - (limit - 1))


def memory_switch(messages: DataFrame, limit: int = 10, page_size: int = 1000) -> DataFrame:
    """History before each message, where turn ``limit`` starts the condensed memory afresh.

    Up to turn ``limit`` the earlier turns stand verbatim; later, only turns from ``limit`` on
    count, each by its first sentence. Pages as in ``memory_full``, from ``condensed_pages``; the turns up to
    ``limit`` are one page.
    """
    lined = _switched(messages, limit, page_size)
    # A row sees what was stored before it; turn ``limit`` itself is the first condensed one.
    late = F.col("m") >= 1
    lined = lined.withColumn("mode", F.when(late, "summary").otherwise("buffer"))
    early = _with_history(lined.filter("m <= 0"), "n", max(limit, page_size))
    after = _with_history(lined.filter("m >= 0"), "m", page_size).filter(late)
    return early.unionByName(after).drop("line", "m")


def condensed_pages(messages: DataFrame, limit: int = 10, page_size: int = 1000) -> DataFrame:
    """(conv_id, page, text): the full pages of condensed lines that later rows of ``memory_switch`` refer to."""
    return _full_pages(_switched(messages, limit, page_size).filter("m >= 0"), "m", page_size)
