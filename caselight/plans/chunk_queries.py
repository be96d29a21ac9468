"""Checked queries on chunkers."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselight.functions.text import words
from caselight.operators import chunking
from caselight.registry import query, table


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _markdown():
    """A document as Markdown: a title, an untitled part, one section per line, sub-sections."""
    lines = F.split("text", "\n")
    body = F.transform(
        lines,
        lambda line, i: F.concat(
            F.when(i % 3 == 2, F.lit("### Part ")).otherwise(F.lit("## Part ")),
            i.cast("string"), F.lit("\n"), line,
        ),
    )
    return F.concat(
        F.lit("# Document "), F.col("doc_id").cast("string"), F.lit("\nsource "), F.col("source"), F.lit("\n"),
        F.array_join(body, "\n"),
    )


_MARKDOWN_SQL = """
lines AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
md AS (SELECT doc_id, '# Document ' || doc_id::VARCHAR || chr(10) || 'source ' || source || chr(10)
  || array_to_string(list_transform(lines, lambda x, i:
       CASE WHEN (i - 1) % 3 = 2 THEN '### Part ' ELSE '## Part ' END || (i - 1)::VARCHAR || chr(10) || x),
       chr(10)) AS md FROM lines)"""


@query(
    "md_sections",
    rf"""WITH {_MARKDOWN_SQL},
      marked AS (SELECT doc_id, unnest(string_split(replace(md, chr(10) || '## ', chr(1) || '## '), chr(1))) AS part
        FROM md),
      parts AS (SELECT doc_id, regexp_replace(part, '^\s+|\s+$', '', 'g') AS text FROM marked)
      SELECT doc_id, coalesce(nullif(trim(regexp_extract(text, '^##\s+(.+)', 1)), ''), 'Introduction') AS section,
        text FROM parts WHERE length(text) > 0 AND NOT starts_with(text, '# ')""",
)
def md_sections(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.explode(chunking.md_sections(_markdown())).alias("s")
    ).select("doc_id", "s.*")


@query(
    "md_header_path",
    rf"""WITH {_MARKDOWN_SQL},
      pieces AS (SELECT doc_id, 0 AS i, '# Document ' || doc_id::VARCHAR || chr(10) || 'source ' || source AS text,
          'Document ' || doc_id::VARCHAR AS h1, NULL AS h2, NULL AS h3 FROM lines
        UNION ALL
        SELECT doc_id, i, CASE WHEN (i - 1) % 3 = 2 THEN '### Part ' ELSE '## Part ' END || (i - 1)::VARCHAR
            || chr(10) || lines[i], 'Document ' || doc_id::VARCHAR,
          'Part ' || (CASE WHEN (i - 1) % 3 = 2 THEN i - 2 ELSE i - 1 END)::VARCHAR,
          CASE WHEN (i - 1) % 3 = 2 THEN 'Part ' || (i - 1)::VARCHAR END
        FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM lines))
      SELECT doc_id, h1, h2 AS section_heading, h3 AS subsection_heading,
        regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM pieces""",
)
def md_header_path(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.explode(chunking.md_header_paths(_markdown())).alias("s")
    ).select("doc_id", "s.*")


def _cut_sql(pos: str, size: int) -> str:
    half = size // 2
    head = lambda sep: f"length(regexp_extract(substring(d.text, {pos}, {size}), '(?s)^(.*{sep})', 1))"
    tests = " ".join(
        f"WHEN {head(sep)} > {half} THEN {head(sep)}" for sep in (r"\n\n", r"\n", r"[.] ", " ")
    )
    return (
        f"CASE WHEN length(d.text) - ({pos}) + 1 <= {size} THEN length(d.text) - ({pos}) + 1 {tests} ELSE {size} END"
    )


def recursive_sql(size: int, overlap: int, source: str = "documents", key: str = "doc_id") -> str:
    """``cuts(key, ordinal, pos, chars)`` of a sub-query with ``key`` and ``text``."""
    following = f"c.pos + c.chars - {overlap}"
    return f"""cuts AS (
      SELECT d.{key}, 0 AS ordinal, 1::BIGINT AS pos, ({_cut_sql('1', size)})::BIGINT AS chars
      FROM {source} d WHERE length(d.text) > 0
      UNION ALL
      SELECT d.{key}, c.ordinal + 1, {following}, {_cut_sql(f'({following})', size)}
      FROM cuts c JOIN {source} d USING ({key}) WHERE length(d.text) - c.pos + 1 > {size})"""


@query(
    "recursive_chunks",
    f"""WITH RECURSIVE {recursive_sql(900, 120)}
      SELECT doc_id, ordinal::BIGINT AS ordinal, substring(text, pos, chars) AS chunk
      FROM cuts JOIN documents USING (doc_id)""",
)
def recursive_chunks(spark, sf_dir):
    return chunking.explode_chunks(
        _documents(spark, sf_dir), chunking.recursive_chunks(F.col("text")), "doc_id"
    )


@query(
    "oversize_resplit",
    f"""WITH RECURSIVE {recursive_sql(1500, 150)}
      SELECT doc_id, lang, ordinal::BIGINT AS ordinal, substring(text, pos, chars) AS chunk
      FROM cuts JOIN documents USING (doc_id)""",
)
def oversize_resplit(spark, sf_dir):
    """Texts up to 1500 characters stay whole, which a recursive cut also gives."""
    return chunking.explode_chunks(
        _documents(spark, sf_dir), chunking.resplit_oversize(F.col("text")), "doc_id", "lang"
    )


@query(
    "word_chunks",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents),
      starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w), 100)) AS s FROM w)
      SELECT doc_id, 'text_' || doc_id::VARCHAR || '_chunk_' || ((s - 1) // 100)::VARCHAR AS chunk_id,
        (s - 1) // 100 AS ordinal, array_to_string(w[s : s + 99], ' ') AS chunk FROM starts""",
)
def word_chunks(spark, sf_dir):
    chunks = chunking.explode_chunks(
        _documents(spark, sf_dir), chunking.word_windows(F.col("text"), 100), "doc_id"
    )
    return chunks.withColumn("chunk_id", F.format_string("text_%d_chunk_%d", "doc_id", "ordinal"))


@query("para_chunks")
def para_chunks(spark, sf_dir):
    """The given texts have no blank lines, so every fourth line end is doubled first."""
    lines = F.split("text", "\n")
    spaced = F.array_join(
        F.transform(lines, lambda line, i: F.when(i % 4 == 3, F.concat(line, F.lit("\n"))).otherwise(line)), "\n"
    )
    return chunking.explode_chunks(
        _documents(spark, sf_dir), chunking.paragraph_chunks(spaced, 1000, 100), "doc_id"
    )


@query(
    "char_chunks",
    """WITH starts AS (SELECT doc_id, text,
        unnest(generate_series(1, greatest(1, length(text) - 50), 462)) AS s FROM documents)
      SELECT doc_id, (s - 1) // 462 AS ordinal, substring(text, s, 512) AS chunk FROM starts""",
)
def char_chunks(spark, sf_dir):
    return chunking.explode_chunks(_documents(spark, sf_dir), chunking.char_windows(F.col("text")), "doc_id")


@query(
    "chunk_stats",
    """SELECT lang, count(*) AS chunks, floor(avg(length(text)))::BIGINT AS mean_chars,
      min(length(text)) AS min_chars, max(length(text)) AS max_chars, sum(length(text))::BIGINT AS total_chars
      FROM documents GROUP BY ROLLUP (lang)""",
)
def chunk_stats(spark, sf_dir):
    return chunking.chunk_stats(_documents(spark, sf_dir), "lang", "text")


@query(
    "chunk_strategy_compare",
    r"""WITH fixed AS (SELECT lang, length(substring(text, s, 512)) AS n FROM (SELECT lang, text,
        unnest(generate_series(1, greatest(1, length(text) - 50), 462)) AS s FROM documents)),
      w AS (SELECT lang, regexp_extract_all(text, '\S+') AS w FROM documents),
      worded AS (SELECT lang, length(array_to_string(w[s : s + 99], ' ')) AS n FROM (SELECT lang, w,
        unnest(generate_series(1, len(w), 100)) AS s FROM w)),
      f AS (SELECT lang, count(*) AS c, floor(avg(n))::BIGINT AS m, max(n) AS x FROM fixed GROUP BY lang),
      v AS (SELECT lang, count(*) AS c, floor(avg(n))::BIGINT AS m, max(n) AS x FROM worded GROUP BY lang)
      SELECT f.lang, f.c AS fixed_chunks, f.m AS fixed_mean, f.x AS fixed_max,
        v.c AS words_chunks, v.m AS words_mean, v.x AS words_max FROM f JOIN v USING (lang)""",
)
def chunk_strategy_compare(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    fixed = chunking.explode_chunks(documents, chunking.char_windows(F.col("text")), "lang")
    worded = chunking.explode_chunks(documents, chunking.word_windows(F.col("text"), 100), "lang")
    return chunking.compare_strategies({"fixed": fixed, "words": worded}, "lang")


@query(
    "budget_select",
    r"""WITH counted AS (SELECT source, doc_id, len(regexp_extract_all(text, '\S+')) AS words FROM documents),
      running AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY doc_id) AS total FROM counted)
      SELECT source, doc_id, words, total::BIGINT AS words_so_far FROM running WHERE total <= 1500""",
)
def budget_select(spark, sf_dir):
    from caselight.operators.shares import budget_select as select_in_budget

    counted = _documents(spark, sf_dir).select(
        "source", "doc_id", F.size(words(F.col("text"))).cast("long").alias("words")
    )
    return select_in_budget(counted, "source", "doc_id", "words", 1500)
