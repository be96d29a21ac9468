"""Checked queries on sources, stores and row chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselight.functions import text as tx
from caselight.operators import chunking, hooks
from caselight.plans.chunk_queries import recursive_sql
from caselight.registry import query, table
from caselight.session import scratch_path
from caselight.sources import rows, stores
from caselight.streaming.ingest import ingest_stream

# Parts stand in for a catalogue; the columns they lack are derived from those they have.
_CATALOGUE_SQL = """
catalogue AS (
  SELECT 'P' || p_partkey::VARCHAR AS product_id, p_name AS name, p_brand AS brand, p_type AS category,
    split_part(p_name, ' ', 2) AS subcategory, CAST(p_size AS VARCHAR) AS specs,
    CAST(floor(p_retailprice) AS BIGINT) AS price_inr, p_size % 6 AS rating, p_partkey % 500 AS rating_count,
    p_size % 24 AS warranty_months, p_size % 2 = 0 AS returnable, p_size % 30 AS return_window_days,
    'S' || (p_partkey % 40)::VARCHAR AS seller_id, p_partkey % 3 = 0 AS seller_verified,
    CASE WHEN p_size > 5 THEN 'A ' || p_name || ' of brand ' || p_brand END AS description
  FROM part),
chunks AS (
  SELECT *, 'Product: ' || name || chr(10) || 'Brand: ' || brand || chr(10)
    || 'Category: ' || category || ' > ' || subcategory || chr(10) || 'Price: ₹' || price_inr::VARCHAR || chr(10)
    || 'Rating: ' || rating::VARCHAR || '/5 (' || rating_count::VARCHAR || ' reviews)' || chr(10)
    || 'Specs: ' || specs || chr(10) || 'Warranty: ' || warranty_months::VARCHAR || ' months' || chr(10)
    || 'Returnable: ' || CASE WHEN returnable THEN 'Yes' ELSE 'No' END || ' (' || return_window_days::VARCHAR
    || '-day window)' || chr(10) || 'Seller ID: ' || seller_id || ' (Verified: '
    || CASE WHEN seller_verified THEN 'Yes' ELSE 'No' END || ')' || chr(10)
    || 'Description: ' || coalesce(description, '') AS text
  FROM catalogue)"""


def catalogue(spark, sf_dir):
    part, size, key = table(spark, sf_dir, "part"), F.col("p_size"), F.col("p_partkey")
    return part.select(
        F.concat(F.lit("P"), key.cast("string")).alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("subcategory"),
        size.cast("string").alias("specs"),
        F.floor("p_retailprice").alias("price_inr"),
        (size % 6).alias("rating"),
        (key % 500).alias("rating_count"),
        (size % 24).alias("warranty_months"),
        (size % 2 == 0).alias("returnable"),
        (size % 30).alias("return_window_days"),
        F.concat(F.lit("S"), (key % 40).cast("string")).alias("seller_id"),
        (key % 3 == 0).alias("seller_verified"),
        F.when(size > 5, F.concat(F.lit("A "), F.col("p_name"), F.lit(" of brand "), F.col("p_brand"))).alias(
            "description"
        ),
    )


def catalogue_rows(spark, sf_dir):
    return rows.product_chunks(catalogue(spark, sf_dir), "products.csv")


@query(
    "row_chunks",
    f"""WITH {_CATALOGUE_SQL} SELECT product_id, text, category, 'products.csv' AS source_file,
      price_inr::DOUBLE AS price_inr FROM chunks""",
)
def row_chunks(spark, sf_dir):
    """The catalogue is written as CSV, read back with its header and turned into chunks."""
    path = scratch_path(spark, "catalogue-csv")
    full = catalogue(spark, sf_dir)
    full.write.mode("overwrite").csv(path, header=True)
    read = spark.read.schema(full.schema).csv(path, header=True)
    chunks = rows.product_chunks(read, "products.csv")
    return chunks.select(
        F.col("metadata.product_id").alias("product_id"), "text",
        F.col("metadata.category").alias("category"),
        F.col("metadata.source_file").alias("source_file"),
        F.col("metadata.price_inr").cast("double").alias("price_inr"),
    )


@query(
    "field_from_text",
    rf"""WITH {_CATALOGUE_SQL} SELECT product_id,
      coalesce(nullif(regexp_extract(text, '(?m)^Product: (.*)$', 1), ''), 'Unknown') AS product,
      coalesce(nullif(regexp_extract(text, '(?m)^Colour: (.*)$', 1), ''), 'Unknown') AS colour FROM chunks""",
)
def field_from_text(spark, sf_dir):
    return catalogue_rows(spark, sf_dir).select(
        F.col("metadata.product_id").alias("product_id"),
        rows.field_from_text(F.col("text"), "Product").alias("product"),
        rows.field_from_text(F.col("text"), "Colour").alias("colour"),
    )


@query(
    "review_chunks",
    """SELECT 'D' || l.doc_id::VARCHAR AS product_id, d.lang AS theme,
      'Product Review Summary — Product ID: D' || l.doc_id::VARCHAR || chr(10) || 'Theme: ' || d.lang
      || ' | Sentiment: ' || CASE WHEN l.toxic = 1 THEN 'negative' ELSE 'positive' END || chr(10)
      || 'Mentions: ' || d.n_chars::VARCHAR || chr(10) || 'Summary: ' || d.text || chr(10)
      || 'Representative quote: ' || d.source AS text
      FROM labels l JOIN documents d USING (doc_id)""",
)
def review_chunks(spark, sf_dir):
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    reviews = joined.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("product_id"),
        F.col("lang").alias("theme"),
        F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("sentiment"),
        F.col("n_chars").alias("mention_count"),
        F.col("text").alias("summary"),
        F.col("source").alias("quote"),
    )
    return rows.review_chunks(reviews, "review_summaries.csv").select(
        F.col("metadata.product_id").alias("product_id"), F.col("metadata.theme").alias("theme"), "text"
    )


@query(
    "kv_row_document",
    """SELECT s_suppkey, 'supplier.csv' AS source,
      's_suppkey: ' || s_suppkey::VARCHAR || chr(10) || 's_name: ' || s_name || chr(10)
      || 's_nationkey: ' || s_nationkey::VARCHAR AS text FROM supplier""",
)
def kv_row_document(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.lit("supplier.csv").alias("source"),
        rows.key_value_text(["s_suppkey", "s_name", "s_nationkey"]).alias("text"),
    )


_PAGE_TEXT = r"""hidden AS (SELECT page_id, url, regexp_replace(html,
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g') AS h FROM pages),
  bare AS (SELECT page_id, url, regexp_replace(h, '<[/a-zA-Z!?][^>]*>', chr(10), 'g') AS t FROM hidden),
  plain AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(replace(replace(t,
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
    '&middot;', '·'), '&copy;', '©'), '&amp;', '&') AS t FROM bare),
  page_text AS (SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(t, chr(10)),
    lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 0), chr(10)) AS text FROM plain)"""


@query("html_to_text", f"WITH {_PAGE_TEXT} SELECT page_id, text FROM page_text")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.html_to_text(F.col("html")).alias("text"))


_REFERENCES = "<p>caf&eacute; &#8217;x&#x2019; &mdash; &#150; &notin; &bogus; a&ampb &lt;b&gt; &amp;amp; &#0;</p>"


@query(
    "html_entities",
    f"""WITH {_PAGE_TEXT} SELECT page_id, CASE WHEN text = '' THEN '' ELSE text || chr(10) END
      || 'café ’x’ — – ∉ &bogus; a&ampb <b> &amp; \ufffd' AS text FROM page_text""",
)
def html_entities(spark, sf_dir):
    """Pages with a paragraph of named and numbered references put after them."""
    html = F.concat("html", F.lit(_REFERENCES))
    return table(spark, sf_dir, "pages").select("page_id", tx.html_to_text(html).alias("text"))


@query(
    "boilerplate_filter",
    r"""WITH hidden AS (SELECT page_id, regexp_replace(html,
        '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g') AS h FROM pages),
      cut AS (SELECT page_id, regexp_replace(regexp_replace(h,
        '(?i)</?(p|h1|h2|h3|h4|h5|h6|li|span|div)\b[^>]*>', chr(1), 'g'), '<[/a-zA-Z!?][^>]*>', '', 'g') AS t
        FROM hidden),
      plain AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(t,
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
        '&middot;', '·'), '&copy;', '©'), '&amp;', '&') AS t FROM cut),
      pieces AS (SELECT page_id, unnest(list_filter(list_transform(string_split(t, chr(1)),
        lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 0)) AS snippet FROM plain)
      SELECT page_id, snippet FROM pieces WHERE length(snippet) > 20 AND NOT contains(lower(snippet), 'sign up')
        AND NOT contains(lower(snippet), 'sign in') AND NOT contains(lower(snippet), 'cookie')
        AND NOT contains(lower(snippet), 'privacy policy')""",
)
def boilerplate_filter(spark, sf_dir):
    pieces = table(spark, sf_dir, "pages").select(
        "page_id", F.explode(tx.html_snippets(F.col("html"))).alias("snippet")
    )
    return pieces.filter(tx.not_boilerplate(F.col("snippet")))


_ARTICLE_TEXT = r"""regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
    replace(replace(regexp_replace({x}, '<[/a-zA-Z!?][^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'),
    '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&middot;', '·'), '&copy;', '©'),
    '&amp;', '&'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"""


@query(
    "html_article",
    r"""WITH hidden AS (SELECT page_id, regexp_replace(html,
        '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g') AS h FROM pages),
      pieces AS (SELECT page_id, unnest(regexp_extract_all(h, '(?is)<article\b[^>]*>.*?</article\s*>')) AS piece
        FROM hidden)
      SELECT page_id, 'faq-unknown' AS question_number, 'General' AS section, """
    + _ARTICLE_TEXT.format(x="piece")
    + " AS text FROM pieces",
)
def html_article(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.explode(rows.faq_articles(F.col("html"))).alias("a")
    ).select("page_id", "a.*")


@query(
    "faq_articles",
    """SELECT p_partkey, 'q' || p_partkey::VARCHAR AS question_number, 'Sizes & ' || p_type AS section,
        'What size is the ' || p_name || '? It is ' || p_size::VARCHAR || '.' AS text FROM part
      UNION ALL SELECT p_partkey, 'faq-unknown', 'General', 'About ' || p_name FROM part
      UNION ALL SELECT p_partkey, 'faq-unknown', 'Sizes & ' || p_type, 'Made by ' || p_brand FROM part""",
)
def faq_articles(spark, sf_dir):
    """One question page per part: an article before any heading, a heading, two articles after it."""
    page = F.format_string(
        "<body><article><p>About %s</p></article><h2>Sizes &amp; %s</h2>"
        "<article id=\"q%s\"><h3>What size is the %s?</h3>\n<p>It   is %s.</p></article>"
        "<article class='x'>Made <b>by</b> %s</article></body>",
        F.col("p_name"), F.col("p_type"), F.col("p_partkey").cast("string"), F.col("p_name"),
        F.col("p_size").cast("string"), F.col("p_brand"),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.explode(rows.faq_articles(page)).alias("a")
    ).select("p_partkey", "a.*")


@query(
    "ingest_category",
    r"""WITH paths AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages)
      SELECT page_id, path, coalesce(nullif(regexp_extract(path, '^([^/]+)/', 1), ''), 'general') AS category
      FROM paths""",
)
def ingest_category(spark, sf_dir):
    path = F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path")).withColumn(
        "category", rows.category_of(F.col("path"))
    )


@query("load_text_folder", "SELECT 'item_id=' || item_id::VARCHAR AS source, text || chr(10) AS text FROM benchmark")
def load_text_folder(spark, sf_dir):
    """Benchmark texts are written as one file each and read back whole, by name."""
    path = scratch_path(spark, "texts")
    table(spark, sf_dir, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    return rows.load_text_folder(spark, path, "*.txt", by_parent=True)


@query(
    "ingest_folder",
    """SELECT lang AS category, 'txt' AS kind, '' AS reason, sum(n_chars)::BIGINT AS chars, count(*) AS documents
      FROM documents GROUP BY lang
      UNION ALL SELECT 'labels', 'json', 'unsupported kind', 0, 0""",
)
def ingest_folder(spark, sf_dir):
    """Documents as a tree of text files by language, next to files of a kind that is rejected."""
    path = scratch_path(spark, "tree")
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    written = table(spark, sf_dir, "documents").select("lang", flat.alias("value")).write.partitionBy("lang")
    written.option("maxRecordsPerFile", 500).text(path)  # a file is one row when it is read back
    table(spark, sf_dir, "labels").write.json(f"{path}/labels")
    read, rejects = rows.ingest_folder(spark, path)
    lines = read.select("category", F.explode(F.split("text", "\n")).alias("line")).filter(F.length("line") > 0)
    taken = lines.groupBy(F.replace("category", F.lit("lang="), F.lit("")).alias("category")).agg(
        F.lit("txt").alias("kind"), F.lit("").alias("reason"),
        F.sum(F.length("line").cast("long")).alias("chars"), F.count("*").alias("documents"),
    )
    none = F.lit(0).cast("long")
    refused = rejects.select(rows.category_of(F.col("source")).alias("category"), "kind", "reason").distinct()
    return taken.unionByName(refused.select("*", none.alias("chars"), none.alias("documents")))


@query("read_jsonl", "SELECT doc_id, quality, toxic FROM labels")
def read_jsonl(spark, sf_dir):
    path = scratch_path(spark, "labels-jsonl")
    lines = table(spark, sf_dir, "labels").select(
        F.concat(F.to_json(F.struct("doc_id", "quality", "toxic")), F.lit("\n")).alias("value")
    )
    lines.write.text(path)  # every record is followed by a blank line
    return stores.read_jsonl(spark, path, "doc_id long, quality int, toxic int")


@query(
    "chunk_round_trip",
    "SELECT doc_id::VARCHAR AS doc_id, source AS source_file, lang AS category, text FROM documents",
)
def chunk_round_trip(spark, sf_dir):
    path = scratch_path(spark, "chunks-json")
    chunks = table(spark, sf_dir, "documents").select(
        "text",
        rows.metadata(doc_id=F.col("doc_id"), source_file=F.col("source"), category=F.col("lang")).alias(
            "metadata"
        ),
    )
    stores.write_json_chunks(chunks, path)
    back = stores.read_json_chunks(spark, path)
    return back.select(*[F.col(f"metadata.{c}").alias(c) for c in ("doc_id", "source_file", "category")], "text")


@query(
    "vector_store_round_trip",
    """SELECT label, count(*) AS vectors, round(sum(embedding[1]::DOUBLE), 6) AS first_sum
      FROM embeddings GROUP BY label""",
)
def vector_store_round_trip(spark, sf_dir):
    """Built once, written again on a rebuild, read as it is on a later call."""
    path = scratch_path(spark, "vectors")
    vectors = table(spark, sf_dir, "embeddings")
    older = vectors.withColumn("label", F.lit(0))
    stores.persisted(spark, path, lambda: older, by="label")
    stores.persisted(spark, path, lambda: vectors, rebuild=True, by="label")
    kept = stores.persisted(spark, path, lambda: older, by="label")
    return kept.groupBy("label").agg(
        F.count("*").alias("vectors"),
        F.round(F.sum(F.get("embedding", F.lit(0)).cast("double")), 6).alias("first_sum"),
    )


@query(
    "idempotent_chunk_append",
    """WITH lines AS (SELECT source, doc_id AS ordinal, unnest(string_split(text, chr(10))) AS text FROM documents)
      SELECT DISTINCT source, ordinal, text FROM lines WHERE length(text) > 0""",
)
def idempotent_chunk_append(spark, sf_dir):
    """The first run brings the lines of one half of the languages, the second run all of them."""
    lines = (
        table(spark, sf_dir, "documents")
        .select("source", F.col("doc_id").alias("ordinal"), "lang", F.explode(F.split("text", "\n")).alias("text"))
        .filter(F.length("text") > 0)
    )
    empty = lines.select("source", "ordinal", "text").limit(0)
    first = stores.append_chunks(empty, lines.filter(F.col("lang").isin("fr", "de")).drop("lang"))
    return stores.append_chunks(first.drop("chunk_key"), lines.drop("lang")).select("source", "ordinal", "text")


@query(
    "ingest_stats",
    """WITH chunks AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS chunk FROM documents)
      SELECT count(DISTINCT doc_id) AS documents, count(*) AS chunks FROM chunks""",
)
def ingest_stats(spark, sf_dir):
    chunks = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("chunk"))
    return stores.ingest_stats(chunks, "doc_id")


@query(
    "union_chunks",
    f"""WITH {_CATALOGUE_SQL},
      every AS (
        SELECT text, 'csv' AS file_type, product_id, NULL AS question_number, NULL AS category_folder FROM chunks
        UNION ALL SELECT text, 'text', NULL, NULL, lang FROM documents
        UNION ALL SELECT html, 'html', NULL, 'page-' || page_id::VARCHAR, NULL FROM pages)
      SELECT file_type, count(*) AS chunks, count(product_id) AS with_product,
        count(question_number) AS with_question, count(category_folder) AS with_folder,
        sum(length(text))::BIGINT AS chars FROM every GROUP BY file_type""",
)
def union_chunks(spark, sf_dir):
    """Chunk sets of three loaders with unlike metadata in one table."""
    parts = catalogue_rows(spark, sf_dir).select(
        "text", F.lit("csv").alias("file_type"), F.col("metadata.product_id").alias("product_id")
    )
    texts = table(spark, sf_dir, "documents").select(
        "text", F.lit("text").alias("file_type"), F.col("lang").alias("category_folder")
    )
    web = table(spark, sf_dir, "pages").select(
        F.col("html").alias("text"), F.lit("html").alias("file_type"),
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("question_number"),
    )
    every = parts.unionByName(texts, allowMissingColumns=True).unionByName(web, allowMissingColumns=True)
    return every.groupBy("file_type").agg(
        F.count("*").alias("chunks"),
        F.count("product_id").alias("with_product"),
        F.count("question_number").alias("with_question"),
        F.count("category_folder").alias("with_folder"),
        F.sum(F.length("text").cast("long")).alias("chars"),
    )


@query(
    "ingest_job",
    rf"""WITH RECURSIVE {_PAGE_TEXT},
      paths AS (SELECT *, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM page_text),
      inputs AS (
        SELECT 'doc-' || doc_id::VARCHAR AS source, lang AS category, text FROM documents
        UNION ALL SELECT 'page-' || page_id::VARCHAR,
          coalesce(nullif(regexp_extract(path, '^([^/]+)/', 1), ''), 'general'), text FROM paths),
      {recursive_sql(900, 120, "inputs", "source")}
      SELECT category, count(DISTINCT source) AS documents, count(*) AS chunks, count(*) AS vectors
      FROM cuts JOIN inputs USING (source) GROUP BY category""",
)
def ingest_job(spark, sf_dir):
    """Documents and web pages chunked, keyed, embedded and stored by category; run twice, counted per category.

    The first run brings the documents, the second one documents and pages: what is stored already is not stored again.
    """
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("source"), F.col("lang").alias("category"), "text"
    )
    web = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("source"),
        rows.category_of(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)).alias("category"),
        tx.html_to_text(F.col("html")).alias("text"),
    )
    path = scratch_path(spark, "chunk-store")

    def ingest(inputs):
        chunks = chunking.explode_chunks(inputs, chunking.recursive_chunks(F.col("text")), "source", "category")
        keyed = chunks.withColumn("chunk_key", stores.content_key(F.col("source"), F.col("ordinal"), F.col("chunk")))
        stores.add_new(spark, path, keyed, "chunk_key", lambda fresh: hooks.embed(fresh, "chunk"), by="category")

    ingest(documents)
    ingest(documents.unionByName(web))
    return spark.read.parquet(path).groupBy("category").agg(
        F.count_distinct("source").alias("documents"), F.count("*").alias("chunks"), F.count("embedding").alias("vectors")
    )


@query(
    "stream_ingest",
    """SELECT lang AS category, count(*) AS documents, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang""",
)
def stream_ingest(spark, sf_dir):
    """Documents arrive as a file stream and are chunked without overlap into a store."""
    store = ingest_stream(spark, f"{sf_dir}/documents.parquet", scratch_path(spark, "stream-ingest"))
    return store.groupBy("category").agg(
        F.count_distinct("doc_id").alias("documents"), F.sum(F.length("chunk").cast("long")).alias("chars")
    )


@query(
    "ingest_runs",
    """SELECT 1 AS run, 'succeeded' AS status, count(*) AS rows_in, sum(n_chars)::BIGINT AS chars,
              NULL::VARCHAR AS error FROM documents
       UNION ALL SELECT 2, 'rejected', 0, 0, 'another run holds the lease'
       UNION ALL SELECT 3, 'failed', 0, 0, 'AnalysisException'""",
)
def ingest_runs(spark, sf_dir):
    """Three ingest runs and their status: one over all documents, one while another holds the lease, one that fails."""
    from caselight.streaming import runs

    folder = scratch_path(spark, "ingest-runs")
    table_of_runs, lease = f"{folder}/runs", runs.Lease(spark, f"{folder}/lease")
    order = [runs.ingest_run(spark, f"{sf_dir}/documents.parquet", f"{folder}/store", table_of_runs, lease)]
    lease.take("another run")  # held by someone else: the next run must be turned away
    order.append(runs.ingest_run(spark, f"{sf_dir}/documents.parquet", f"{folder}/store", table_of_runs, lease))
    lease.give_back()
    try:
        runs.ingest_run(spark, f"{sf_dir}/no-such-table.parquet", f"{folder}/broken", table_of_runs, lease)
    except Exception:  # noqa: BLE001 - the failure is in the runs table
        pass
    numbered = spark.createDataFrame([(i + 1, r) for i, r in enumerate(order)], "run int, run_id string")
    status = runs.run_status(spark, table_of_runs)
    known = status.join(numbered, "run_id", "left").withColumn("run", F.coalesce("run", F.lit(3)))
    return known.select("run", "status", "rows_in", "chars", "error")
