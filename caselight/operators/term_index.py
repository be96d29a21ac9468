"""TF-IDF as long tables: an inverted-index join in place of a matrix.

A chunk table has the key columns ``source`` and ``ordinal``; a query table has ``query_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselight.functions.text import TOKEN_CHARS, word_runs
from caselight.operators import term_scan
from caselight.operators.ranking import keep_first, rank_key
from caselight.session import cut_lineage

CHUNK_KEY = ["source", "ordinal"]


def default_stop_words() -> list[str]:
    """Spark's own English list; pass another list where it should differ."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def _token_rows(rows: DataFrame, key: list[str], text: str, stop_words: list[str] | None) -> DataFrame:
    runs = rows.select(*key, F.explode(word_runs(F.col(text))).alias("term"))
    kept = runs.filter(F.length("term") >= TOKEN_CHARS)
    return kept.filter(~F.col("term").isin(stop_words)) if stop_words else kept


def term_frequency(
    rows: DataFrame, key: list[str], text: str = "text", stop_words: list[str] | None = None
) -> DataFrame:
    """(key, term, tf). Texts, which are smaller than their tokens, are exchanged by key; the counting needs no exchange."""
    return (
        _token_rows(rows.select(*key, text).repartition(*key), key, text, stop_words)
        .groupBy(*key, "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(postings: DataFrame) -> DataFrame:
    # Every posting counts 1; naming ``tf`` keeps the input equal to that of the weights, so that
    # Spark works out and exchanges the postings once for both.
    return postings.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def smoothed_idf(postings: DataFrame, n_chunks: Column) -> DataFrame:
    """(term, df, idf) with ``ln((1 + n) / (1 + df)) + 1``."""
    idf = F.ln((1 + n_chunks) / (1 + F.col("df"))) + 1
    return document_frequency(postings).withColumn("idf", idf)


# A term of more than this share of the chunks is hot: its postings are spread over salts when they are scored.
HOT_SHARE = 0.001
HOT_SALTS = 16


@dataclass(frozen=True)
class TermIndex:
    """``vectors``: one row per chunk with its L2-normalised terms; ``idf``: (term, df, idf, hot);
    ``peaks``: (term, peak), the largest weight of each term."""

    vectors: DataFrame
    idf: DataFrame
    peaks: DataFrame

    def weights(self) -> DataFrame:
        """(source, ordinal, term, weight, hot)."""
        return self.vectors.select(*CHUNK_KEY, F.explode("terms").alias("t")).select(*CHUNK_KEY, "t.*")


def _unit_terms(weighted: DataFrame, key: list[str]) -> DataFrame:
    """Gather the terms of a row and divide by its norm; one row's own terms only."""
    gathered = weighted.groupBy(*key).agg(
        F.collect_list(F.struct("term", "weight", "hot")).alias("raw"),
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
    )
    unit = F.transform("raw", lambda t: t.withField("weight", t["weight"] / F.col("norm")))
    return gathered.select(*key, unit.alias("terms"))


def _idf_of(postings: DataFrame, chunks: DataFrame) -> DataFrame:
    n_chunks = chunks.agg(F.count("*").alias("n")).scalar()
    return smoothed_idf(postings, n_chunks).withColumn("hot", F.col("df") > HOT_SHARE * n_chunks)


def _vectors_of(postings: DataFrame, idf: DataFrame) -> DataFrame:
    """Postings meet their idf by term; whether one side is sent or a hot term split is left to adaptive execution."""
    weighted = postings.join(idf.select("term", "idf", "hot"), "term").withColumn("weight", F.col("tf") * F.col("idf"))
    return _unit_terms(weighted, CHUNK_KEY)


def _peaks_of(vectors: DataFrame) -> DataFrame:
    weights = vectors.select(F.explode("terms").alias("t")).select("t.term", "t.weight")
    return weights.groupBy("term").agg(F.max("weight").alias("peak"))


def build_term_index(
    chunks: DataFrame, text: str = "text", stop_words: list[str] | None = None
) -> TermIndex:
    """The index as one lazy plan, for small chunk sets; ``save_term_index`` reads the texts once."""
    postings = term_frequency(chunks, CHUNK_KEY, text, stop_words)
    idf = _idf_of(postings, chunks)
    vectors = _vectors_of(postings, idf)
    return TermIndex(vectors, idf, _peaks_of(vectors))


def save_term_index(
    chunks: DataFrame, path: str, text: str = "text", stop_words: list[str] | None = None
) -> TermIndex:
    """Write postings, then idf, then vectors below ``path``, each from what was written before it.

    A chunk stays one row from its text to its weights. Frequent terms meet their idf in the tasks; only the
    postings of rare terms are exchanged.
    """
    spark = chunks.sparkSession
    term_scan.term_counts(_merged(chunks, text), _kept_tokens(F.col(text), stop_words)).write.mode("overwrite").parquet(f"{path}/postings")
    counted = spark.read.parquet(f"{path}/postings")
    flat = counted.select(*CHUNK_KEY, F.explode("terms").alias("t")).select(*CHUNK_KEY, "t.*")
    _idf_of(flat, chunks).write.mode("overwrite").parquet(f"{path}/idf")
    idf = spark.read.parquet(f"{path}/idf")
    least = _least_sent_df(idf)
    sent = idf.filter(F.col("df") >= least).select("term", "idf", "hot").toArrow()
    if sent.num_rows < idf.count():
        counted = _with_rare(counted, flat, idf, least)
    term_scan.unit_terms(counted, sent).write.mode("overwrite").parquet(f"{path}/vectors")
    return load_term_index(spark, path)


def _merged(chunks: DataFrame, text: str) -> DataFrame:
    """One row per chunk key. Texts of repeated keys are put together, a line end between them, which is no part of a word."""
    rows = chunks.select(*CHUNK_KEY, text)
    if rows.groupBy(*CHUNK_KEY).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return rows
    return rows.groupBy(*CHUNK_KEY).agg(F.array_join(F.collect_list(text), "\n").alias(text))


def _kept_tokens(text: Column, stop_words: list[str] | None) -> Column:
    def kept(word: Column) -> Column:
        long_enough = F.length(word) >= TOKEN_CHARS
        return long_enough & ~word.isin(stop_words) if stop_words else long_enough

    return F.filter(word_runs(text), kept)


MOST_SENT_TERMS = 200_000  # the most frequent terms, whose idf is sent to the tasks; they make up most postings


def _least_sent_df(idf: DataFrame) -> int:
    """The least power of two that no more than MOST_SENT_TERMS terms reach by their df."""
    sizes = {r.b: r.n for r in idf.groupBy(F.floor(F.log2("df")).alias("b")).agg(F.count("*").alias("n")).collect()}
    total, least = 0, 2 ** (max(sizes, default=0) + 1)
    for b in sorted(sizes, reverse=True):
        total += sizes[b]
        if total > MOST_SENT_TERMS:
            break
        least = 2**b
    return least


def _with_rare(counted: DataFrame, flat: DataFrame, idf: DataFrame, least: int) -> DataFrame:
    """Adds ``rare``: (term, idf, hot) of a chunk's terms below ``least``; only their postings are exchanged by term."""
    frequent = F.broadcast(idf.filter(F.col("df") >= least).select("term"))
    rare = flat.join(frequent, "term", "left_anti").hint("merge").join(
        idf.filter(F.col("df") < least).select("term", "idf", "hot"), "term"
    )
    found = rare.groupBy(*CHUNK_KEY).agg(F.collect_list(F.struct("term", "idf", "hot")).alias("rare"))
    named = found.select(*[F.col(c).alias(f"_{c}") for c in CHUNK_KEY], "rare")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CHUNK_KEY]
    return counted.hint("merge").join(named, same, "left").select(*CHUNK_KEY, "terms", "rare")


def load_term_index(spark: SparkSession, path: str) -> TermIndex:
    vectors, idf = [spark.read.parquet(f"{path}/{part}") for part in ("vectors", "idf")]
    return TermIndex(vectors, idf, _peaks_of(vectors))


def query_vectors(
    queries: DataFrame, index: TermIndex, text: str = "text", stop_words: list[str] | None = None
) -> DataFrame:
    """(query_id, terms): normalised weights over known words; a query without one has no row.

    Texts stay where they are: only words go on, unknown ones are dropped at the join with the vocabulary, and one exchange
    by query serves the counting and the gathering.
    """
    words = _token_rows(queries.select("query_id", text), ["query_id"], text, stop_words)
    known = words.join(index.idf.select("term", "idf", "hot"), "term")
    weighted = (
        known.repartition("query_id")
        .groupBy("query_id", "term", "idf", "hot")
        .agg(F.count("*").alias("tf"))
        .withColumn("weight", F.col("tf") * F.col("idf"))
    )
    return _unit_terms(weighted, ["query_id"])


def signatures(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries that hold the same known words get one signature, so each is scored once.

    Returns (query_id, signature) and the distinct (signature, terms).
    """
    sorted_terms = F.array_sort("terms")
    text_form = F.array_join(
        F.transform(
            sorted_terms, lambda t: F.concat_ws(":", t["term"], F.round(t["weight"], 12).cast("string"))
        ),
        " ",
    )
    signed = vectors.select("query_id", text_form.alias("signature"), "terms")
    distinct = signed.groupBy("signature").agg(F.any_value("terms").alias("terms"))
    return signed.select("query_id", "signature"), distinct


def score_pairs(query_terms: DataFrame, key: str, index: TermIndex) -> DataFrame:
    """(key, source, ordinal, score) for pairs that share a term; zero scores never arise.

    Postings of hot terms are spread over salts by chunk, and only query terms that are hot are
    copied to every salt. Where the query side is measured to be small, adaptive execution broadcasts
    it; all postings of a chunk then leave ``explode`` in one task, so that the partial sum already
    yields one row per pair.
    """
    chunk_salt = F.pmod(F.xxhash64(*CHUNK_KEY), F.lit(HOT_SALTS)).cast("int")
    postings = index.weights().withColumn("_salt", F.when(F.col("hot"), chunk_salt).otherwise(F.lit(0)))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    asked = query_terms.select(key, F.explode("terms").alias("t")).select(
        key, "t.term", F.col("t.weight").alias("w_query"), F.col("t.hot").alias("hot")
    )
    copied = asked.withColumn("_salt", F.explode(salts)).drop("hot")
    return (
        postings.drop("hot")
        .join(copied, ["term", "_salt"])
        .groupBy(key, *CHUNK_KEY)
        .agg(F.sum(F.col("weight") * F.col("w_query")).alias("score"))
    )


def top_k(scored: DataFrame, key: str, k: int, *tie: str) -> DataFrame:
    """First k rows per key by score, ties by ``tie``."""
    return keep_first(scored, [key], [rank_key(F.col("score")).desc(), *[F.col(c) for c in tie]], k)


def _asked_terms(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(key, F.explode("terms").alias("t")).select(key, "t.term", F.col("t.weight").alias("w"), "t.hot")


def _sendable(asked: DataFrame):
    """The rows as an Arrow table when there are few enough to be sent to the tasks, else None."""
    rows = asked.limit(term_scan.MOST_ASKED + 1).toArrow()
    return rows if rows.num_rows <= term_scan.MOST_ASKED else None


def _first_chunks(query_terms: DataFrame, key: str, index: TermIndex, chunks: Column, k: int) -> DataFrame:
    """(key, source, ordinal, score, rank): the first k of the chunks for which ``chunks`` is true.

    A bounded set of questions is scored where the index is read; for a larger one, postings and questions meet by term.
    """
    sent = _sendable(_asked_terms(query_terms, key))
    if sent is None:
        return top_k(score_pairs(query_terms, key, index).filter(chunks), key, k, *CHUNK_KEY)
    kind = query_terms.schema[key].dataType.simpleString()
    return top_k(term_scan.scan(index.vectors.filter(chunks), sent, key, kind, k), key, k, *CHUNK_KEY)


def _all_but(source: str | None) -> Column:
    return F.lit(True) if source is None else F.col("source") != source


def search(
    queries: DataFrame,
    index: TermIndex,
    k: int = 3,
    exclude_source: str | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """(query_id, source, ordinal, score, rank): positive scores only, one source left out on request."""
    return _first_chunks(query_vectors(queries, index, "text", stop_words), "query_id", index, _all_but(exclude_source), k)


SCORE_SLACK = 4e-9  # scores are ranked in steps of 1e-9; bounds are taken a little looser


def _judged(asked: DataFrame, index: TermIndex, k: int, exclude_source: str | None) -> DataFrame:
    """``asked`` with ``late`` (its word cannot bring a chunk in), and per question ``floor`` and ``rest``."""
    words = asked.select("term").distinct()
    few = asked.count() <= term_scan.MOST_ASKED
    peaks = index.peaks.join(F.broadcast(words) if few else words, "term", "left_semi")
    bounded = cut_lineage(asked.join(peaks, "term").withColumn("bound", F.col("w") * F.col("peak")))
    as_terms = bounded.filter(~F.col("hot")).groupBy("query_id").agg(
        F.collect_list(F.struct("term", F.col("w").alias("weight"), "hot")).alias("terms")
    )
    rare = _first_chunks(as_terms, "query_id", index, _all_but(exclude_source), k)
    floors = (
        rare.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
        .filter(F.col("n") == k).select("query_id", (F.col("floor") - SCORE_SLACK).alias("floor"))
    )
    so_far = Window.partitionBy("query_id").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    marked = (
        bounded.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
        .withColumn("late", F.sum("bound").over(so_far) < F.col("floor"))
    )
    spare = F.sum(F.when(F.col("late"), F.col("bound"))).over(Window.partitionBy("query_id"))
    return cut_lineage(
        marked.withColumn("rest", F.coalesce(spare, F.lit(0.0))).select("query_id", "term", "w", "hot", "late", "floor", "rest")
    )


def _pruned_scores(asked: DataFrame, index: TermIndex, k: int, exclude_source: str | None, first: int | None) -> DataFrame:
    """(query_id, source, ordinal, score) of the chunks that pruning leaves, per task the ``first`` ones or all; whole scores."""
    judged = _judged(asked, index, k, exclude_source)
    allowed = _all_but(exclude_source)
    sent = _sendable(judged)
    if sent is not None:
        kind = judged.schema["query_id"].dataType.simpleString()
        return term_scan.scan(index.vectors.filter(allowed), sent, "query_id", kind, first)
    met = index.weights().filter(allowed).drop("hot").join(judged.drop("hot"), "term")
    product = F.col("weight") * F.col("w")
    summed = met.groupBy("query_id", *CHUNK_KEY).agg(
        F.sum(product).alias("score"), F.coalesce(F.sum(F.when(~F.col("late"), product)), F.lit(0.0)).alias("early"),
        F.first("floor").alias("floor"), F.first("rest").alias("rest"),
    )
    reached = (F.col("early") > 0) & (F.col("early") + F.col("rest") >= F.col("floor"))
    return summed.filter(reached).select("query_id", *CHUNK_KEY, "score")


def pruned_candidates(asked: DataFrame, index: TermIndex, k: int, exclude_source: str | None = None) -> DataFrame:
    """(query_id, source, ordinal) of every chunk that can be among the first k, from ``asked`` (query_id, term, w, hot).

    The rare words of a question are scored first; its k-th partial score is a floor, as the others only add. Words whose
    largest possible contributions together stay under the floor cannot bring a chunk in on their own, so only
    the other words are looked up, and a chunk whose partial score cannot reach the floor with all the rest is dropped.
    """
    return _pruned_scores(asked, index, k, exclude_source, None).drop("score")


def search_pruned(
    queries: DataFrame,
    index: TermIndex,
    k: int = 3,
    exclude_source: str | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """The rows of ``search``, exactly, without scoring each chunk that shares only common words with a question.

    Where the questions are sent to the tasks, a task's own k-th partial score raises the floor as it reads on.
    """
    asked = cut_lineage(_asked_terms(query_vectors(queries, index, "text", stop_words), "query_id"))
    return top_k(_pruned_scores(asked, index, k, exclude_source, k), "query_id", k, *CHUNK_KEY)


def search_by_signature(
    queries: DataFrame,
    index: TermIndex,
    k: int = 3,
    exclude_source: str | None = None,
    stop_words: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """As ``search`` for query sets with many repeats: (query_id, signature) and hits per signature."""
    named, distinct = signatures(query_vectors(queries, index, "text", stop_words))
    return named, _first_chunks(distinct, "signature", index, _all_but(exclude_source), k)


MOST_KNOWN = 200_000  # terms of an index that are sent to the tasks for finding known words


def with_signature(
    rows: DataFrame, key: str, text: Column, index: TermIndex, stop_words: list[str] | None = None
) -> DataFrame:
    """Adds ``signature``: the known words of ``text`` in order, with repeats; null where there is none or the key is null.

    With at most MOST_KNOWN terms a row finds its words by itself, and only rows whose key comes again, which share
    the words of all of them, are exchanged. With more terms the words of all rows meet the index in a join.
    """
    terms = index.idf.select("term").limit(MOST_KNOWN + 1).toArrow()
    if terms.num_rows > MOST_KNOWN:
        return rows.join(_by_key(rows.select(key, text.alias("_text")), key, index, stop_words), key, "left")
    taken = [t for t in terms["term"].to_pylist() if len(t) >= TOKEN_CHARS and t not in (stop_words or ())]
    found = term_scan.known_words(word_runs(text), taken, rows.sparkSession)
    own = F.array_join(F.array_sort(found), " ")
    signed = rows.withColumn("signature", F.when(F.col(key).isNotNull(), F.nullif(own, F.lit(""))))
    codes = rows.select(F.xxhash64(key).alias("_code")).groupBy("_code").agg(F.count("*").alias("n"))
    repeated = codes.filter("n > 1").select("_code")
    if repeated.isEmpty():
        return signed
    again = rows.select(key, text.alias("_text"), F.xxhash64(key).alias("_code")).join(repeated, "_code", "left_semi")
    shared = _by_key(again, key, index, stop_words).withColumnRenamed("signature", "_shared")
    return signed.join(shared, key, "left").withColumn("signature", F.coalesce("_shared", "signature")).drop("_shared")


def _by_key(rows: DataFrame, key: str, index: TermIndex, stop_words: list[str] | None) -> DataFrame:
    """(key, signature) of rows (key, _text), by an exchange of their words."""
    words = _token_rows(rows.filter(F.col(key).isNotNull()), [key], "_text", stop_words)
    known = words.join(index.idf.select("term"), "term", "left_semi")
    return known.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("term")), " ").alias("signature"))


def search_signatures(
    asked: DataFrame,
    index: TermIndex,
    k: int = 3,
    exclude_source: str | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """(signature, source, ordinal, score, rank): every distinct ``signature`` of ``asked`` is searched once."""
    # No filter on null: it would be pushed below and the words looked up twice. A null question has no words.
    distinct = asked.select("signature").distinct()
    questions = distinct.select(F.col("signature").alias("query_id"), F.col("signature").alias("text"))
    return search(questions, index, k, exclude_source, stop_words).withColumnRenamed("query_id", "signature")


def search_scoped(
    queries: DataFrame,
    chunks: DataFrame,
    index: TermIndex,
    source: str,
    k: int = 2,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Top k inside one source, zero scores kept.

    The positive hits come from the term join. Zero-score rows can only fill places that are
    still free, in key order, so each query needs no more than the first k chunks of the scope
    next to its hits; the two are merged instead of pairing every query with every chunk.
    """
    scope = chunks.filter(F.col("source") == source).select(*CHUNK_KEY)
    asked = query_vectors(queries, index, "text", stop_words)
    best = _first_chunks(asked, "query_id", index, F.col("source") == source, k).drop("rank")
    # With fewer than k hits, the first 2k chunks of the scope hold more than k without a score.
    first = cut_lineage(scope.orderBy(*CHUNK_KEY).limit(2 * k))
    near = index.vectors.join(F.broadcast(first.distinct()), CHUNK_KEY, "left_semi")  # at most 2k rows
    scored = _first_chunks(asked, "query_id", TermIndex(near, index.idf, index.peaks), F.lit(True), 2 * k)
    fillers = (
        queries.select("query_id", F.lit(source).alias("source"))
        .join(F.broadcast(first), "source")
        .join(scored.select("query_id", *CHUNK_KEY), ["query_id", *CHUNK_KEY], "left_anti")
        .withColumn("score", F.lit(0.0))
    )
    return top_k(best.unionByName(fillers), "query_id", k, *CHUNK_KEY)


def vocabulary_stats(chunks: DataFrame, text: str = "text") -> DataFrame:
    """Exact and approximate vocabulary size, next to the number of chunks."""
    terms = _token_rows(chunks, CHUNK_KEY, text, None)
    sizes = terms.agg(
        F.approx_count_distinct("term", 0.01).alias("vocabulary_approx"),
        F.count("*").alias("tokens"),
    )
    vocabulary = terms.select("term").distinct().agg(F.count("*").alias("n")).scalar()
    total = chunks.agg(F.count("*").alias("n")).scalar()
    return sizes.select(
        vocabulary.alias("vocabulary"), total.alias("chunks"), "tokens", "vocabulary_approx"
    )
