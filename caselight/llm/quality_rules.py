"""Quality rules: base counts of every document, then a hashed n-gram log-likelihood ratio against the raw corpus.

Base. Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text (null: none). ``word_chars`` sums their code points,
``n_symbols`` counts the characters ``#*$%&|<>`` of the text, ``n_dup_lines`` the ``\\n``-split lines that hold a word
and equal an earlier line, ``n_repeat_words`` the words covered by a 3-word window whose words occur as a window twice or
more in the text (the first occurrence too). ``base_failed``: fewer than ``LEAST_WORDS`` words, or over half of the
words repeated.

Method. Features of a document are its lower-cased words and pairs of neighbouring words, hashed into ``BUCKETS``
cells. Two multinomials are counted over cells: the trusted target (every document whose ``labels.quality`` is 1) and
the raw corpus (every document). A document's score is the log-likelihood ratio of its features under the two,
divided by its number of features, with its own counts left out of both (so a labelled document is not favoured by
itself) and add-``SMOOTHING`` on every cell. The threshold is deterministic: the score below which
``1 - KEEP_TRUSTED`` of the trusted documents that pass the base rules fall, read from a histogram of their scores
(``HISTOGRAM_BINS`` bins of width ``BIN``), so it follows all labelled rows and needs no sort of them. ``kept``: not
``base_failed`` and score at least the threshold.

Scale. Texts are read twice and nothing per cell is written: the first pass adds each task's cell counts (two arrays of
``BUCKETS`` in the worker) and hands on only the cells it used, which Spark sums over tasks; that table (16 bytes a cell)
is broadcast. Which documents are trusted is told in the tasks, by the broadcast doc_ids of the target (up to
``MOST_SENT_IDS``; with more, one join exchanges the texts). The second pass tokenises again and gives the base counts
and the score; only those numbers per row are written. No document meets another.

Edge cases: null or empty text: zeros, score 0, ``base_failed`` (too few words), not kept; without trusted documents the
threshold is the lowest bin, so the method keeps every document that passes the base rules; repeated rows count each
time; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
LEAST_WORDS = 50
BUCKETS = 1 << 20
MOST_SENT_IDS = 8_000_000  # trusted doc_ids sent to every task (8 bytes each); with more, texts meet them in a join
SMOOTHING = 0.1
KEEP_TRUSTED = 0.98
BIN = 0.005
HISTOGRAM_BINS = 4000  # scores are clipped to +-BIN * HISTOGRAM_BINS / 2 for the histogram only


def words_of(text: str | None) -> list[str]:
    import re

    return re.findall(WORD, text) if text else []


def base_counts(text: str | None) -> tuple[int, int, int, int, int, list[str]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words) of one text."""
    if not text:
        return 0, 0, 0, 0, 0, []
    words = words_of(text)
    word_chars = sum(map(len, words))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    n_repeat_words = 0
    if len(often) < len(windows):  # some window occurs again
        covered = np.zeros(len(words), dtype=bool)
        for i, window in enumerate(windows):
            if often[window] >= 2:
                covered[i : i + 3] = True
        n_repeat_words = int(covered.sum())
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), n_repeat_words, words


def hashed(words: list[str]) -> np.ndarray:
    """The cell of every lower-cased word and word pair."""
    import xxhash

    low = [w.lower() for w in words]
    features = low + list(map(" ".join, zip(low, low[1:])))
    return (np.array(list(map(xxhash.xxh64_intdigest, features)), dtype=np.uint64) % np.uint64(BUCKETS)).astype(np.int64)


def cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed cells of the lower-cased words and word pairs, with their counts."""
    return np.unique(hashed(words), return_counts=True)


def _marked(docs: DataFrame, trusted: DataFrame):
    """(rows, ids): doc_id and text, and the trusted doc_ids in order as a broadcast.

    More than ``MOST_SENT_IDS`` ids are not sent (None); the rows then have ``trusted`` from a join, which exchanges texts.
    """
    known = trusted.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    rows = docs.select("doc_id", "text")
    if known.count() <= MOST_SENT_IDS:
        ids = np.sort(known.toArrow().column("doc_id").to_numpy().astype(np.int64))
        return rows, docs.sparkSession.sparkContext.broadcast(ids)
    marked = rows.join(known.withColumn("trusted", F.lit(True)), "doc_id", "left")
    return marked.fillna(False, ["trusted"]), None


def _own(batch: pa.RecordBatch, ids) -> np.ndarray:
    """Which rows of a batch are trusted."""
    if ids is None:
        return batch.column("trusted").to_numpy(zero_copy_only=False)
    known, asked = ids.value, batch.column("doc_id")
    if not len(known):
        return np.zeros(len(asked), dtype=bool)
    wanted = asked.fill_null(0).to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return (known[at] == wanted) & asked.is_valid().to_numpy(zero_copy_only=False)


def _model(marked: DataFrame, ids) -> DataFrame:
    """(cell, raw, target): counts of every cell over all texts and over the trusted ones; each task adds its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.zeros(BUCKETS, dtype=np.int64)
        target = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text, own in zip(batch.column("text").to_pylist(), _own(batch, ids).tolist()):
                where, many = cells(words_of(text))
                raw[where] += many
                if own:
                    target[where] += many
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(used.astype(np.int32)), "raw": pa.array(raw[used]), "target": pa.array(target[used])})

    partial = marked.mapInArrow(count, "cell int, raw bigint, target bigint")
    return partial.groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def score(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``score`` (log-likelihood ratio per feature), ``threshold`` and ``kept`` per row.

    ``trusted``: a table with the doc_id of every trusted-target document (repeats are fine). Texts are read twice (for
    the model, then for the scores); nothing per cell is written.
    """
    spark = docs.sparkSession
    marked, ids = _marked(docs, trusted)
    raw_cells = np.zeros(BUCKETS, dtype=np.float64)
    target_cells = np.zeros(BUCKETS, dtype=np.float64)
    counted = _model(marked, ids).toArrow()  # at most BUCKETS rows of three numbers, in columns
    where = counted.column("cell").to_numpy(zero_copy_only=False)
    raw_cells[where] = counted.column("raw").to_numpy(zero_copy_only=False)
    target_cells[where] = counted.column("target").to_numpy(zero_copy_only=False)
    shared = spark.sparkContext.broadcast((raw_cells, target_cells))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = shared.value
        raw_total, target_total = raw.sum(), target.sum()
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            found = []
            trusted_here = _own(batch, ids)
            for text, own in zip(batch.column("text").to_pylist(), trusted_here.tolist()):
                *base, words = base_counts(text)
                for key, value in zip(names, base):
                    out[key].append(value)
                where, count = cells(words)
                if not len(where):
                    found.append(0.0)
                    continue
                count = count.astype(np.float64)
                size = count.sum()
                mine = count if own else 0.0
                p_target = (target[where] - mine + SMOOTHING) / (target_total - (size if own else 0.0) + SMOOTHING * BUCKETS)
                p_raw = (raw[where] - count + SMOOTHING) / (raw_total - size + SMOOTHING * BUCKETS)
                found.append(float((count * (np.log(p_target) - np.log(p_raw))).sum() / size))
            typed = {k: pa.array(v, pa.int64()) for k, v in out.items()}
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "trusted": pa.array(trusted_here), **typed, "score": pa.array(found, pa.float64())}
            )

    schema = (
        "doc_id bigint, trusted boolean, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, score double"
    )
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(marked.mapInArrow(measure, schema).withColumn("base_failed", base_failed), "quality-scores")

    half = HISTOGRAM_BINS // 2
    binned = F.least(F.greatest(F.floor(F.col("score") / BIN), F.lit(-half)), F.lit(half - 1)).cast("int")
    counts = rows.filter(F.col("trusted") & ~F.col("base_failed")).groupBy(binned.alias("bin")).count().collect()
    threshold = -half * BIN
    if counts:
        total, below = sum(c["count"] for c in counts), 0
        for c in sorted(counts, key=lambda c: c["bin"]):
            if below + c["count"] > (1 - KEEP_TRUSTED) * total:
                threshold = c["bin"] * BIN if c["bin"] > -half else -math.inf
                break
            below += c["count"]
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    return rows.withColumn("threshold", F.lit(float(threshold))).withColumn("kept", kept).drop("trusted")
