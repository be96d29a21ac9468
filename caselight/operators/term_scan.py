"""Scores of a bounded set of questions inside the tasks that read the index: no pair of a question and a chunk is exchanged.

A chunk is one row with all its terms, so its scores are known where it is read; a task hands on the best k per question
only. The questions travel to the tasks as Arrow columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.operators.ranking import STEP

MOST_ASKED = 200_000  # rows (question, term) that are sent to the tasks
CELLS = 4_000_000  # chunks times questions that are scored at once


class Asked:
    """Questions by number, and per term the questions that hold it; ``late`` terms are added to found pairs only."""

    def __init__(self, rows: pa.Table, key: str) -> None:
        rows = rows.combine_chunks()
        coded = pc.dictionary_encode(rows[key], null_encoding="encode").combine_chunks()
        self.keys = coded.dictionary
        terms = pc.dictionary_encode(rows["term"]).combine_chunks()
        self.terms = terms.dictionary
        late = np.asarray(rows["late"]) if "late" in rows.column_names else np.zeros(len(rows), bool)
        number, code = np.asarray(coded.indices), np.asarray(terms.indices)
        weight = np.asarray(rows["w"], dtype=float)
        self.lists = [self._by_term(number[m], code[m], weight[m]) for m in (~late, late)]
        self.floor, self.rest = np.full(len(self.keys), -np.inf), np.zeros(len(self.keys))
        if "floor" in rows.column_names:
            self.floor[number], self.rest[number] = np.asarray(rows["floor"]), np.asarray(rows["rest"])

    def _by_term(self, number, code, weight):
        order = np.argsort(code, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(self.terms)))]).astype(np.int64)
        return starts, number[order].astype(np.int64), weight[order]


def _sums(lists, row, code, weight, cells: int, width: int) -> np.ndarray:
    """Sum of products per (row, question) cell, over postings (row, code, weight)."""
    starts, number, w = lists
    times = starts[code + 1] - starts[code]
    which = np.repeat(np.arange(len(code)), times)
    place = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + starts[code][which]
    return np.bincount(row[which] * width + number[place], weights=weight[which] * w[place], minlength=cells)


def _slice_hits(asked: Asked, terms: pa.Array, best: np.ndarray | None, place: np.ndarray, k: int | None):
    """(row, question, score) of one slice: the first k of each question, or all when k is None."""
    row, flat = _rows_of(terms), terms.flatten()
    found = pc.index_in(flat.field("term"), value_set=asked.terms.cast(flat.type.field("term").type))
    code = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
    held = code >= 0
    row, code, weight = row[held], code[held].astype(np.int64), flat.field("weight").to_numpy(zero_copy_only=False)[held]
    n, width = len(terms), len(asked.keys)
    score = _sums(asked.lists[0], row, code, weight, n * width, width).reshape(n, width)
    # A bound on the rank of what is added later: ``rest`` per question, nothing where no term is late.
    least = np.where(np.isneginf(asked.floor), 0.0, asked.floor - asked.rest)
    if k is not None:
        if n > k:
            np.maximum(best, np.partition(score, n - k, axis=0)[n - k] - 2.0 / STEP, out=best)
        least = np.maximum(least, best - asked.rest)
    at, who = np.nonzero((score > 0) & (score >= least))
    value = score[at, who]
    if len(asked.lists[1][1]) and len(at):
        kept, inner = np.unique(at, return_inverse=True)
        to_kept = np.full(n, -1)
        to_kept[kept] = np.arange(len(kept))
        late = to_kept[row] >= 0
        added = _sums(asked.lists[1], to_kept[row[late]], code[late], weight[late], len(kept) * width, width)
        value = value + added.reshape(len(kept), width)[inner, who]
    if k is not None:
        order = np.lexsort((place[at], -np.floor(value * STEP + 0.5), who))
        at, who, value = at[order], who[order], value[order]
        first = np.searchsorted(who, who)
        top = np.arange(len(who)) - first < k
        at, who, value = at[top], who[top], value[top]
    return at, who, value


def scan(vectors: DataFrame, asked: pa.Table, key: str, key_type: str, k: int | None = None) -> DataFrame:
    """(key, source, ordinal, score) of the chunks ``vectors`` (source, ordinal, terms) for ``asked`` (key, term, w).

    With k, every batch keeps k rows per question, ties by source and ordinal; the first k over all must still be taken.
    ``asked`` may hold ``late``, ``floor`` and ``rest``: late terms cannot bring a chunk in, a chunk whose other
    terms give less than ``floor - rest`` is dropped, and the scores of the remaining ones are whole.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(asked)
    chunk_key = [c for c in vectors.columns if c != "terms"]
    kinds = _schema_without(vectors, "terms")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = Asked(sent.value, key)
        width = len(questions.keys)
        if width == 0:
            return
        best, step = np.full(width, -np.inf), max(1, CELLS // width)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                named = pa.Table.from_batches([batch.select(chunk_key)])
                place = np.empty(batch.num_rows, dtype=np.int64)
                order = pc.sort_indices(named, sort_keys=[(c, "ascending") for c in chunk_key], null_placement="at_start")
                place[order.to_numpy()] = np.arange(batch.num_rows)
                at, who, value = _slice_hits(questions, batch.column("terms"), best, place, k)
                if len(at):
                    taken = batch.select(chunk_key).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [questions.keys.take(pa.array(who)), *taken.columns, pa.array(value)], names=[key, *chunk_key, "score"]
                    )

    return vectors.mapInArrow(search, f"`{key}` {key_type}, {kinds}, score double")


def known_words(tokens: Column, terms: list[str], spark: SparkSession) -> Column:
    """The tokens that are among ``terms``, which travel to the tasks once."""
    sent = spark.sparkContext.broadcast(frozenset(terms))

    @F.arrow_udf("array<string>")
    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            coded = pc.dictionary_encode(lists.flatten())
            held = np.array([w in sent.value for w in coded.dictionary.to_pylist()], dtype=bool)
            kept = held[np.asarray(coded.indices)]
            row = _rows_of(lists)[kept]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), lists.flatten().filter(pa.array(kept)))

    return keep(tokens)


def _rows_of(lists: pa.Array) -> np.ndarray:
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths)


def _listed(row: np.ndarray, n: int, **columns: pa.Array) -> pa.Array:
    """Lists of structs, one per row number below n; ``row`` rises."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


def _schema_without(rows: DataFrame, *left_out: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in left_out)


def term_counts(rows: DataFrame, tokens: Column) -> DataFrame:
    """(source, ordinal, terms): the distinct tokens of every row with their number; rows without a token have none."""
    key = rows.columns[:2]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            coded = pc.dictionary_encode(lists.flatten())
            words = coded.dictionary
            pairs, tf = np.unique(_rows_of(lists) * max(len(words), 1) + np.asarray(coded.indices), return_counts=True)
            row, code = np.divmod(pairs, max(len(words), 1))
            held, place = np.unique(row, return_inverse=True)
            terms = _listed(place, len(held), term=words.take(pa.array(code)), tf=pa.array(tf.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.select(key).take(pa.array(held)).columns, terms], names=[*key, "terms"])

    named = rows.select(*key, tokens.alias("tokens"))
    return named.mapInArrow(count, f"{_schema_without(named, 'tokens')}, terms array<struct<term: string, tf: bigint>>")


def unit_terms(counted: DataFrame, idf: pa.Table) -> DataFrame:
    """(source, ordinal, terms): weights tf * idf over their norm. ``idf`` (term, idf, hot) holds the frequent terms; the
    others are in a row's ``rare``."""
    sent = counted.sparkSession.sparkContext.broadcast(idf.combine_chunks())
    key = [c for c in counted.columns if c not in ("terms", "rare")]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = known["term"].combine_chunks() if known.num_rows else pa.array([], pa.string())
        factors, hots = np.asarray(known["idf"], dtype=float), np.asarray(known["hot"], dtype=bool)
        for batch in batches:
            lists = batch.column("terms")
            flat, row = lists.flatten(), _rows_of(lists)
            term = flat.field("term")
            code = pc.fill_null(pc.index_in(term, value_set=names.cast(term.type)), -1).to_numpy(zero_copy_only=False)
            factor, hot, rare = np.empty(len(row)), np.zeros(len(row), bool), code < 0
            factor[~rare], hot[~rare] = factors[code[~rare]], hots[code[~rare]]
            if rare.any():
                own = batch.column("rare").flatten()
                words = pc.dictionary_encode(pa.concat_arrays([term.filter(pa.array(rare)), own.field("term").cast(term.type)]))
                pair = np.concatenate([row[rare], _rows_of(batch.column("rare"))]) * len(words.dictionary) + np.asarray(words.indices)
                here, there = np.argsort(pair[: rare.sum()]), np.argsort(pair[rare.sum() :])
                at = np.flatnonzero(rare)[here]
                factor[at], hot[at] = np.asarray(own.field("idf"))[there], np.asarray(own.field("hot").to_numpy(zero_copy_only=False))[there]
            weight = flat.field("tf").to_numpy(zero_copy_only=False) * factor
            norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(lists)))
            terms = _listed(row, len(lists), term=term, weight=pa.array(weight / norm[row]), hot=pa.array(hot))
            yield pa.RecordBatch.from_arrays([*batch.select(key).columns, terms], names=[*key, "terms"])

    kinds = _schema_without(counted, "terms", "rare")
    return counted.mapInArrow(weigh, f"{kinds}, terms array<struct<term: string, weight: double, hot: boolean>>")
