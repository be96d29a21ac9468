"""Language of whole texts by a small byte-level convolutional network.

Bytes are embedded, filters of several widths run over a window of fixed length, the largest value of each filter over
the window goes through a softmax. Training (plain numpy, Adam) uses a bounded sample of labelled windows; prediction
cuts every whole text into windows that overlap by the widest filter, runs them in batches and averages the softmax
over the windows, weighted by their bytes.

Bounds (parameters of ``train``): one window from each of about ``sample`` labelled documents, drawn by a hash.

Defined results: null texts and texts without a letter give ``und`` and score 0; without labelled texts every text does;
ties between languages go to the first in alphabetical order; repeated rows are predicted once each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import map_rows

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBED = 8
BATCH = 64
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_WIDEST = max(WIDTHS)


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray | None = None  # byte + 1 -> EMBED; row 0 is the padding
    filters: np.ndarray | None = None  # (_WIDEST * EMBED, all filters); narrow filters have zeros at the end
    bias: np.ndarray | None = None
    dense: np.ndarray | None = None
    dense_bias: np.ndarray | None = None


def windows(text: str) -> np.ndarray:
    """The lower-case bytes of the whole text plus one, in rows of WINDOW; neighbours share what the widest filter needs."""
    raw = np.frombuffer(text.lower().encode("utf-8"), dtype=np.uint8).astype(np.int16) + 1
    step = WINDOW - _WIDEST + 1
    count = max(1, -(-max(0, len(raw) - _WIDEST + 1) // step))
    padded = np.zeros(count * step + 2 * _WIDEST, dtype=np.int16)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step][:count]


def _patches(model: Model, rows: np.ndarray) -> np.ndarray:
    """Every place of every window with the embedded bytes that the filters see there."""
    padded = np.zeros((len(rows), WINDOW + _WIDEST - 1), dtype=np.int64)
    padded[:, :WINDOW] = rows
    embedded = model.embedding[padded].reshape(len(rows), -1)
    view = np.lib.stride_tricks.sliding_window_view(embedded, _WIDEST * EMBED, axis=1)[:, ::EMBED]
    return np.ascontiguousarray(view)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def window_probabilities(model: Model, rows: np.ndarray) -> np.ndarray:
    found = []
    for start in range(0, len(rows), BATCH):
        patches = _patches(model, rows[start : start + BATCH])
        strongest = (patches.reshape(-1, patches.shape[2]) @ model.filters).reshape(*patches.shape[:2], -1).max(axis=1)
        found.append(_softmax(np.maximum(strongest + model.bias, 0) @ model.dense + model.dense_bias))
    return np.concatenate(found) if found else np.empty((0, len(model.languages)))


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each whole text."""
    known = [i for i, t in enumerate(texts) if t and model.languages and _LETTER.search(t)]
    out = [(UNKNOWN, 0.0)] * len(texts)
    waiting: list[tuple[int, np.ndarray]] = []
    held = 0

    def run() -> None:
        rows = np.concatenate([r for _, r in waiting])
        shares, sizes, at = window_probabilities(model, rows), (rows > 0).sum(axis=1), 0
        for i, r in waiting:
            mean = np.average(shares[at : at + len(r)], axis=0, weights=sizes[at : at + len(r)] + 1e-9)
            at += len(r)
            best = int(mean.argmax())
            out[i] = (model.languages[best], float(min(1.0, mean[best])))

    for i in known:
        waiting.append((i, windows(texts[i])))
        held += len(waiting[-1][1])
        if held >= 16 * BATCH:
            run()
            waiting, held = [], 0
    if waiting:
        run()
    return out


def fit(rows: np.ndarray, labels: list[str], epochs: int = 6, seed: int = 11) -> Model:
    """Train on windows (n, WINDOW) with their languages."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    width, n_filters = _WIDEST * EMBED, FILTERS * len(WIDTHS)
    live = np.zeros((width, n_filters), dtype=np.float32)
    for i, w in enumerate(WIDTHS):
        live[: w * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
    model = Model(
        languages,
        rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        (rng.normal(0, 0.3, (width, n_filters)) * live).astype(np.float32),
        np.zeros(n_filters, np.float32),
        rng.normal(0, 0.2, (n_filters, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    model.embedding[0] = 0
    target = np.array([languages.index(v) for v in labels])
    weight = (len(target) / (len(languages) * np.bincount(target, minlength=len(languages)))).astype(np.float32) ** 0.5
    names = ["embedding", "filters", "bias", "dense", "dense_bias"]
    moments = {k: (np.zeros_like(getattr(model, k)), np.zeros_like(getattr(model, k))) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            own = order[start : start + BATCH]
            x, y = rows[own], target[own]
            patches = _patches(model, x)
            values = (patches.reshape(-1, width) @ model.filters).reshape(len(x), -1, n_filters)
            place = values.argmax(axis=1)
            strongest = np.take_along_axis(values, place[:, None], axis=1)[:, 0] + model.bias
            active = np.maximum(strongest, 0)
            shares = _softmax(active @ model.dense + model.dense_bias)
            error = shares.copy()
            error[np.arange(len(y)), y] -= 1
            error *= weight[y][:, None] / len(y)
            back = (error @ model.dense.T) * (strongest > 0)
            chosen = np.take_along_axis(patches, place[:, :, None], axis=1)  # only the winning place of a filter learns
            to_patch = back[:, :, None] * model.filters.T[None]
            to_bytes = np.zeros_like(model.embedding)
            padded = np.pad(x, ((0, 0), (0, _WIDEST - 1))).astype(np.int64)
            for j in range(_WIDEST):
                seen = np.take_along_axis(padded, place + j, axis=1)
                np.add.at(to_bytes, seen.ravel(), to_patch[:, :, j * EMBED : (j + 1) * EMBED].reshape(-1, EMBED))
            to_bytes[0] = 0
            gradients = {
                "embedding": to_bytes, "filters": np.einsum("bf,bfk->kf", back, chosen) * live,
                "bias": back.sum(axis=0), "dense": active.T @ error, "dense_bias": error.sum(axis=0),
            }
            step += 1
            for k in names:
                g, (m, v) = gradients[k], moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                rate = 0.004 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(model, k, (getattr(model, k) - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32))
    return model


def train(documents: DataFrame, learn: Column, sample: int = 8000, epochs: int = 6) -> Model:
    """Learn from text and non-null ``lang`` of the documents whose ``doc_id`` meets ``learn``."""
    usable = documents.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    total = usable.count()
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    drawn = usable.filter(draw < min(1.0, sample / total if total else 1.0))
    # One window of each, anywhere in its text: a window has WINDOW bytes, so no more than WINDOW characters are sent.
    start = F.pmod(F.xxhash64(F.lit("place"), "doc_id"), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))) + 1
    rows = drawn.select("lang", F.substring("text", start.cast("int"), F.lit(WINDOW)).alias("part")).collect()
    rows = sorted((r.lang, r.part) for r in rows if _LETTER.search(r.part))
    if not rows:
        return Model([])
    return fit(np.concatenate([windows(p)[:1] for _, p in rows]), [lang for lang, _ in rows], epochs)


def classify(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred and score of every whole text; kept columns win over these two names."""
    kinds = dict(documents.dtypes)

    def make():
        def work(batch):
            found = predict(model, batch.column(len(keep)).to_pylist())
            out = {f"k{i}": batch.column(i) for i in range(len(keep))}
            return out | {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return work

    schema = "".join(f"k{i} {kinds[c]}, " for i, c in enumerate(keep)) + "lang_pred string, score double"
    rows = map_rows(documents.select(*keep, F.col("text").alias("_text")), schema, make)
    named = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return rows.select(*named, *[c for c in ("lang_pred", "score") if c not in keep])


def keep_known(documents: DataFrame, model: Model, least_score: float) -> DataFrame:
    """The rows whose language is found with at least ``least_score``, with the columns they came with."""
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", F.col(f"c{names.index('text')}"))
    found = classify(plain, model, tuple(f"c{i}" for i in range(len(names))))
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.drop("lang_pred", "score").toDF(*names)
