"""Toxicity by compression distance: how much shorter does a window get with a dictionary of toxic than of ordinary text?

Two zstandard dictionaries are learned from labelled text. The ordinary one holds the words that stand in most contexts
of ordinary documents, the toxic one holds the same words and those whose contexts are significantly more often toxic (a
z-test over distinct preceding words, so that copies of one document count once). Since they share their ordinary part,
they differ only where toxic text helps.

A window is ``window_words`` words and a frame of fixed bytes that both dictionaries end with: zstandard stores very short
inputs raw, and the frame takes them past that, so the length of even one word is measured. ``gain`` is the length with
the ordinary dictionary less that with the toxic one. Windows repeat, so a task keeps the gains it has met.

The number of windows of a document with a gain of at least t, for each t, the number of those that gain much for their
length (a short word cannot gain many bytes), and the number of windows are the inputs of a logistic regression, fitted on
labelled documents that the dictionaries have not seen: it calibrates the thresholds.

Bounds (parameters of ``train``): the dictionaries are learned from about ``sample`` documents of either label, the
regression from about ``calibrate`` documents, both drawn by a hash of the id; the dictionaries hold ``dictionary_bytes``.
Scoring reads every whole text.

Defined results: a null or empty text has no windows and gets the score of no windows; without labels of both kinds, or
without toxic words, every score is the share of label 1 (0 without labels); repeated rows are scored once each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.llm.common import map_rows, stored

FRAME = bytes(range(1, 29))
LEVEL = 9
GAINS = range(1, 9)
MARKED_GAINS, EIGHTHS = (2, 3), range(2, 7)  # a gain of so many bytes at least, and of so many eighths of the window's length
MEMORY = 400_000
REACH = 6.0  # inputs count up to so many standard deviations


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    window_words: int = 1
    base: float = 0.0  # the share of label 1
    centre: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)  # the last one stands alone


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


class Gains:
    """Compressed lengths of windows, and the inputs of the regression for whole texts."""

    def __init__(self, model: Model):
        import zstandard

        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, min_match=3
        )
        self.size, self.known = model.window_words, {}
        self.compress = []
        for content in (model.ordinary, model.toxic):
            held = zstandard.ZstdCompressionDict(content + FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            self.compress.append(zstandard.ZstdCompressor(dict_data=held, compression_params=settings).compress)
        self.least = self.lengths(b"")[0]

    def lengths(self, window: bytes) -> tuple[int, int]:
        """Compressed lengths with the ordinary and with the toxic dictionary."""
        framed = b" " + window + b" " + FRAME
        return len(self.compress[0](framed)), len(self.compress[1](framed))

    def _code(self, window: bytes) -> int:
        """Gain and eighths of the length in one number."""
        ordinary, toxic = self.lengths(window)
        gain = min(max(ordinary - toxic, 0), GAINS[-1])
        code = 8 * gain + min(8 * gain // max(1, ordinary - self.least), 7)
        if len(window) <= 64:
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[window] = code
        return code

    def inputs(self, text: str | None) -> list[float]:
        found = words(text)
        if self.size > 1:
            found = [b" ".join(found[i : i + self.size]) for i in range(0, len(found), self.size)]
        known = self.known.get
        codes = [c if (c := known(w)) is not None else self._code(w) for w in found]
        counts = np.bincount(np.array(codes, dtype=np.int64), minlength=8 * (GAINS[-1] + 1)).reshape(-1, 8)
        at_least = counts.sum(axis=1)[::-1].cumsum()[::-1][GAINS[0] :]
        marked = [counts[g:].sum(axis=0)[::-1].cumsum()[::-1][EIGHTHS[0] : EIGHTHS[-1] + 1] for g in MARKED_GAINS]
        return np.log1p(np.concatenate([at_least, *marked, [len(found)]])).tolist()


def _word_contexts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, before): distinct preceding words of each word, by label."""

    def make():
        def work(batch):
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                pairs = list(set(zip([b""] + found, found)))
                yield {"word": [w for _, w in pairs], "toxic": [toxic] * len(pairs), "before": [b for b, _ in pairs]}

        return work

    return map_rows(labelled.select("toxic", "text"), "word binary, toxic int, before binary", make).distinct()


def _fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 30):
    """Logistic regression by Newton steps; rows are standardised and get a constant."""
    centre, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 0.05)
    x = np.hstack([np.clip((rows - centre) / scale, -REACH, REACH), np.ones((len(rows), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        w -= np.linalg.solve(hessian, x.T @ (p - labels) + penalty @ w)
    return centre.tolist(), scale.tolist(), w.tolist()


def train(
    documents: DataFrame, labels: DataFrame, learn: Column, sample: int = 3000, calibrate: int = 6000,
    dictionary_bytes: int = 8192, window_words: int = 1, least_z: float = 4.5, least_contexts: int = 4,
) -> Model:
    """Learn from the documents whose ``doc_id`` meets ``learn``; ``labels`` is (doc_id, toxic)."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(learn & F.col("toxic").isin(0, 1))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_all = sizes.get(1, 0), sum(sizes.values())
    model = Model(window_words=window_words, base=n_toxic / n_all if n_all else 0.0)
    if not n_toxic or n_toxic == n_all:
        return model
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    third = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)) == 0  # a third calibrates, the rest gives words
    share = F.when(F.col("toxic") == 1, min(1.0, 1.5 * sample / n_toxic)).otherwise(min(1.0, 1.5 * sample / (n_all - n_toxic)))
    texts = documents.select("doc_id", "text")
    # The drawn ids are bounded by ``sample`` and ``calibrate``, so they go to the texts and no text is exchanged.
    for_words = texts.join(F.broadcast(known.filter(~third & (draw < share))), "doc_id")
    contexts = stored(
        _word_contexts(for_words).groupBy("word").agg(
            F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
        ),
        "contexts",
    )
    total = contexts.agg(F.sum("a"), F.sum("b")).first()
    a_all, b_all = max(1, total[0] or 0), max(1, total[1] or 0)
    z = (F.col("a") / a_all - F.col("b") / b_all) / F.sqrt(
        (F.col("a") + F.col("b") + 1) / (a_all + b_all) * (1 / a_all + 1 / b_all)
    )
    strange = (F.col("a") >= least_contexts) & (z >= least_z) & (F.col("a") / a_all > 4 * F.col("b") / b_all)
    most = dictionary_bytes // 4
    toxic = contexts.filter(strange).orderBy(z.desc(), "word").limit(most).collect()  # no more than fit in
    plain = contexts.filter("b > 0").orderBy(F.desc("b"), "word").limit(400).collect()
    if not toxic:
        return model
    model.ordinary = (b" " + b" ".join(bytes(r.word) for r in plain) + b" ")[: dictionary_bytes // 4]
    model.toxic = model.ordinary + (b" " + b" ".join(bytes(r.word) for r in reversed(toxic)) + b" ")[-dictionary_bytes:]

    for_fit = texts.join(F.broadcast(known.filter(third & (draw < min(1.0, 3 * calibrate / n_all)))), "doc_id")
    seen = _inputs(for_fit, model, ["toxic"]).collect()  # about ``calibrate`` rows of a few numbers
    targets = np.array([r.toxic for r in seen], dtype=float)
    if 0 < targets.sum() < len(targets):
        model.centre, model.scale, model.weights = _fit(np.array([r._inputs for r in seen]), targets)
    return model


def _inputs(df: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` and ``_inputs`` of every whole text."""
    kinds = dict(df.dtypes)

    def make():
        gains = Gains(model)

        def work(batch):
            out = {f"k{i}": batch.column(i) for i in range(len(keep))}
            return out | {"_inputs": [gains.inputs(t) for t in batch.column(len(keep)).to_pylist()]}

        return work

    schema = "".join(f"k{i} {kinds[c]}, " for i, c in enumerate(keep)) + "_inputs array<double>"
    rows = map_rows(df.select(*keep, F.col("text").alias("_text")), schema, make)
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "_inputs")


def with_score(documents: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` and the score: from 0 to 1, higher where label 1 is likelier; every whole text."""
    if not model.weights:
        return documents.select(*keep, F.lit(model.base).alias(name))
    found = _inputs(documents, model, keep)
    scaled = [
        F.greatest(F.lit(-REACH), F.least(F.lit(REACH), (F.col("_inputs")[i] - c) / s)) * w
        for i, (c, s, w) in enumerate(zip(model.centre, model.scale, model.weights))
    ]
    logit = sum(scaled[1:], scaled[0]) + model.weights[-1]
    return found.select(*keep, (1 / (1 + F.exp(-logit))).alias(name))


def score(documents: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row."""
    return with_score(documents, model, [key])


def keep_clean(documents: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows that score under ``threshold``, with the columns they came with."""
    return with_score(documents, model, documents.columns, "_toxicity").filter(F.col("_toxicity") < threshold).drop("_toxicity")
