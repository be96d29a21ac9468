"""Language identification: held-out accuracy, whole texts, and odd input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caselight.llm import language_id as L
from caselight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, score string"


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.read.parquet(f"{SF}/documents.parquet"), F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def test_held_out_accuracy(spark):
    found = QUERIES["op9_language_id"](spark, SF).toPandas().set_index("doc_id")
    lang = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["lang"]
    held = found[found.held_out]
    assert len(found) == len(lang)
    assert (held["lang_pred"] == lang.loc[held.index]).mean() > 0.93
    assert found["score"].between(0, 1).all()


def test_windows_cover_every_place_of_the_text():
    for n in (0, 1, 3, 252, 253, 254, 256, 257, 509, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        rows = L.windows(text)
        assert rows.shape[1] == L.WINDOW
        grams = {bytes((r[i : i + 4] - 1).astype(np.uint8)) for r in rows for i in range(L.WINDOW - 3) if r[i + 3]}
        assert {text[i : i + 4].encode() for i in range(n - 3)} <= grams


def test_batches_do_not_change_the_result(model):
    texts = list(pd.read_parquet(f"{SF}/documents.parquet")["text"].head(40))
    together, alone = L.predict(model, texts), [L.predict(model, [t])[0] for t in texts]
    assert [t[0] for t in together] == [a[0] for a in alone]
    assert np.allclose([t[1] for t in together], [a[1] for a in alone], atol=1e-5)


def test_odd_input(spark, model):
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 !!", None, "x"), (4, "é", None, "x"), (4, "é", None, "x"), (None, "The and of " * 9000, "en", "x")]
    frame = spark.createDataFrame(rows, COLUMNS)
    got = sorted(map(tuple, L.classify(frame, model).collect()), key=str)
    assert len(got) == len(rows)
    assert [(k, p, s) for k, p, s in got if k in (1, 2, 3)] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert len({r for r in got if r[0] == 4}) == 1
    assert next(p for k, p, _ in got if k is None) == "en"
    empty = frame.limit(0)
    nothing = L.train(empty, F.lit(True))
    assert L.classify(empty, nothing).count() == 0
    assert {r.lang_pred for r in L.classify(frame, nothing).collect()} == {"und"}
