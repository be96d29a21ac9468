"""Collocations against a plain count over all phrases."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from caselight.llm import phrase_mining

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, w1 string, rank int"


def plain(rows, least, top):
    found = []
    by_lang: dict = {}
    for text, lang in rows:
        by_lang.setdefault(lang or "und", []).append((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
                n += len(words)
                for m in range(1, 6):
                    for i in range(len(words) - m + 1):
                        f[tuple(words[i : i + m])] += 1
        cands = {p: a for p, a in f.items() if 2 <= len(p) <= 5 and a >= least}
        out = []
        for p, a in cands.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cands.items()
            )
            if inside:
                continue
            best = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            k = best[1]
            out.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], n, best[0]))
        out.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        found += [(r[0], i + 1, *r[1:]) for i, r in enumerate(out[:top])]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, l, "s", 0, "x", 1) for i, (t, l) in enumerate(rows)], SCHEMA
    )


TEXTS = [
    ("New York is big. New York city; the new york times", "en"),
    ("NEW YORK CITY is in New York, the big apple the big apple", "en"),
    ("a a a a a a. a a a", "en"),
    ("the big apple\tthe big apple!the big apple", None),
    (None, "en"),
    ("", None),
    ("über straße über straße Über", "de"),
    ("x y z x y z x y z x y z", "en"),
    ("x y z w v x y z w v", "en"),
]


@pytest.mark.parametrize("least,top", [(2, 2000), (3, 3), (2, 1)])
def test_against_plain_counts(spark, least, top):
    got = phrase_mining.collocations(frame(spark, TEXTS), least=least, top=top).collect()
    assert sorted(tuple(r) for r in got) == plain(TEXTS, least, top)


def test_empty_table(spark):
    assert phrase_mining.collocations(frame(spark, []), least=2).count() == 0


def test_join_path_when_the_vocabulary_is_large(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "MOST_SHIPPED_WORDS", 0)
    got = phrase_mining.collocations(frame(spark, TEXTS), least=2, top=2000).collect()
    assert sorted(tuple(r) for r in got) == plain(TEXTS, 2, 2000)


def test_levels_without_pruning(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "MOST_SHIPPED_GRAMS", 0)
    got = phrase_mining.collocations(frame(spark, TEXTS), least=2, top=2000).collect()
    assert sorted(tuple(r) for r in got) == plain(TEXTS, 2, 2000)


def test_short_keys_are_exchanged_as_one_long(spark, monkeypatch):
    plans = {}
    kept = phrase_mining.stored

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(phrase_mining, "stored", seen)
    phrase_mining.collocations(frame(spark, TEXTS), least=2, top=2000).collect()
    columns = [dealt.split(",") for dealt in re.findall(r"hashpartitioning\((.*?), \d+\)", plans["phrase-level-2"])]
    assert columns and all(len(c) == 2 for c in columns)  # the language and one key


@pytest.mark.parametrize("bits", [1, 7, 12, 13, 16, 21, 25])
def test_keys_of_every_width_can_be_read_back(bits):
    made = np.random.default_rng(bits)
    for length in range(2, 6):
        ids = made.integers(0, 1 << bits, (300, length))
        ids[0], ids[1] = (1 << bits) - 1, 0
        half = phrase_mining.half_of(length * bits)
        key, count = phrase_mining.counted_keys(phrase_mining.filter_key(*phrase_mining.packed(ids, bits), half))
        assert len(key) == (1 if length * bits <= 64 else 2)
        want, often = np.unique(ids, axis=0, return_counts=True)
        got = phrase_mining.unpack(*phrase_mining.packed_of(key, half), bits)
        assert not got[:, length:].any()
        assert sorted(zip(got[:, :length].tolist(), count)) == list(zip(want.tolist(), often))
