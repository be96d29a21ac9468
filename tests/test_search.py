"""Text and vector search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselight.functions import vectors as vx
from caselight.operators import dense, term_index

# Three texts and a query whose scores are known.
TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "A fast auburn canine leaps above an indolent hound.",
    "Python is a popular programming language for data science and machine learning.",
]
QUERY = "A rapid reddish-brown fox hops over a sleepy canine."


def chunk_table(spark, texts):
    return spark.createDataFrame(
        [("src" + str(i % 3), i, t) for i, t in enumerate(texts)], "source string, ordinal long, text string"
    )


def brute_force(texts, queries):
    tokens = [re.findall(r"\w\w+", t.lower()) for t in texts]
    df = Counter(w for t in tokens for w in set(t))
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in df.items()}

    def vector(words):
        raw = {w: n * idf[w] for w, n in Counter(words).items() if w in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()}

    corpus = [vector(t) for t in tokens]
    return [
        [sum(x * c.get(w, 0) for w, x in vector(re.findall(r"\w\w+", q.lower())).items()) for c in corpus]
        for q in queries
    ]


def test_known_scores(spark):
    chunks = chunk_table(spark, TEXTS)
    index = term_index.build_term_index(chunks)
    assert index.idf.count() == 27
    asked = spark.createDataFrame([(1, QUERY)], "query_id long, text string")
    found = {r.ordinal: round(r.score, 4) for r in term_index.search(asked, index, 3).collect()}
    assert found == {0: 0.4523, 1: 0.1768}


@pytest.fixture(scope="module")
def corpus_texts():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, size=12)) + " common" for _ in range(80)]
    return texts + texts[:10] + ["", "zz only"]


@pytest.mark.parametrize("share", [0.0, 0.05, 1.0])
def test_hot_terms_change_nothing(spark, corpus_texts, share, monkeypatch):
    monkeypatch.setattr(term_index, "HOT_SHARE", share)
    chunks = chunk_table(spark, corpus_texts)
    queries = ["w1 w2 w2 common", "w5 unknown words", "nothing known"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, text string")
    index = term_index.build_term_index(chunks)
    found = term_index.search(asked, index, 7, exclude_source="src0").collect()
    scores = brute_force(corpus_texts, queries[:2])
    for number, row in enumerate(scores):
        wanted = sorted(
            (-math.floor(s * 1e9 + 0.5), f"src{i % 3}", i) for i, s in enumerate(row) if s > 0 and i % 3 != 0
        )[:7]
        got = sorted((r for r in found if r.query_id == number), key=lambda r: r["rank"])
        assert [(r.source, r.ordinal) for r in got] == [w[1:] for w in wanted]
        assert [r.score for r in got] == pytest.approx([row[w[2]] for w in wanted], abs=1e-9)
    assert not [r for r in found if r.query_id == 2]


def test_scoped_search_keeps_zero_scores(spark, corpus_texts):
    chunks = chunk_table(spark, corpus_texts)
    asked = spark.createDataFrame([(0, "zz only"), (1, "unknown"), (2, "w3 common")], "query_id long, text string")
    index = term_index.build_term_index(chunks)
    for source in ("src0", "src1"):
        found = term_index.search_scoped(asked, chunks, index, source, 4).collect()
        scores = brute_force(corpus_texts, ["zz only", "w3 common"])
        scores.insert(1, [0.0] * len(corpus_texts))
        for number, row in enumerate(scores):
            wanted = sorted((-math.floor(s * 1e9 + 0.5), i) for i, s in enumerate(row) if f"src{i % 3}" == source)[:4]
            got = sorted((r for r in found if r.query_id == number), key=lambda r: r["rank"])
            assert [r.ordinal for r in got] == [w[1] for w in wanted]


def test_equal_questions_share_their_hits(spark, corpus_texts):
    index = term_index.build_term_index(chunk_table(spark, corpus_texts))
    asked = spark.createDataFrame(
        [(0, "w1 w2 id77"), (1, "w2 id78 w1"), (2, "w9"), (3, "id1")], "query_id long, text string"
    )
    named, hits = term_index.search_by_signature(asked, index, 3)
    by_query = {r.query_id: r.signature for r in named.collect()}
    assert by_query[0] == by_query[1] != by_query[2] and 3 not in by_query
    single = term_index.search(asked, index, 3).select("query_id", "source", "ordinal", "rank")
    shared = named.join(hits, "signature").select("query_id", "source", "ordinal", "rank")
    assert {tuple(r) for r in single.collect()} == {tuple(r) for r in shared.collect()}


def test_stored_index_is_the_same(spark, corpus_texts, tmp_path):
    chunks = chunk_table(spark, corpus_texts)
    built, stored = term_index.build_term_index(chunks), term_index.save_term_index(chunks, str(tmp_path / "i"))
    shown = lambda frame: sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in frame.collect())
    assert shown(built.weights()) == shown(stored.weights()) and shown(built.idf) == shown(stored.idf)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(300, 8)).astype(np.float32)
    matrix[200:260] = matrix[7]  # a group of copies
    rows = [(i, [float(x) for x in v], i % 4 if i < 100 else 0) for i, v in enumerate(matrix)]
    return matrix.astype(np.float64), spark.createDataFrame(rows, "id long, vector array<float>, category int")


def exact(matrix, queries, k, allowed=lambda q, i: True):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    out = {}
    for q in queries:
        scores = unit @ unit[q]
        order = sorted((-math.floor(s * 1e9 + 0.5), i) for i, s in enumerate(scores) if allowed(q, i))
        out[str(q)] = [i for _, i in order[:k]]
    return out


def ranks(found):
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.id)
    return got


@pytest.mark.parametrize("sent,rows", [(4096, 1000), (0, 1000), (0, 23)])
def test_both_search_paths_are_exact(spark, vectors, sent, rows):
    matrix, corpus = vectors
    queries = corpus.filter(F.col("id") < 20).withColumnRenamed("id", "query_id")
    found = dense.cosine_top_k(queries, corpus, 5, max_sent_queries=sent, corpus_block_rows=rows)
    assert ranks(found) == exact(matrix, range(20), 5)
    category = lambda i: i % 4 if i < 100 else 0
    scoped = dense.cosine_top_k(queries, corpus, 5, True, max_sent_queries=sent, corpus_block_rows=rows)
    assert ranks(scoped) == exact(matrix, range(20), 5, lambda q, i: category(q) == category(i))


@pytest.mark.parametrize("rows", [4096, 17])
@pytest.mark.parametrize("limit", [0.4, 1.5, 6.0])
def test_nearest_earlier(spark, vectors, rows, limit):
    matrix, corpus = vectors
    found = dense.nearest_earlier(corpus, limit, rows, rows).collect()
    wanted = {}
    for i in range(1, len(matrix)):
        d = np.linalg.norm(matrix[:i] - matrix[i], axis=1)
        best = min(range(i), key=lambda j: (math.floor(d[j] * 1e6 + 0.5), j))
        if d[best] <= limit:
            wanted[i] = best
    assert {r.id: r.match_id for r in found} == wanted
    assert all(abs(r.distance - np.linalg.norm(matrix[r.id] - matrix[r.match_id])) < 1e-6 for r in found)


def test_cells_with_all_flips_are_exact(spark, vectors):
    matrix, corpus = vectors
    queries = corpus.filter(F.col("id") < 10).withColumnRenamed("id", "query_id")
    cells = dense.build_cells(corpus.drop("category"), 3, 8)
    every = dense.approximate_top_k(queries, cells, 5, 3, 8, flips=3)
    assert ranks(every) == exact(matrix, range(10), 5)
    few = dense.approximate_top_k(queries, cells, 5, 3, 8, flips=1)
    recall = dense.recall_table(dense.cosine_top_k(queries, corpus, 5), few).collect()
    assert len(recall) == 10 and sum(r.recall for r in recall) / 10 >= 0.5


def test_vector_functions(spark):
    frame = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    first, zero = frame.select(
        vx.normalize(a).alias("unit"), vx.cosine(a, b).alias("cos"), vx.squared_l2(a, b).alias("d"),
        vx.angular_distance(vx.cosine(a, b)).alias("angle"), vx.closeness(vx.squared_l2(a, b)).alias("near"),
    ).collect()
    assert first.unit == pytest.approx([0.6, 0.8]) and first.cos == pytest.approx(0.96)
    assert first.d == pytest.approx(2.0) and first.near == pytest.approx(1 / 3)
    # Unit vectors: the angular distance is the Euclidean one.
    assert first.angle == pytest.approx(math.sqrt(0.08)) and zero.cos == 0.0


def test_top_k_is_cut_before_the_exchange(spark, vectors):
    _, corpus = vectors
    scored = corpus.select(F.col("category").alias("query_id"), "id", F.col("vector")[0].alias("score"))
    plan = dense.rank_hits(scored, 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_task_functions_travel_with_their_code(tmp_path):
    """Executors have no copy of the package."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    packed = tmp_path / "packed"
    packed.write_bytes(cloudpickle.dumps(dense._block_hits))
    code = f"import pickle; print(pickle.load(open({str(packed)!r}, 'rb')).__name__)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert ran.stdout.strip() == "_block_hits", ran.stderr


def test_pruned_search_is_exact_and_looks_at_few_chunks(spark, monkeypatch):
    import random

    rng = random.Random(4)
    common = [f"common{i}" for i in range(6)]
    texts = []
    for i in range(400):
        texts.append(" ".join([rng.choice(common) for _ in range(8)] + [f"rare{i % 130}", f"word{rng.randrange(40)}"]))
    chunks = spark.createDataFrame([("s" if i % 5 else "t", i, t) for i, t in enumerate(texts)], "source string, ordinal long, text string")
    asked = [f"common0 common1 rare{i} rare{i + 1}" for i in range(20)] + ["common2 common3", "unknown only", ""]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string")
    monkeypatch.setattr(term_index, "HOT_SHARE", 0.05)
    index = term_index.build_term_index(chunks)
    for exclude in (None, "t"):
        full = term_index.search(queries, index, 3, exclude).select("query_id", "ordinal", "rank").collect()
        pruned = term_index.search_pruned(queries, index, 3, exclude).select("query_id", "ordinal", "rank").collect()
        assert sorted(full) == sorted(pruned)
    vectors = term_index.query_vectors(queries.filter("query_id < 20"), index)
    terms = vectors.select("query_id", F.explode("terms").alias("t")).select("query_id", "t.term", F.col("t.weight").alias("w"), "t.hot")
    looked_at = term_index.pruned_candidates(terms, index, 3).count()
    assert looked_at < 20 * 400 / 10


def test_questions_are_scored_where_the_index_is_read(spark, corpus_texts, monkeypatch):
    chunks = chunk_table(spark, corpus_texts)
    index = term_index.build_term_index(chunks)
    asked = spark.createDataFrame(list(enumerate(["w1 w2 w2 common", "w5 w7", "zz only", "nothing"])), "query_id long, text string")

    def rows():
        found = [term_index.search(asked, index, 4, "src0"), term_index.search_pruned(asked, index, 4), term_index.search_scoped(asked, chunks, index, "src1", 3)]
        return [sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in f.collect()) for f in found]

    few = rows()
    plan = term_index.search(asked, index, 4)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "_salt" not in plan
    monkeypatch.setattr(term_index.term_scan, "MOST_ASKED", 0)
    assert rows() == few
    monkeypatch.undo()
    monkeypatch.setattr(term_index.term_scan, "CELLS", 20)  # slices of a few chunks
    assert rows() == few


def test_scan_takes_null_keys_and_ties(spark):
    held = [(None, 1, "aa bb"), ("s", None, "aa bb"), ("s", 2, "aa bb"), ("r", 3, "aa cc")]
    chunks = spark.createDataFrame(held, "source string, ordinal long, text string")
    index = term_index.build_term_index(chunks)
    asked = spark.createDataFrame([(1, "bb")], "query_id int, text string")
    found = sorted(term_index.search(asked, index, 3).collect(), key=lambda r: r["rank"])
    assert [(r.source, r.ordinal) for r in found] == [(None, 1), ("s", None), ("s", 2)]


def test_index_with_rare_terms_and_repeated_keys(spark, tmp_path, monkeypatch):
    held = [("s", 1, "aa bb bb cc"), ("s", 1, "aa dd"), (None, 2, "aa ee"), ("s", None, "bb ff ee"), ("t", 3, None), ("t", 4, "!")]
    chunks = spark.createDataFrame(held, "source string, ordinal long, text string")
    built = term_index.build_term_index(chunks)
    shown = lambda frame: sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in frame.collect()), key=str)
    for sent in (200_000, 2, 0):
        monkeypatch.setattr(term_index, "MOST_SENT_TERMS", sent)
        stored = term_index.save_term_index(chunks, str(tmp_path / f"i{sent}"))
        assert shown(built.weights()) == shown(stored.weights()) and shown(built.idf) == shown(stored.idf)
        assert shown(built.peaks) == shown(stored.peaks)


def test_texts_and_not_their_tokens_are_exchanged(spark):
    rows = spark.createDataFrame([(1, "aa bb aa"), (2, "aa"), (1, "aa"), (None, "cc")], "doc_id long, text string")
    counted = term_index.term_frequency(rows, ["doc_id"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "term" not in exchanges[0]
    assert {tuple(r) for r in counted.collect()} == {(1, "aa", 3), (1, "bb", 1), (2, "aa", 1), (None, "cc", 1)}


def test_a_full_block_is_met_piece_by_piece():
    import tracemalloc

    import pandas as pd

    made = np.random.default_rng(3)
    block = pd.DataFrame({"id": np.arange(20_000), "vector": list(made.normal(size=(20_000, 4)))})
    asked = block.iloc[-1000:]
    tracemalloc.start()
    found = dense._nearest_of_block(asked, block, 0.3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # all 20 million distances at once take 160 MB, and as much for each step
    matrix = np.stack(block["vector"])
    wanted = {}
    for i in asked["id"]:
        distance = np.linalg.norm(matrix[:i] - matrix[i], axis=1)
        if distance.min() <= 0.3:
            wanted[i] = int(distance.argmin())
    assert len(wanted) > 100 and dict(zip(found["id"], found["match_id"])) == wanted


def records_exchanged(frame):
    """Rows written by all exchanges of a plan that has run."""
    found, todo = 0, [frame._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name == "Exchange":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_vectors_are_not_written_once_per_block(spark):
    matrix = np.random.default_rng(4).normal(size=(600, 32))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "id long, vector array<float>")
    found = dense.nearest_earlier(corpus, 4.1, 20, 20)
    wanted = [i for i in range(1, 600) if np.linalg.norm(matrix[:i] - matrix[i], axis=1).min() <= 4.1]
    assert sorted(r.id for r in found.collect()) == wanted
    assert 600 < records_exchanged(found) < 6 * 600  # 30 blocks: each of them got its own copy of every vector


def test_a_task_hands_on_a_vector_once(spark):
    matrix = np.random.default_rng(4).normal(size=(400, 6))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "id long, vector array<float>")
    found = dense.nearest_earlier(corpus, 9.0, 200, 100)  # two parts, each of two blocks or three
    assert len(found.collect()) == 399
    todo, handed = [found._jdf.queryExecution().executedPlan().executedPlan()], []
    while todo:
        node = todo.pop()
        todo += [node.plan()] if node.nodeName().endswith("QueryStage") else []
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "MapInPandas" and "match_id" in node.simpleString(2000):
            handed.append(node.metrics().apply("pythonNumRowsReceived").value())
    assert len(handed) == 1 and 399 <= handed[0] <= 2 * 400


@pytest.mark.parametrize("rows", [1, 4096])
def test_nearest_earlier_of_odd_rows(spark, rows):
    nan, inf = float("nan"), float("inf")
    items = [
        (1, [0.0, 0.0, 0.0]), (2, [nan, 0.0, 0.0]), (3, [0.1, 0.0, 0.0]), (4, None), (5, [0.1, 0.0, 0.0]), (6, [inf, 0.0, 0.0]),
        (7, [5.0, 5.0, 5.0]), (7, [5.0, 5.0, 5.3]), (8, [5.0, 5.0, 5.2]), (8, [5.0, 5.0, 5.2]), (9, [-0.0, 0.0, 0.0]),
        (None, [0.2, 0.0, 0.0]), (10, [0.2, 0.0, 0.0]), (11, [9.0, 9.0, 9.0]),
    ]
    corpus = spark.createDataFrame(items, "id long, vector array<double>")
    found = sorted((r.id, r.match_id, round(r.distance, 6)) for r in dense.nearest_earlier(corpus, 0.5, rows, rows).collect())
    assert found == [(3, 1, 0.1), (5, 3, 0.0), (8, 7, 0.1), (9, 1, 0.0), (10, 3, 0.1)]
    assert dense.nearest_earlier(corpus.filter("id < 0"), 0.5, rows, rows).collect() == []


def test_blocks_hold_their_vectors_exactly():
    import pandas as pd

    matrix = np.random.default_rng(6).normal(size=(10, 4))
    matrix[3, 1] = np.nan
    kept = [i for i in range(10) if i != 3]
    for numbers, single in ((matrix.astype(np.float32).astype(np.float64), True), (matrix, False)):
        frame = pd.DataFrame({"id": np.arange(10), "vector": list(numbers), "slab": np.arange(10) // 5, "part": 2})
        blocks = pd.concat(dense._pack(iter([frame[:7], frame[7:]]), 4), ignore_index=True)
        assert list(blocks["rows"]) == [4, 4, 1] and set(blocks["single"]) == {single} and set(blocks["part"]) == {2}
        assert list(blocks["low_id"]) == [0, 5, 9] and list(blocks["high_id"]) == [4, 8, 9]
        assert list(blocks["low_slab"]) == [0, 1, 1] and list(blocks["high_slab"]) == [0, 1, 1]
        back = pd.concat([dense._unpacked(*b) for b in blocks[["rows", "single", "ids", "vectors"]].itertuples(index=False)])
        assert list(back["id"]) == kept and np.array_equal(np.stack(back["vector"]), numbers[kept])
    wide = pd.DataFrame({"id": np.arange(5), "vector": list(np.ones((5, dense.BLOCK_NUMBERS // 2))), "slab": 0, "part": 0})
    assert [b["rows"].iat[0] for b in dense._pack(iter([wide]), 4)] == [2, 2, 1]
