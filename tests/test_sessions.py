"""Running values, memory, shares, evaluation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselight.operators import conversation, evaluation, hits, shares


@pytest.fixture(scope="module")
def messages(spark):
    rows = []
    for conv in range(4):
        for turn in range([1, 7, 30, 12][conv]):
            role = "system" if turn == 0 and conv % 2 else ("user" if turn % 2 == 0 else "assistant")
            rows.append((conv, turn, role, f"Text {conv}.{turn} said. And more"))
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def spoken(rows):
    out = {}
    for conv, turn, role, text in sorted(rows):
        if role != "system":
            out.setdefault(conv, []).append((turn, ("Human: " if role == "user" else "AI: ") + text, text))
    return out


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_split_running_equals_one_window(spark, block):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(3)), i, int(i) if rng.random() < 0.3 else None, int(rng.integers(5))) for i in range(60)]
    frame = spark.createDataFrame(rows, "k long, n long, v long, w long")
    found = conversation.split_running(
        frame, ["k"], ["n"], conversation.number_block("n", block), lasts=["v"], sums=["w"], number="place"
    ).collect()
    last, total, place = {}, {}, {}
    wanted = {}
    for k, n, v, w in rows:
        last[k] = v if v is not None else last.get(k)
        total[k] = total.get(k, 0) + w
        place[k] = place.get(k, 0) + 1
        wanted[n] = (last[k], total[k], place[k])
    assert {r.n: (r.v_so_far, r.w_running, r.place) for r in found} == wanted


@pytest.mark.parametrize("block", [4, 5, 1000])
def test_memory_window(messages, block):
    rows, frame = messages
    found = {(r.conv_id, r.turn): r.memory for r in conversation.memory_window(frame, 2, block).collect()}
    wanted = {
        (conv, said[i][0]): [line for _, line, _ in said[max(0, i - 4) : i]]
        for conv, said in spoken(rows).items()
        for i in range(len(said))
    }
    assert found == wanted


@pytest.mark.parametrize("page", [3, 1000])
def test_full_history_is_whole(messages, page):
    rows, frame = messages
    pages = {(r.conv_id, r.page): r.text for r in conversation.history_pages(frame, page).collect()}
    said = spoken(rows)
    for r in conversation.memory_full(frame, page).collect():
        parts = [pages[(r.conv_id, p)] for p in range(r.pages_before)] + ([r.history] if r.history else [])
        before = [line for turn, line, _ in said[r.conv_id] if turn < r.turn]
        assert "\n".join(parts) == ("\n".join(before) if before else conversation.EMPTY_HISTORY)


def test_memory_switch_drops_earlier_turns(messages):
    rows, frame = messages
    for r in conversation.memory_switch(frame, limit=10).collect():
        said = spoken(rows)[r.conv_id]
        i = [turn for turn, _, _ in said].index(r.turn)
        if i < 10:
            assert (r.mode, r.history) == ("buffer", "\n".join(line for _, line, _ in said[:i])) or i == 9
        else:
            kept = [f"Text {r.conv_id}.{turn} said." for turn, _, _ in said[9:i]]
            assert (r.mode, r.history) == ("summary", "\n".join(kept))


# A falling distribution.
WORDS = [("chocolate", 0.40), ("vanilla", 0.30), ("strawberry", 0.15), ("pizza", 0.08), ("the", 0.04), ("elephant", 0.02), ("rocket", 0.01)]


@pytest.fixture(scope="module")
def items(spark):
    rows = [("g", w, p) for w, p in WORDS] + [("even", f"i{i:03d}", 1.0) for i in range(100)]
    return spark.createDataFrame(rows, "g string, item string, w double")


def share_of(frame, group):
    return {r.item: r.share for r in frame.filter(F.col("g") == group).collect()}


def test_top_k_and_nucleus(items):
    top = share_of(shares.top_k_share(items, "g", "item", "w", 3), "g")
    assert top == pytest.approx({"chocolate": 0.4 / 0.85, "vanilla": 0.3 / 0.85, "strawberry": 0.15 / 0.85})
    for p, count in ((0.05, 1), (0.40, 1), (0.70, 2), (0.85, 3), (0.95, 5), (1.0, 7)):
        kept = share_of(shares.nucleus_share(items, "g", "item", "w", p, blocks=5), "g")
        assert list(sorted(kept)) == sorted(w for w, _ in WORDS[:count])
        assert sum(kept.values()) == pytest.approx(1.0)


def test_nucleus_among_equal_weights(items):
    kept = share_of(shares.nucleus_share(items, "g", "item", "w", 0.305, blocks=7), "even")
    assert sorted(kept) == [f"i{i:03d}" for i in range(31)]


@pytest.mark.parametrize("t", [0.2, 1.0, 2.0])
def test_temperature(items, t):
    raw = {w: p ** (1 / t) for w, p in WORDS}
    wanted = {w: x / sum(raw.values()) for w, x in raw.items()}
    assert share_of(shares.temperature_share(items, "g", "w", t), "g") == pytest.approx(wanted)


def test_sample_repeats_and_follows_weights(spark):
    rows = [(f"g{i}", w, p) for i in range(400) for w, p in WORDS]
    frame = spark.createDataFrame(rows, "g string, item string, w double")
    draw = lambda: {(r.g, r.item) for r in shares.weighted_sample(frame, "g", "item", "w", 1, seed=3).collect()}
    first = draw()
    assert first == draw() and len(first) == 400
    assert abs(sum(item == "chocolate" for _, item in first) / 400 - 0.4) < 0.08


def test_budget(spark):
    frame = spark.createDataFrame([("s", i, c) for i, c in enumerate([3, 0, 4, 5, 1])], "g string, n long, c long")
    kept = shares.budget_select(frame, "g", "n", "c", 9).collect()
    assert sorted((r.n, r.c_so_far) for r in kept) == [(0, 3), (1, 4), (2, 8)]


def test_evaluation_by_type_and_delta(spark):
    rows = [("q1", "multi_hop", 0.2, 0.4, 0.6, 0.8), ("q2", "multi_hop", 0.4, 0.4, 0.6, 0.8), ("q3", "product_factual", 1.0, 1.0, 1.0, 1.0)]
    columns = ["question", "query_type", *evaluation.METRICS]
    base = spark.createDataFrame(rows, columns)
    better = base.withColumn("faithfulness", F.col("faithfulness") + 0.1).withColumn("answer_relevancy", F.col("answer_relevancy") - 0.5)
    merged = evaluation.override(base, better, "question", "query_type", ["multi_hop"], evaluation.METRICS)
    means = evaluation.means_by_type(base, "query_type", types=evaluation.QUERY_TYPES).orderBy("place").collect()
    assert [(m.query_type, round(m.faithfulness, 3)) for m in means] == [
        ("product_factual", 1.0), ("multi_hop", 0.3), ("OVERALL", 0.533),
    ]
    compared = evaluation.compare(*[evaluation.means_by_type(d, "query_type") for d in (base, merged)], "query_type")
    arrows = {(r.query_type, r.metric): r.arrow for r in evaluation.deltas(compared, "query_type").collect()}
    assert arrows[("multi_hop", "faithfulness")] == "▲" and arrows[("multi_hop", "answer_relevancy")] == "▼"
    assert arrows[("product_factual", "faithfulness")] == "→"


def test_precision_and_recall(spark):
    marked = spark.createDataFrame(
        [("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, False)], "query_id string, rank long, relevant boolean"
    )
    found = {r.query_id: r for r in evaluation.precision_at_k(marked).collect()}
    assert found["a"].precision == pytest.approx(2 / 3)
    assert found["a"].average_precision == pytest.approx((1 + 2 / 3) / 2)
    assert found["b"].average_precision == 0.0
    wanted = spark.createDataFrame([("a", 4), ("b", 1)], "query_id string, relevant_total long")
    assert {r.query_id: r.recall for r in evaluation.recall_at_k(marked, wanted).collect()} == {"a": 0.5, "b": 0.0}


def test_citations(spark):
    schema = "query_id long, rank long, metadata map<string,string>"
    rows = [
        (1, 2, {"source_file": "b.md", "section_heading": "Returns", "product_id": ""}),
        (1, 1, {"source_file": "a.csv", "product_id": "P1", "section_heading": "x"}),
        (1, 3, {"source_file": "c.html", "question_number": "faq-7"}),
        (1, 4, {"source_file": "d.txt"}),
    ]
    asked = spark.createDataFrame([(1,), (2,)], "query_id long")
    lines = {r.query_id: r.citations for r in hits.citations(asked, spark.createDataFrame(rows, schema)).collect()}
    assert lines == {1: "a.csv [Product: P1] | b.md [§ Returns] | c.html [faq-7] | d.txt", 2: "No sources"}


def test_lexical_share(spark):
    frame = spark.createDataFrame([("alpha beta beta gamma", "Beta and alpha"), ("", "x")], "a string, b string")
    shown = frame.select(evaluation.lexical_share(F.col("a"), F.col("b")).alias("s")).collect()
    assert [round(r.s, 6) for r in shown] == [round(2 / 3, 6), 0.0] and math.isfinite(shown[1].s)


@pytest.mark.parametrize("block", [None, "n"])
def test_rows_with_null_keys_and_times_stay(spark, block):
    rows = [(None, None, 1, 5), (None, 3, 2, None), (1, None, 3, 7), (1, 4, 4, None), (1, None, 5, 2)]
    frame = spark.createDataFrame(rows, "k long, ts long, id long, v long")
    cut = F.col("ts") if block else None
    found = conversation.split_running(frame, ["k"], ["ts", "id"], cut, lasts=["v"], sums=["v"], number="place").collect()
    assert {r.id: (r.v_so_far, r.v_running, r.place) for r in found} == {
        1: (5, 5, 1), 2: (5, 5, 2), 3: (7, 7, 1), 5: (2, 9, 2), 4: (2, 9, 3),
    }


def test_shares_of_the_null_group(spark):
    frame = spark.createDataFrame([(None, "a", 3.0), (None, "b", 1.0), ("g", "a", 1.0)], "g string, item string, w double")
    for found in (shares.nucleus_share(frame, "g", "item", "w", 1.0), shares.temperature_share(frame, "g", "w", 1.0)):
        assert sorted((str(r.g), r.item, round(r.share, 6)) for r in found.collect()) == [("None", "a", 0.75), ("None", "b", 0.25), ("g", "a", 1.0)]


def test_one_busy_session_is_spread_over_tasks(spark):
    rows = [(0 if i % 10 else i, 5, i) for i in range(5000)]  # nine tenths are one session, all at one time
    frame = spark.createDataFrame(rows, "k long, ts long, id long")
    sizes = conversation.in_parts(frame, ["k"], ["ts", "id"], 8).groupBy("_part").count().collect()
    assert max(r["count"] for r in sizes) < 1500
    found = conversation.split_running(frame, ["k"], ["ts", "id"], number="place").filter("k = 0").collect()
    assert sorted(r.place for r in found) == list(range(1, len(found) + 1))


@pytest.mark.parametrize("page", [2, 3, 1000])
def test_paged_histories_are_whole(messages, page):
    rows, frame = messages
    said = spoken(rows)
    full = conversation.memory_full(frame, page)
    assert full.filter("history = ''").count() == 0
    for r in conversation.with_pages(full, conversation.history_pages(frame, page)).collect():
        before = [line for turn, line, _ in said[r.conv_id] if turn < r.turn]
        assert r.history == ("\n".join(before) if before else conversation.EMPTY_HISTORY)
    once = {(r.conv_id, r.turn): r.history for r in conversation.memory_switch(frame, 6, 1000).collect()}
    paged = conversation.with_pages(conversation.memory_switch(frame, 6, page), conversation.condensed_pages(frame, 6, page))
    assert {(r.conv_id, r.turn): r.history for r in paged.collect()} == once
