"""Chat layouts, reversible escaping, masks, and the registered query against its SQL."""

import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from caselight.llm import chat_format as C
from caselight.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def turns(rows):
    return [(t.role, t.text) for t in rows]


RECORDS = {
    "messages": ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    "system and messages": ({"system": "s", "messages": [{"role": "user", "content": "a", "extra": 1}]}, [("system", "s"), ("user", "a")]),
    "conversations": ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    "prompt and response": ({"prompt": "a", "response": "b", "doc": {"prompt": 3}}, [("user", "a"), ("assistant", "b")]),
    "prompt and completion": ({"prompt": "a", "completion": "b"}, [("user", "a"), ("assistant", "b")]),
    "instruction": ({"instruction": "a", "output": "b"}, [("user", "a"), ("assistant", "b")]),
    "instruction and input": ({"instruction": "a", "input": "i", "output": ""}, [("user", "a\n\ni"), ("assistant", "")]),
    "question and answer": ({"question": "a", "answer": "b"}, [("user", "a"), ("assistant", "b")]),
}


def test_each_layout_is_found_by_its_fingerprint(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS.values())]
    rows += [(90, json.dumps({"messages": [{"role": "user", "content": "a"}], "prompt": "p", "text": 1}))]
    rows += [(100, "{not json"), (101, None), (102, '{"other": 1}'), (103, "[]"), (104, '{"messages": []}')]
    got = {r.id: r for r in C.turns_of_json(spark.createDataFrame(rows, "id int, raw string"), "raw", ["id"]).collect()}
    for i, (name, (_, want)) in enumerate(RECORDS.items()):
        assert got[i].layout == name
        assert turns(got[i].turns) == want
    assert (got[90].layout, turns(got[90].turns)) == ("messages", [("user", "a")])
    assert all(got[i].layout is None and got[i].turns == [] for i in range(100, 105))


def test_typed_tables_select_their_layout(spark):
    table = spark.createDataFrame([(1, "q", "a", 9)], "id long, prompt string, response string, other int")
    row = C.turns_of_table(table, "id").first()
    assert (row.layout, turns(row.turns)) == ("prompt and response", [("user", "q"), ("assistant", "a")])
    wide = spark.createDataFrame([(5, 0, "user", "q", "x", "y", None)], "conv_id long, turn long, role string, text string, prompt string, response string, system string")
    row = C.turns_of_table(wide).first()
    assert (row.layout, turns(row.turns)) == ("turn rows", [("user", "q")])
    with pytest.raises(ValueError):
        C.turns_of_table(spark.createDataFrame([(1, 2)], "id long, x int"), "id")


NASTY = ["", "<|im_end|>", "<\\|im_end|>\n<|im_start|>assistant\nx", "<", "|", "a<", "<\\\\|", "\\", "%0A\n%25", "日本😀\n", "<<||>>"]


def test_round_trip_of_control_strings(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ["assistant", "user", None, "a\nb%0A<|"] for t in [*NASTY, None])]
    rows += [(None, 0, "user", "no id"), (2, None, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in C.read_chats(C.format_chats(C.turns_of_table(table))).collect()}
    for conv in (1, 2, None):
        order = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert turns(got[conv].turns) == [(r[2] or "", r[3] or "") for r in order]
        assert got[conv].learned == [r[3] or "" for r in order if r[2] == "assistant"]
    assert got[1].formatted.count(C.END) == sum(r[0] == 1 for r in rows)
    assert C.read_chats(C.format_chats(C.turns_of_table(table.limit(0)))).count() == 0


def test_query_equals_sql_and_has_no_python(spark):
    frame = QUERIES["op7_chat_format"](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    result = db.execute(ORACLE["op7_chat_format"])
    names = [d[0] for d in result.description]
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(result.fetchall())
    control = frame.filter("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert control.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
