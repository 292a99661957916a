"""Provider records to messages."""

import json

from pyspark.sql import functions as F

from sessionweave.operators import normalize
from sessionweave.sources import jsonl, providers


def test_messages(spark):
    records = [
        {"messages": [
            {"role": "human", "content": "hi"}, {"role": "agent", "content": [{"type": "thinking", "text": "no"}, {"type": "text", "text": "a"}, "b"]},
            {"role": "assistant", "content": "", "tool_calls": [{"id": "c1", "function": {"name": "run", "arguments": "{\"x\": 1}"}}, {"input": {"y": 2}}]},
            {"role": "tool", "content": "", "tool_call_id": "c1"}, {"role": "robot", "content": "drop"}, {"role": "user", "content": ""}, 7,
        ]},
        {"history": [{"role": "user", "content": {"rawText": "old"}}]}, {"other": 1},
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "k int, t string").select("k", F.parse_json("t").alias("record"))
    out = [(r.k, r.role, r.text, [tuple(c) for c in r.calls], r.answers) for r in normalize.messages(df).orderBy("k", "position").collect()]
    assert out == [
        (0, "user", "hi", [], None), (0, "assistant", "a\nb", [], None),
        (0, "assistant", "", [("c1", "run", '{"x": 1}'), (None, "unknown", '{"y":2}')], None), (0, "tool", "", [], "c1"), (1, "user", "old", [], None),
    ]


def test_status(spark):
    rows = [("boom", 0, None), (None, 0, None), (None, 1, "success"), (None, None, "success"), (None, None, None)]
    value, source = normalize.status(F.col("e"), F.col("c"), F.col("s"))
    got = spark.createDataFrame(rows, "e string, c int, s string").select(value.alias("v"), source.alias("w")).collect()
    assert [tuple(r) for r in got] == [
        ("failure", "error"), ("success", "return_code"), ("unknown", "conflicting_structured_evidence"), ("success", "status"), ("unknown", "absent"),
    ]


def test_clean_json(spark):
    df = spark.createDataFrame([('{"b": [{"thinking": 1, "c": 2}], "reasoning": "x"}',), ("{bad",), (None,)], "j string")
    assert [tuple(r)[1:] for r in normalize.clean_json(df, "j").collect()] == [('{"b":[{"c":2}]}', 2), (None, 0), (None, 0)]


def test_providers(spark, tmp_path):
    one = [
        {"type": "event_msg", "timestamp": "1", "payload": {"type": "user_message", "message": "do it"}},
        {"type": "response_item", "timestamp": "2", "payload": {"type": "function_call", "call_id": "c", "name": "run", "arguments": "{}"}},
        {"type": "response_item", "timestamp": "3", "payload": {"type": "function_call_output", "call_id": "c", "output": "done"}},
        {"type": "other", "timestamp": "4", "payload": {"type": "noise"}},
    ]
    (tmp_path / "one.jsonl").write_text("\n".join(map(json.dumps, one)))
    got = providers.rollout(jsonl.strict(spark, str(tmp_path / "one.jsonl"))).orderBy("position").collect()
    assert [(r.role, r.text, len(r.calls), r.answers) for r in got] == [("user", "do it", 0, None), ("assistant", "", 1, None), ("tool", "done", 0, "c")]
    two = [
        {"type": "user", "sessionId": "s", "timestamp": "1", "message": {"content": "go"}},
        {"type": "assistant", "sessionId": "s", "timestamp": "2", "message": {"content": [{"type": "text", "text": "ok"}, {"type": "tool_use", "id": "t", "name": "run", "input": {}}]}},
        {"type": "user", "sessionId": "s", "timestamp": "3", "message": {"content": [{"type": "tool_result", "tool_use_id": "t", "content": "out"}]}},
    ]
    (tmp_path / "two.jsonl").write_text("\n".join(map(json.dumps, two)))
    got = providers.turns(jsonl.strict(spark, str(tmp_path / "two.jsonl"))).orderBy("position").collect()
    assert [(r.role, r.text, len(r.calls), r.answers) for r in got] == [("user", "go", 0, None), ("assistant", "ok", 1, None), ("tool", "out", 0, "t")]
