"""Stores of editors and agents, built here and read back."""

import json
import struct

from pyspark.sql import functions as F

from sessionweave.sources import editors


def rows(df):
    return [json.loads(r.conversation) for r in df.collect()]


def kv(spark, pairs):
    data = [("w1", k, v if isinstance(v, str) or v is None else json.dumps(v)) for k, v in pairs]
    return spark.createDataFrame(data, "workspace string, key string, value string")


SELECTED = {"selections": [{"uri": {"fsPath": "/a.py"}, "text": "x = 1"}, {"uri": {}}]}


def test_chat_tabs(spark):
    tab = {"chatTitle": "t", "tabId": 7, "bubbles": [{"type": "user", "rawText": "hi", **SELECTED}, {"type": "ai", "text": "yo", "suggestedDiffs": [1]}]}
    got = rows(editors.chat_tabs(kv(spark, [(editors.CHAT_KEY, {"tabs": [tab, {"bubbles": []}]}), ("other", {"tabs": [tab]})]), ["workspace"]))
    assert len(got) == 1 and got[0]["has_diffs"] and got[0]["messages"][0]["code_context"][0]["file"] == "/a.py" and got[0]["messages"][1]["content"] == "yo"
    store = kv(spark, [("chat.data", {"tabs": [tab]}), ("cascade.chatdata", {"tabs": [tab, tab]})])
    assert len(rows(editors.first_chat(store, ["workspace"]))) == 1


def test_composers(spark):
    bubbles = [{"type": 1, "text": "q", "context": SELECTED}, {"type": 2, "text": "a", "modelId": "m1", "suggestedCodeBlocks": [1]}, {"type": 9}]
    got = rows(editors.workspace_composers(kv(spark, [("composer.composerData", {"allComposers": [{"composerId": "c", "conversation": bubbles, "modelConfig": {"modelName": "big"}}, 3]})]), ["workspace"]))
    assert got[0]["model"] == "big" and [m["role"] for m in got[0]["messages"]] == ["user", "assistant"] and got[0]["messages"][1]["model"] == "big"
    store = kv(spark, [
        ("composerData:c1", {"composerId": "c1", "conversation": bubbles}), ("composerData:c2", {"name": "n"}), ("composerData:c3", None),
        ("bubbleId:c2:b2", bubbles[1]), ("bubbleId:c2:b1", bubbles[0]), ("bubbleId:c1:b1", bubbles[0]),
    ])
    got = {c["messages"][0]["content"] + c.get("name", ""): c for c in rows(editors.global_composers(store, ["workspace"]))}
    assert len(got) == 2 and all(len(c["messages"]) == 2 and c["messages"][1]["model"] == "m1" for c in got.values())
    agents = kv(spark, [("agentData:1", {"conversation": bubbles}), ("my.flow.x", {"messages": [{"role": "user", "content": "z"}]}), ("none", {"messages": [{"role": "user"}]})])
    assert sorted(len(c["messages"]) for c in rows(editors.agent_chats(agents, ["workspace"]))) == [1, 3]


def test_prompts_pair_by_place(spark):
    store = kv(spark, [("aiService.prompts", [{"text": "a", "commandType": 4}, {"text": "b"}]), ("aiService.generations", [{"message": "x", "modelId": "m"}])])
    got = sorted(rows(editors.service_prompts(store, ["workspace"])), key=lambda c: c["messages"][0]["content"])
    assert [len(c["messages"]) for c in got] == [2, 1] and got[0]["model"] == "m" and got[0]["messages"][0]["command_type"] == 4


def test_blob_trees(spark):
    ids = {n: bytes([k]) * 32 for k, n in enumerate(("root", "left", "m1", "m2", "m3"))}
    ref = lambda *names: b"\x01" + b"".join(b"\x0a\x20" + ids[n] for n in names)
    say = lambda t: json.dumps({"role": "user", "content": t}).encode()
    data = {"root": ref("left", "m3", "root"), "left": ref("m1", "m2", "m1"), "m1": say("1"), "m2": say("2"), "m3": say("3")}
    blobs = spark.createDataFrame([("s", ids[n].hex(), bytearray(v)) for n, v in data.items()], "store string, id string, data binary")
    meta = spark.createDataFrame([("s", json.dumps({"latestRootBlobId": ids["root"].hex()}).encode().hex())], "store string, value string")
    roots = meta.select("store", F.get_json_object(editors.hex_json(F.col("value")), "$.latestRootBlobId").alias("root"))
    got = editors.blob_messages(blobs, roots).orderBy("place").collect()
    assert [json.loads(r.message)["content"] for r in got] == ["1", "2", "3"]


def test_session_files(spark):
    item = {"message": {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}], "toolCalls": [1]},
            "toolCallStates": [{"status": "done", "output": "o", "tool": {"function": {"name": "f"}}}, {"status": "running", "output": "p"}]}
    got = json.loads(next(editors.continue_session({"sessionId": "s", "history": [item, {}]}))["conversation"])
    assert got["messages"] == [{"role": "assistant", "content": "a\nb", "tool_calls": [1], "tool_results": [{"tool": "f", "output": "o"}]}]
    lines = [{"type": "metadata", "data": {"project": "p"}}, {"type": "user_message", "message": "q", "files": ["f"]}, {"role": "agent", "content": "r", "edits": [1]}, {"type": "noise"}]
    got = json.loads(next(editors.trae_lines(lines))["conversation"])
    assert got["project"] == "p" and [m["role"] for m in got["messages"]] == ["user", "assistant"] and got["messages"][1]["edits"] == [1]
    store = kv(spark, [("x.Chat.y", {"conversation": [{"role": "user", "content": "c"}, {"no": 1}], "title": "t"}), ("z", {"messages": [{"role": "user"}]})])
    got = rows(editors.trae_store(store, ["workspace"]))
    assert len(got) == 1 and got[0]["title"] == "t" and len(got[0]["messages"]) == 1


def test_event_sourced_sessions(spark):
    call = {"id": "t1", "name": "run", "args": {"a": 1}, "result": "kept"}
    answer = {"functionResponse": {"id": "t2", "name": "look", "response": {"o": 1}}}
    events = [
        {"sessionId": "s"}, {"$set": {"messages": [{"id": "m", "type": "gemini", "content": "x", "toolCalls": [call, {"id": "t2", "name": "look", "result": "twice"}]}]}},
        {"$set": {"lastUpdated": "now", "messages": [{"type": "user", "content": [{"text": "go"}, answer, answer]}, {"id": "m", "type": "gemini", "content": "x"}]}}, {"type": "user", "content": "loose"},
    ]
    df = spark.createDataFrame([("f", k, json.dumps(e)) for k, e in enumerate(events)] + [("f", 9, "{bad")], "file string, place int, value string")
    record = json.loads(editors.gemini_sessions(df, "file", "place", "value").first().record)
    assert record["sessionId"] == "s" and record["lastUpdated"] == "now" and len(record["messages"][1]["toolCalls"]) == 2
    got = editors.gemini_messages(record)
    assert [(m["role"], m.get("tool_call_id")) for m in got] == [("user", None), ("tool", "t2"), ("assistant", None), ("tool", "t1")]


def test_part_stores(spark):
    one = lambda **v: json.dumps(v)
    messages = spark.createDataFrame([(one(id="m1", sessionID="s", role="user", time={"created": 1}),), (one(id="m2", sessionID="s", role="assistant", time={"created": 2}),)], "value string")
    parts = spark.createDataFrame([(one(id="p1", messageID="m1", type="text", text="hello"),), (one(id="p2", messageID="m2", type="reasoning", text="no"),),
        (one(id="p3", messageID="m2", type="tool", callID="c", tool="run", state={"input": {"a": 1}, "output": "out", "status": "completed"}),), (one(id="p4", messageID="m2", type="patch", hash="h"),),
        (one(id="p5", messageID="m2", type="tool", callID="d", tool="run", state={"error": "bad"}),)], "value string")
    sessions = spark.createDataFrame([(one(id="s", title="t", time={"created": 5}),)], "value string")
    got = {r.message: r for r in editors.json_store(sessions, messages, parts).collect()}
    m2 = got["m2"]
    assert got["m1"].content == "hello" and got["m1"].place == 0 and m2.messages == 2 and m2.title == "t" and m2.omitted_reasoning == 1 and m2.diffs == ["h"]
    assert [(c.id, c.name) for c in m2.tool_calls] == [("c", "run"), ("d", "run")] and [(r.status, r.output) for r in m2.tool_results] == [("completed", "out"), ("error", "bad")]
    m = spark.createDataFrame([("s", "m", 1, "assistant")], "session string, message string, at bigint, role string")
    p = spark.createDataFrame([("m", 1, "p", one(type="tool", callID="c", tool="x", state={"output": "short", "metadata": {"outputPath": "/t/out-1.txt"}}))], "message string, at bigint, part string, data string")
    files = spark.createDataFrame([("/t/out-1.txt", "whole"), ("/t/other.txt", "no")], "path string, output string")
    outputs = editors.referenced_outputs(p, files)
    assert [tuple(r) for r in outputs.collect()] == [("c", "/t/out-1.txt", "whole")]
    assert editors.fold_parts(m, p, outputs.select("call", "output")).first().tool_results[0].output_source == "external_tool_output"
    names = spark.createDataFrame([("out-1.txt",), ("gone.txt",)], "name string")
    assert [r.name for r in editors.names_in(p, names).collect()] == ["out-1.txt"]
    side = editors.sidecars(spark.createDataFrame([("/x/s.json",), ("/x/q.json",)], "path string"), spark.createDataFrame([("s",)], "session string"))
    assert {r.path: r.session for r in side.collect()} == {"/x/s.json": "s", "/x/q.json": None}
    ledger = editors.emission_ledger(spark.createDataFrame([("/o/storage/part/1",), ("/o/tool-output/2",)], "path string"), spark.createDataFrame([("/o/storage/part/1",)], "path string"))
    assert {r["class"]: r.status for r in ledger.collect()} == {"conversation_store": "emitted", "tool_output": "not_emitted"}


def test_desktop_store():
    pair = lambda k, v: struct.pack("<I", len(k)) + k + struct.pack("<I", len(v)) + v
    data = pair(b"a", b'{"x": 1}') + pair(b"b", b"{bad") + pair(b"c", b"[1]") + struct.pack("<I", 10**6)
    assert editors.desktop_store(data) == {"a": '{"x":1}', "c": "[1]"} and editors.desktop_store(b"\x01") == {}


def test_logs(spark):
    say = lambda role, content, **more: json.dumps({"type": "message", "message": {"role": role, "content": content, **more}})
    lines = [json.dumps({"type": "session", "id": 4}), say("user", "do"), say("assistant", [{"type": "thinking"}, {"type": "toolCall", "id": "c1", "name": "run"}, {"type": "toolCall", "id": "c2", "name": "run"}], model="m"),
             say("toolResult", "out", toolCallId="c1"), say("toolResult", "?", toolCallId="zz", isError=True), "{bad", json.dumps({"type": "custom", "customType": "session_end"})]
    seen = editors.inspect_log(lines)
    assert (seen["session_id"], seen["messages"], seen["calls"], seen["unmatched_calls"], seen["unmatched_observations"], seen["errors"], seen["parse_errors"]) == ("4", 4, 2, 1, 1, 1, 1)
    assert seen["terminal_signals"] == 1 and seen["omitted_reasoning"] == 1 and seen["models"] == ["m"]
    gate, flags = editors.log_gate(seen)
    assert gate == "quarantine" and "unmatched_tool_calls" in flags and editors.log_gate(editors.inspect_log(lines[:2] + [say("assistant", "ok")]))[0] == "candidate"
    assert editors.log_mode([{"type": "response_item", "payload": {"type": "message"}}]) == "native" and editors.log_mode([{"type": "event_msg", "payload": {"type": "user_message"}}]) == "legacy"
    data = [("s", 0, "user", "q", None), ("s", 1, "assistant", "a", None), ("s", 2, "assistant", "", "c1"), ("s", 3, "tool", "o", None), ("s", 4, "assistant", "b", None), ("s", 5, None, "x", None)]
    df = spark.createDataFrame(data, "session string, place int, r string, b string, c string")
    got = editors.turn_islands(df, "session", "place", F.col("r"), F.col("b"), F.when(F.col("c").isNotNull(), F.array("c"))).orderBy("turn").collect()
    assert [(r.role, r.text, r.calls) for r in got] == [("user", "q", []), ("assistant", "a", ["c1"]), ("tool", "o", []), ("assistant", "b", [])]
