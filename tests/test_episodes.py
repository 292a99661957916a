"""Episode rules by cases, and the same over tables and streams."""

import json

from sessionweave.streaming import episodes, ingest

D = "a" * 64
SKILL = {"event_type": "skill_preflight", "skill": "s", "mandatory": True, "read_result": "read", "scope_decision": "in_scope", "content_sha256": D}
TOOLS = {"event_type": "tool_registry", "tools": [{"name": "look"}, {"name": "put", "side_effect_class": "write"}]}
USE = {"event_type": "decision", "decision": "use", "decision_basis": "b", "required_gate_status": "passed", "tool_name": "look"}


def call(i="c1", tool="look", permission="not_required"):
    return {"event_type": "tool_call", "tool_name": tool, "call_id": i, "arguments": {}, "permission_decision": permission}


def seen(i="c1", status="success"):
    return {"event_type": "tool_observation", "call_id": i, "status": status}


CHECK = {"event_type": "verification", "result": "pass", "checks": [1], "durable_evidence": [2]}
END = {"event_type": "terminal", "status": "success"}


def test_a_whole_episode():
    broken, state = episodes.replay([SKILL, TOOLS, USE, call(), seen(), CHECK, END, CHECK], required=("s",))
    assert broken == [None] * 7 + ["episode_ended"] and state["ended"] == "success"


def test_rules():
    cases = [
        ([TOOLS, TOOLS], "registry_assigned_twice"), ([{"event_type": "tool_registry", "tools": [{"name": "a"}, {"name": "a"}]}], "tool_name_duplicated"),
        ([call()], "registry_missing"), ([TOOLS, call()], "use_decision_missing"), ([TOOLS, USE, call(tool="no")], "tool_not_exposed"),
        ([TOOLS, USE | {"required_gate_status": "failed"}, call()], "gate_not_passed"), ([TOOLS, USE | {"tool_name": "put"}, call(tool="put")], "permission_not_granted"),
        ([TOOLS, USE | {"tool_name": "put"}, call(tool="put", permission="granted")], None), ([TOOLS, USE, call(), call()], "call_id_duplicated"),
        ([seen()], "unknown_call"), ([seen(status="unmatched")], None), ([TOOLS, USE, call(), seen(), seen()], "observation_duplicated"), ([END], "verification_missing"),
        ([TOOLS, USE, call(), CHECK, END], "unobserved_calls"), ([TOOLS, USE, CHECK, call(), seen(), END], "verification_before_last_call"),
        ([CHECK | {"result": "fail"}, END], "verification_not_passed"), ([CHECK | {"checks": []}], "pass_without_evidence"), ([SKILL | {"content_sha256": "x"}], "content_digest_missing"),
        ([SKILL | {"read_result": "not_read", "content_sha256": None}], "mandatory_skill_not_read"),
        ([SKILL | {"read_result": "not_read", "content_sha256": None, "mandatory": False}], "optional_skip_without_reason"),
        ([{"event_type": "state_delta", "before": {"a": None}, "after": {"a": "x"}}], "state_not_a_digest"), ([{"event_type": "mcp_health", "server": "m"}], "health_fields"),
        ([{"event_type": "else"}], "unsupported_event_type"), ([USE | {"decision_basis": "x" * 300}], "decision_basis"), ([{"event_type": "terminal", "status": "?"}], "invalid_terminal_status"),
    ]
    assert [episodes.replay(e)[0][-1] for e, _ in cases] == [w for _, w in cases]
    assert episodes.replay([TOOLS, USE], required=("s",))[0][-1] == "required_skill_unread"


def test_limits_end_an_episode():
    broken, state = episodes.replay([TOOLS, USE, call("a"), call("b"), call("c"), call("d")], calls=2)
    assert broken[4:] == ["call_limit", "episode_ended"] and state["ended"] == "bounded_stop"
    guard = {"event_type": "loop_guard", "signature": "x", "state_hash": D}
    broken, state = episodes.replay([guard, guard | {"state_hash": "b" * 64}, guard | {"state_hash": "c" * 64}, guard])
    assert broken == [None, None, None, "episode_ended"]
    text, whole, size, cut = episodes.bounded_text("äb" * 10, 7)
    assert cut and size == 30 and len(text.encode()) <= 7 and len(whole) == 64 and episodes.bounded_text("ab", 7)[3] is False


def test_trace_joins_episode():
    record = {"messages": [{"tool_calls": [{"id": "c1", "function": {"arguments": {}}}]}]}
    trace = [TOOLS, USE, call(), seen(), CHECK]
    assert episodes.join_trace(record, trace) == []
    assert episodes.join_trace({"messages": []}, trace) == ["call_ids_differ"]
    assert episodes.join_trace(record, [TOOLS, call(), USE, CHECK, seen()]) == ["decision_after_call:c1", "verification_before_observation:c1"]


def test_tables_and_streams_agree(spark, tmp_path):
    runs = {"a": [SKILL, TOOLS, USE, call(), seen(), CHECK, END, CHECK], "b": [TOOLS, call(), USE, call(), END], "c": [seen(), TOOLS]}
    rows = [(k, n, json.dumps(e)) for k, es in runs.items() for n, e in enumerate(es)]
    df = spark.createDataFrame(rows, "episode string, ordinal bigint, event string")
    want = {(k, n, b) for k, es in runs.items() for n, b in enumerate(episodes.replay(es)[0])}
    assert {(r.episode, r.ordinal, r.broken) for r in episodes.checked(df).collect()} == want
    for low, high in ((0, 2), (3, 9)):  # two batches, the second after a restart from the checkpoint
        df.filter(f"ordinal between {low} and {high}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        got = ingest.drain(episodes.checked_stream(stream), f"file://{tmp_path}/run")
    assert {(r.episode, r.ordinal, r.broken) for r in got.collect()} == want and got.count() == len(rows)
