"""Rules of curriculum rows, by cases stated here."""

import json

import pytest

from sessionweave.operators import curriculum as c


def call(name="exec_command", id="c1", **arguments):
    return {"id": id, "type": "function", "function": {"name": name, "arguments": arguments}}


def acts(*calls):
    return {"role": "assistant", "content": "", "tool_calls": list(calls)}


USER = {"role": "user", "content": "please look at it"}


@pytest.mark.parametrize(("told", "want"), [
    ("str", {"type": "string"}), ("int, optional", {"type": "integer"}), ("Dict", {"type": "object"}), ("list", {"type": "array", "items": {}}),
    ("List[float]", {"type": "array", "items": {"type": "number"}}), ("Tuple[int, int]", {"type": "array", "items": {"type": "integer"}}),
    ("Tuple[int, str]", {"type": "array", "items": {}}), ("Union[int, float]", {"type": "number"}), ("Union[str, bool]", {"anyOf": [{"type": "string"}, {"type": "boolean"}]}),
    ("List[Tuple[int, int]]", {"type": "array", "items": {"type": "array", "items": {"type": "integer"}}}),
])
def test_types(told, want):
    assert c.json_type(told) == want
    assert c.reason_of(c.json_type, "bytes") == "tool_property_type_unsupported" and c.reason_of(c.json_type, " ") == "tool_property_type_missing"


def tool(name="find", required=("b",), **fields):
    return json.dumps({"name": name, "parameters": {"properties": fields or {"b": {"type": "int", "description": "x"}, "a": {"type": "str", "enum": ["u"]}}}, "required": list(required)})


def test_tools_and_targets():
    tools = c.native_tools([tool()])
    of = tools[0]["function"]["parameters"]
    assert list(of["properties"]) == ["a", "b"] and of["properties"]["a"] == {"type": "string", "enum": ["u"]} and of["required"] == ["b"]
    reasons = {"tools_missing": [], "tool_name_invalid_or_duplicate": [tool(), tool()], "tool_required_unknown_property": [tool(required=("z",))], "tool_0_invalid_json": ["{"]}
    assert all(c.reason_of(c.native_tools, given) == why for why, given in reasons.items())
    ask = lambda *calls: "<TOOLCALL>" + json.dumps(list(calls)) + "</TOOLCALL>"
    lane, message = c.call_target(ask({"name": "find", "arguments": {"b": 3}}), tools, 7)
    assert lane == "tool_call" and message["tool_calls"][0]["id"] == "call_r00007_c00"
    assert c.call_target("Which one?", tools, 0)[0] == "clarify" and c.call_target("It is four.", tools, 0)[0] == "no_tool"
    bad = {
        "chosen_toolcall_missing_required": {"a": "u"}, "chosen_toolcall_unknown_argument": {"b": 1, "q": 2}, "chosen_toolcall_argument_type": {"b": True},
    }
    assert all(c.reason_of(c.call_target, ask({"name": "find", "arguments": a}), tools, 0) == why for why, a in bad.items())
    assert c.reason_of(c.call_target, ask({"name": "no", "arguments": {}}), tools, 0) == "chosen_toolcall_unknown_tool"
    assert c.reason_of(c.call_target, "x" * 601, tools, 0) == "chosen_response_too_long"


def test_schema_match():
    number = {"type": "number"}
    assert c.conforms(1.5, number) and c.conforms(1, number) and not c.conforms(True, number) and not c.conforms("1", number)
    assert c.conforms([1, 2], {"type": "array", "items": {"type": "integer"}}) and not c.conforms([1, "x"], {"type": "array", "items": {"type": "integer"}})
    assert c.conforms("x", {"anyOf": [number, {"type": "string"}]}) and c.conforms(object, {}) and not c.conforms(1, {"type": "null"})


BASH = [json.dumps({"function": {"name": "bash", "parameters": {"properties": {"command": {}}}}})]
END = "COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"


def bash(command):
    return {"function": {"name": "bash", "arguments": json.dumps({"command": command})}}


def run(*commands, told=None):
    out = [{"role": "assistant", "content": "hm", "tool_calls": [bash(x) for x in commands]}]
    return out + [{"role": "tool", "content": f"out {k}"} for k in range(len(commands) if told is None else told)]


def test_trajectories():
    wrapped = f"<instructions>x</instructions> <pr_description> Fix the bug </pr_description> {END}"
    row = {"tools": BASH, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": wrapped}, *run("ls", "cat a"), *run("pytest"), *run(f"echo {END}", told=0)]}
    of = c.trajectory(row, END)
    assert of["base"][1]["content"] == "Repository task:\n\nFix the bug" and of["ended"] and len(of["turns"]) == 2
    assert [x["tool_call_id"] for x in of["turns"][0]["observations"]] == ["call_a0000_c00", "call_a0000_c01"]
    whole, cut = c.bounded_prompt(of, 1, 10_000)
    assert not cut and len(whole) == 2 + 3 + 1
    short, cut = c.bounded_prompt(of, 1, len(c.canonical({"messages": whole, "tools": of["tools"]})) - 1)
    assert cut and len(short) == 3
    start = row["messages"][:2]
    bad = {
        "observation_missing": [*run("ls", told=0), *run("ls")], "observation_join_ambiguous": run("ls", told=2), "nonterminal_text_action": [{"role": "assistant", "content": "done"}, *run("ls")],
        "tool_actions_missing": [{"role": "assistant", "content": "done"}], "unexpected_message_order": [*run("ls"), USER], "bash_command_missing": run(""),
        "visible_reasoning_marker": [{"role": "assistant", "content": "<thinking>x"}],
    }
    assert {why: c.reason_of(c.trajectory, row | {"messages": start + more}, END) for why, more in bad.items()} == {why: why for why in bad}
    assert c.reason_of(c.trajectory, row | {"tools": [json.dumps({"function": {"name": "python", "parameters": {}}})]}, END) == "unsupported_source_tool"


@pytest.mark.parametrize(("script", "reads"), [
    ("ls -la && cat x | head", True), ("cd a; git status", True), ("git push", False), ("sed -n 1,5p f", True), ("sed -i s/a/b/ f", False), ("echo x > f", False),
    ("rg foo 2>/dev/null", True), ("python x.py", False), ("A=1 grep a b", True), ("cat $(ls)", False), ("", False), ("grep 'unclosed", False),
])
def test_read_only_scripts(script, reads):
    assert c.only_reads(script) is reads
    assert c.call_reads(call(cmd=["bash", "-lc", script])) is (reads and bool(script))
    assert not c.call_reads(call("read_file", cmd=script))


def test_action_policy():
    fix, look = {"role": "user", "content": "fix the parser"}, {"role": "user", "content": "explain the parser"}
    change, read = acts(call(cmd="sed -i s/a/b/ x")), acts(call(cmd="ls"))
    assert c.action_policy([fix, read, change]) is None and c.action_policy([fix, change, change]) == "target_repeats_prior_call"
    assert c.action_policy([look, change]) == "target_mutation_intent_unproven"
    assert c.action_policy([fix, {"role": "user", "content": "but do not edit files"}, change]) == "target_violates_no_mutation_instruction"
    assert c.call_changes(call("apply_patch")) and not c.call_changes(call("read_file")) and not c.call_changes(call(cmd="ls 2>/dev/null"))


def test_prompts_split_into_turns():
    seen = {"role": "tool", "content": json.dumps({"returncode": 0}), "tool_call_id": "c1"}
    base, turns = c.split_prompt([USER, acts(call(cmd="ls")), seen, acts(call("apply_patch", "c2"))])
    assert base == [USER] and [(t["complete"], t["read_only"]) for t in turns] == [(True, True), (False, False)]
    assert c.reason_of(c.split_prompt, [acts(call())]) == "cycle_prompt_base_invalid" and c.reason_of(c.split_prompt, [USER, seen]) == "cycle_prompt_action_order_invalid"
    prompt = [USER, acts(call(cmd="ls")), seen, acts(call(cmd="cat")), seen]
    assert c.repeat_distance(prompt, acts(call(id="other", cmd="ls"))) == 2 and c.repeat_distance(prompt, acts(call(cmd="no"))) is None
    assert c.strict_status(prompt, 3) == "explicit_success" and c.strict_status(prompt, 4) == "unknown"
    failed = [USER, acts(call()), {"role": "tool", "content": '{"returncode": 2}'}]
    assert c.strict_status(failed, 1) == "explicit_failure" and c.strict_status([USER, acts(call()), {"role": "tool", "content": "fine"}], 1) == "unknown"


def test_negatives_and_pairs():
    example = {"messages": [USER, acts(call(cmd="ls")), {"role": "tool", "content": "x", "tool_call_id": "c1"}, {"role": "assistant", "content": "done"}], "tools": [{"function": {"name": n}} for n in ("apply_patch", "finish_task")]}
    assert c.negative(example, "skill_route")[1] == "bypasses_required_skill" and c.negative(example, "else")[1].startswith("repeats_observed")
    want = {
        "skill_apply": "premature_stop_before_required_work", "read_only_report": "permission_read_only_boundary", "blocker_holdout": "blocker_over_false_completion",
        "verified_finish": "verified_finish_over_unnecessary_continuation", "no_repeat_alternate": "post_error_changed_recovery",
        "bounded_termination": "verified_finish_over_unnecessary_continuation",
    }
    assert {k: c.family_negative(example, k)[1] for k in want} == want
    assert c.family_negative(example, "verified_finish")[0]["tool_calls"][0]["id"] == "call-rejected-00"
    assert c.reason_of(c.family_negative, example | {"tools": []}, "read_only_report") == "read_only_negative_requires_apply_patch"
    assert c.reason_of(c.family_negative, example, "new kind") == "no_policy_negative:new kind"
    made = c.pair("train", "skill", [USER], example["messages"][-1], c.made_call("x"), [], {"row": 1})
    assert made["pair_id"] == c.pair("train", "skill", [USER], example["messages"][-1], c.made_call("x"), [], {"row": 1})["pair_id"]
    assert c.reason_of(c.pair, "train", "skill", [USER], c.DONE, dict(c.DONE), [], {}) == "branches_equal"


def test_examples():
    schema = {"function": {"name": "find", "parameters": {"properties": {"q": {}}, "required": ["q"], "additionalProperties": False}}}
    good = {"schema_version": c.EXAMPLE_SCHEMA, "example_id": "e", "split": "train", "lane": "skill_policy", "messages": [USER, acts(call("find", q=1))], "tools": [schema]}
    assert c.reason_of(c.check_example, good, "train") is None
    bad = {
        "unsupported_columns": {"reward": 1}, "split_mismatch": {"split": "validation"}, "lane_invalid": {"lane": "x"}, "identity_missing": {"example_id": ""},
        "tool_call_without_schema": {"messages": [USER, acts(call("other", q=1))]}, "tool_call_missing_required_argument": {"messages": [USER, acts(call("find"))]},
        "tool_call_undeclared_argument": {"messages": [USER, acts(call("find", q=1, z=2))]}, "tool_call_id_duplicated": {"messages": [USER, acts(call("find", q=1), call("find", q=2))]},
        "target_not_assistant": {"messages": [USER, USER]}, "tool_schema_malformed_or_duplicated": {"tools": [schema, schema]}, "message_role_invalid": {"messages": [{"role": "x", "content": ""}, USER]},
    }
    assert {why: c.reason_of(c.check_example, good | more, "train") for why, more in bad.items()} == {why: why for why in bad}


def test_visible_rows():
    import re

    brand = {"brand": re.compile("acme")}
    view = lambda **more: {"messages": [USER], **more}
    assert c.visible_rejection(view(), 500, brand) is None and c.visible_rejection(view(), 5, brand) == "visible_character_limit"
    cases = {"brand": view(x="acme"), "reasoning_field": view(thoughts="x"), "privacy_firewall": view(password="x"), "reasoning_marker": view(x="a <thinking> b")}
    assert {k: c.visible_rejection(v, 500, brand) for k, v in cases.items()} == {k: k for k in cases}
    assert c.reason_of(c.clean_text, {"a": [{"Chain-of-thought": 1}]}) == "reasoning_field_survived" and c.reason_of(c.clean_text, {"a": "private scratchpad"}) == "reasoning_marker_survived"
    assert c.reason_of(c.protocol_absent, ["<INSTRUCTIONS>"]) == "source_protocol_survived" and c.reason_of(c.protocol_absent, {"a": "x"}) is None


def test_projections():
    row = {"messages": [USER, acts(call("find", q=1))], "events": [{"kind": "action", "call_id": "c"}]}
    assert c.tool_activity(row) and c.reason_of(c.trainer_view, row) == "tool_schemas_invalid"
    safe = c.loader_safe(row)
    assert safe["messages"][1]["tool_calls"][0]["function"]["arguments"] == '{"q":1}' and safe["events"] == ['{"call_id":"c","kind":"action"}']
    raw = [USER, acts(call("find"))]
    raw[1]["tool_calls"][0]["function"]["arguments"] = '{"q": 1}'
    assert c.strict_messages(raw)[1]["tool_calls"][0]["function"]["arguments"] == {"q": 1}
    for text, why in (('{"q": 1, "q": 2}', "duplicate_argument_key"), ('{"q": NaN}', "non_finite_number"), ("{", "arguments_invalid_json"), ("[1]", "arguments_not_object")):
        raw[1]["tool_calls"][0]["function"]["arguments"] = text
        assert c.reason_of(c.strict_messages, raw) == why
    window = {"context": {"messages": [USER, acts(call("find", q=1))]}, "tool_call": {"name": "find"}, "observation": {"status": "success"}}
    assert c.prompt_completion(window)[0] == [USER] and c.reason_of(c.prompt_completion, window | {"observation": None}) == "observation_not_success"
    answer = {"role": "assistant", "content": "It is done. " * 20}
    assert c.final_answer([USER, answer])[0] == [USER] and c.reason_of(c.final_answer, [USER, answer | {"content": "x" * 300 + "..."}]) == "answer_incomplete"
    events = [{"event_id": k, "ordinal": k, "kind": kind, "call_id": "c"} for k, kind in enumerate(("action", "observation"))]
    assert c.event_summary(events)["calls"] == 1 and c.reason_of(c.event_summary, events[:1]) == "call_and_observation_sets_differ"
    assert c.reason_of(c.event_summary, [events[0], events[0]]) == "event_ids_not_unique"
    skills = [{"name": "read-first", "description": "Read before you write."}]
    assert c.reason_of(c.skill_output, skills, 1) is None and c.reason_of(c.skill_output, skills, 2) == "skill_count" and c.reason_of(c.skill_output, [{"name": "X"}], 1) == "skill_name"
