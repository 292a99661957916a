"""Rows for reviews and training, by stated cases."""

import json

import pytest
from pyspark.sql import functions as F

from sessionweave.operators import curriculum, projections as p

USER = {"role": "user", "content": "look"}


def call(i, cmd):
    return {"id": i, "type": "function", "function": {"name": "exec_command", "arguments": {"cmd": cmd}}}


def act(i, cmd):
    return [{"role": "assistant", "content": "", "tool_calls": [call(i, cmd)]}, {"role": "tool", "content": "o", "tool_call_id": i}]


def test_told_preferences():
    of = p.preference({"session_id": "s", "messages": [USER, {"role": "assistant", "content": "x"}], "chosen": "good", "rejected_response": {"content": "bad"}})
    assert of["prompt"][0]["content"] == "look" and of["chosen"] == [{"role": "assistant", "content": "good"}] and of["rejected"][0]["content"] == "bad"
    told = p.preference({"preference": {"prompt": "ask", "chosen": {"messages": [{"role": "agent", "content": "a"}]}, "rejected": "b"}})
    assert told["prompt"] == [{"role": "user", "content": "ask"}] and told["chosen"][0]["role"] == "assistant"
    assert p.preference({"chosen": "a"}) is None and p.preference({"prompt": "", "chosen": "a", "rejected": "b"}) is None


BINDING = {"id": "s1", "sha256": "f" * 64, "provider": "codex"}


def salvaged(**more):
    return {"dataset": "sft", "messages": [USER, {"role": "assistant", "content": "a"}], "metadata": {"provider": "codex", "model": "gpt-5", "parent_record_sha256": "p"},
            "quality": {"session_quality_gate": "candidate"}} | more


def test_salvage():
    row = salvaged()
    of = p.context(row, BINDING, 3, "r")
    assert (of["tier"], of["gate"], of["lane"], of["parent"], of["parent_basis"], of["provider"]) == ("tier1_frontier", "candidate", "primary", "p", "parent_record_sha256", "codex")
    view, why = p.sft_candidate(row, of)
    assert view["split"] == "pending" and why == ["sft_candidate_eligible"]
    bad = salvaged(dataset="rl", password="x", events=[{"kind": "action"}])
    assert p.sft_candidate(bad, of | {"gate": "quarantine"})[1] == ["dataset_not_sft", "hard_privacy_finding", "quality_gate_not_candidate", "tool_activity_not_sft"]
    events = [{"kind": "action", "call_id": "c", "name": "run", "input": '{"workdir": "/w", "path": ""}'}, {"kind": "action", "call_id": "c", "name": "see"}, {"kind": "observation", "call_id": "c", "output": 1}]
    pairs = p.event_pairs(events)
    assert [x["observed"] for x in pairs] == [True, False]
    review = p.tool_review(salvaged(events=events), of, "train")
    assert json.loads(review["event_pairs_json"]) == pairs and review["training_authorized"] is False
    task = p.queue_row(salvaged(events=events, example_id="e"), "{}", "m", "train", {"run"})
    assert task["candidates"] == ["run"] and task["registry_status"] == "name_candidate_unbound" and "observation_edges_incomplete" in task["blockers"]
    assert p.queue_row({}, "{}", "m", "train", None)["registry_status"] == "not_provided"
    done = p.replay_task(task, {"run"})
    assert done["workspaces"] == ["/w"] and done["binding"] == "blocked_call_identity_unbound" and p.replay_task(task, set())["reasons"][0] == "privacy_review_required"


def test_reprojection_and_candidates():
    example = {"schema_version": curriculum.EXAMPLE_SCHEMA, "example_id": "e", "split": "train", "lane": "skill_policy", "messages": [USER, {"role": "assistant", "content": "a"}]}
    out, line = p.reproject(example, {"parent_id": "x"}, "open", "m")
    assert out["example_id"] != "e" and line["parent_id"] == "open:x" and line["source_example_id"] == "e"
    assert curriculum.reason_of(p.reproject, example, {}, "open", "m") == "source_parent_identity_missing"
    row = {"messages": [USER, {"role": "assistant", "content": "It is so. " * 30}], "events": []}
    made, why = p.historical_candidate(row, "train")
    assert why is None and made["calls"] == 0 and p.historical_candidate({"messages": [USER]}, "train")[1] == "terminal_answer_missing"
    window = {"context": {"messages": [USER, act("c", "ls")[0]]}, "tool_call": {"name": "exec_command"}, "observation": {"status": "success"}}
    assert p.trainer_example(window, "00000000" + "a" * 56)["split"] == "validation" and p.trainer_example(window, "0000000b" + "a" * 56)["split"] == "train"
    assert json.loads(p.rendered({"model": "m", "messages": [{"role": "human", "content": "a@b.org"}]})) == {"messages": [{"content": "<PRIVATE_EMAIL>", "role": "user"}], "model": "m"}
    assert p.rendered({"messages": []}) is None
    assert p.without_root({"a": ["/w/repo/x.py", "/w/repo"]}, "/w/repo/") == {"a": ["x.py", "."]}
    case = {"prompt": "do", "skill": "s", "tools": ["read_skill"], "split": "train", "target": {"role": "assistant", "content": "ok"}}
    made = list(p.skill_rows([case], {"s": "text"}, {"read_skill": {"properties": {"name": {}}, "required": ["name"]}}))
    assert made[0]["messages"][2]["content"] == "text" and made[0]["example_id"].startswith("sha256:")


def test_cycles():
    row = {"example_id": "e", "split": "train", "tools": [], "messages": [USER, *act("c1", "ls"), *act("c2", "cat a"), *act("c3", "rg x"), act("c4", "wc a")[0]]}
    source = {"selection_categories": ["first_mutation"], "outcome": "resolved", "parent_id": "p"}
    size = lambda messages: len(messages)
    made, line = p.cycle_pair(row, source, 2, size, 100)
    assert line["family"] == p.CYCLES[2] and line["kept_turns"] == 3 and made["rejected"][0]["tool_calls"][0]["id"] == "call-rejected-00"
    assert p.cycle_pair(row, source, 2, size, 6)[1]["kept_turns"] == 2
    assert [why for _, _, why in p.cycle_candidates(row, source, size, 4)] == [None, "no_turns_fit", "no_turns_fit"]
    bad = {"source_outcome_not_resolved": {"outcome": "open"}, "chosen_action_not_progress_backed": {"selection_categories": []}}
    assert all(curriculum.reason_of(p.cycle_pair, row, source | more, 1, size, 100) == why for why, more in bad.items())
    change = row | {"messages": [USER, *act("c1", "rm a"), act("c4", "wc a")[0]]}
    assert curriculum.reason_of(p.cycle_pair, change, source, 1, size, 100) == "cycle_path_contains_mutation"
    assert curriculum.reason_of(p.cycle_pair, change, source, 3, size, 100) == "insufficient_prior_actions"


def test_packages(spark):
    chosen = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (9, "d", "w")], "place int, sha string, projection string")
    raw = spark.createDataFrame([(1, "a", "X"), (2, "B", "Y"), (3, "c", "Q")], "place int, sha string, v string")
    got = {r.place: r.reason for r in p.rejoined(chosen, raw, "place", "sha", F.lower("v")).collect()}
    assert got == {1: None, 2: "source_row_changed", 3: "projection_changed", 9: "source_row_missing"}
    pairs = spark.createDataFrame([("p1",), ("p2",)], "pair_id string")
    lines = spark.createDataFrame([("p1", "skill"), ("p2", "cycle")], "pair_id string, source_partition string")
    assert [r.pair_id for r in p.inherited(pairs, lines, ["skill"]).collect()] == ["p1"]
    a = spark.createDataFrame([(1, "m"), (2, "n")], "id int, parent string").withColumn("split", F.lit("old"))
    union, faults = p.composed({"one": a, "two": a.filter("id = 2")}, spark.createDataFrame([("m", "train")], "parent string, split string"))
    assert union.count() == 3 and sorted(r.reason for r in faults.collect()) == ["id_duplicated", "parent_without_split"]
    package = spark.createDataFrame([(1, "m", "train", None), (1, "m", "validation", 0.5)], "id int, parent string, split string, reward double")
    assert {r.reason for r in p.package_faults(package, {"records": 3}, package.columns).collect()} == {"record_count_differs", "id_repeated", "reward_present", "parent_in_two_splits"}
    assert p.package_faults(package.limit(1), {"records": 1}, [*package.columns, "x"]).first().reason == "columns_differ"
    names = spark.createDataFrame([(["b", "a", "z"],)], "names array<string>")
    assert p.named_in(names, {"a", "b"}).first().matches == ["a", "b"] and p.plain_name("Read It!") == "read-it"
    with pytest.raises(p.Refused):
        p.need(False, "x")
