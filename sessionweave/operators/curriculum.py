"""Curriculum rows: tool schemas and calls checked against them, prompts, policies, negatives and preference pairs.

A row is one small JSON document (an example with its messages and tools), so
these rules are functions of one row, to be run by ``records.each`` in Arrow
batches.  A rule that refuses a row raises ``Refused`` with a reason code.
"""

from __future__ import annotations

import json
import re
import shlex
from collections import Counter
from collections.abc import Callable, Iterable

from sessionweave.operators.records import canonical, objects, sha, stable_id, sub

#: Scalar type names of signatures, lanes of trainer rows, roles.
SCALARS = {
    "str": "string", "string": "string", "int": "integer", "integer": "integer", "float": "number", "number": "number", "bool": "boolean", "boolean": "boolean",
}
LANES = ("reviewed_final_answer", "frontier_action_window", "skill_policy", "tool_policy_replay", "verified_open_swe_action")
ROLES = ("system", "user", "assistant", "tool")
COLUMNS = {"schema_version", "example_id", "split", "lane", "messages", "tools"}
EXAMPLE_SCHEMA = "sft-example/v1"
#: Programs and git commands that only read; tools and commands that change; words that ask for or forbid change.
READERS = {
    "cat", "cut", "diff", "du", "echo", "file", "find", "grep", "head", "jq", "less", "ls", "nl", "pwd", "rg", "sort", "stat", "tail", "test", "tr", "tree", "true",
    "uniq", "wc", "which",
}
GIT_READERS = {"blame", "branch", "diff", "grep", "log", "ls-files", "rev-parse", "show", "status"}
CHANGERS = {"apply_patch", "edit_file", "write_file", "create_file", "delete_file", "str_replace", "multi_edit"}
SHELLS = {"bash", "shell", "exec_command", "terminal", "run_command"}
SHELL_CHANGE = re.compile(r"(?i)\b(?:rm|mv|cp|tee|mkdir|touch|chmod|chown|truncate|apply_patch|git\s+(?:add|apply|checkout|commit|merge|push|rebase|reset)|sed\s+-i|pip\s+install|npm\s+install)\b|(?<!2)>{1,2}\s*(?!/dev/null)[\w./~-]")
WANTS_CHANGE = re.compile(r"(?i)\b(?:add|build|change|create|delete|edit|fix|implement|install|modify|refactor|remove|rename|replace|update|upgrade|write)\b")
NO_CHANGE = re.compile(r"(?i)\b(?:do not|don't|without|never)\s+(?:\w+\s+){0,2}(?:chang|edit|modif|touch|writ)\w*|\bread[- ]only\b")
PR_TEXT = re.compile(r"(?is)<pr_description>\s*(.*?)\s*</pr_description>")
CALL_TEXT = re.compile(r"(?is)\s*<TOOLCALL>\s*(.*?)\s*</TOOLCALL>\s*")
PROTOCOL = re.compile(r"(?i)<instructions>|</?pr_description>|<format_example>|mini-swe")
TARGET_CHARS = 600


class Refused(ValueError):
    """A row is refused; the message is its reason code."""


def need(condition, reason: str) -> None:
    if not condition:
        raise Refused(reason)


def reason_of(rule: Callable, *args, **kwargs) -> str | None:
    """The reason code with which a rule refuses, or None."""
    try:
        rule(*args, **kwargs)
    except Refused as why:
        return str(why)
    return None


def parsed(value, label: str) -> dict:
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            raise Refused(f"{label}_invalid_json") from None
    need(isinstance(value, dict), f"{label}_not_object")
    return value


# Types and schemas.


def split_top(text: str) -> list[str]:
    """Parts between commas outside any bracket."""
    parts, depth, low = [], 0, 0
    for k, c in enumerate(text):
        depth += (c == "[") - (c == "]")
        if c == "," and not depth:
            parts.append(text[low:k].strip())
            low = k + 1
    return [*parts, text[low:].strip()]


def json_type(told) -> dict:
    """JSON schema of a signature's type name."""
    need(isinstance(told, str) and told.strip(), "tool_property_type_missing")
    name = re.sub(r"(?i),\s*optional.*$", "", told.strip()).strip()
    low = name.lower()
    if low in SCALARS:
        return {"type": SCALARS[low]}
    plain = {"dict": {"type": "object"}, "object": {"type": "object"}, "list": {"type": "array", "items": {}}, "set": {"type": "array", "items": {}}}
    if low in plain:
        return dict(plain[low])
    generic = re.fullmatch(r"(?i)(list|tuple|union)\[(.*)]", name)
    need(generic, "tool_property_type_unsupported")
    kind, inner = generic[1].lower(), [json_type(x) for x in split_top(generic[2])]
    if kind == "union":
        return {"type": "number"} if {o.get("type") for o in inner} <= {"integer", "number"} else {"anyOf": inner}
    return {"type": "array", "items": inner[0] if all(x == inner[0] for x in inner) else {}}


def json_property(told) -> dict:
    need(isinstance(told, dict), "tool_property_not_object")
    out = json_type(told.get("type"))
    if isinstance(told.get("description"), str) and told["description"]:
        out["description"] = told["description"]
    return out | ({"enum": told["enum"]} if isinstance(told.get("enum"), list) and told["enum"] else {})


def native_tools(told) -> list[dict]:
    """Tool list of JSON texts to native schemas: order kept, properties and required names sorted."""
    need(isinstance(told, list) and told, "tools_missing")
    out: dict[str, dict] = {}
    for k, raw in enumerate(told):
        tool = parsed(raw, f"tool_{k}")
        name, given = tool.get("name"), tool.get("parameters")
        need(isinstance(name, str) and name and name not in out, "tool_name_invalid_or_duplicate")
        need(isinstance(given, dict), "tool_parameters_missing")
        fields = given.get("properties")
        need(isinstance(fields, dict), "tool_properties_missing")
        wanted = tool.get("required", given.get("required", []))
        need(isinstance(wanted, list) and all(isinstance(x, str) for x in wanted), "tool_required_invalid")
        need(set(wanted) <= set(fields), "tool_required_unknown_property")
        schema = {"type": "object", "properties": {f: json_property(fields[f]) for f in sorted(fields)}, "required": sorted(set(wanted)), "additionalProperties": False}
        text = str(tool.get("description") or "Call the selected tool.")
        out[name] = {"type": "function", "function": {"name": name, "description": text, "parameters": schema}}
    return list(out.values())


def conforms(value, schema: dict) -> bool:
    """Whether a value fits the subset of JSON schema that tools use."""
    if "anyOf" in schema:
        return any(conforms(value, s) for s in schema["anyOf"])
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    checks = {
        "string": isinstance(value, str), "integer": number and isinstance(value, int), "number": number, "boolean": isinstance(value, bool),
        "object": isinstance(value, dict), "array": isinstance(value, list) and all(conforms(x, schema.get("items", {})) for x in value),
    }
    return checks.get(schema.get("type"), schema == {})


def call_target(content, tools: list[dict], row: int) -> tuple[str, dict]:
    """Lane and message of a chosen response: a checked call, a question, or an answer without a tool."""
    need(isinstance(content, str) and content.strip(), "chosen_response_missing")
    found = CALL_TEXT.fullmatch(content)
    if not found:
        text = content.strip()
        need(len(text) <= TARGET_CHARS, "chosen_response_too_long")
        return ("clarify" if text.endswith("?") else "no_tool"), {"role": "assistant", "content": text}
    try:
        asked = json.loads(found[1])
    except ValueError:
        raise Refused("chosen_toolcall_invalid_json") from None
    need(isinstance(asked, list) and asked, "chosen_toolcall_not_list")
    known, calls = {t["function"]["name"]: t["function"]["parameters"] for t in tools}, []
    for k, call in enumerate(asked):
        need(isinstance(call, dict) and isinstance(call.get("arguments"), dict), "chosen_toolcall_invalid")
        schema, given = known.get(call.get("name")), call["arguments"]
        need(schema is not None, "chosen_toolcall_unknown_tool")
        need(set(schema["required"]) <= set(given), "chosen_toolcall_missing_required")
        need(set(given) <= set(schema["properties"]), "chosen_toolcall_unknown_argument")
        need(all(conforms(v, schema["properties"][f]) for f, v in given.items()), "chosen_toolcall_argument_type")
        calls.append({"id": f"call_r{row:05d}_c{k:02d}", "type": "function", "function": {"name": call["name"], "arguments": given}})
    return "tool_call", {"role": "assistant", "content": "", "tool_calls": calls}


# Shell-only trajectories.


def shell_tools(told) -> list[dict]:
    """The one tool of a trajectory that may only run shell commands, under its own name and contract."""
    need(isinstance(told, list) and told, "tools_missing")
    for k, raw in enumerate(told):
        function = parsed(raw, f"tool_{k}").get("function")
        need(isinstance(function, dict), "tool_function_missing")
        need(isinstance(function.get("name"), str) and function["name"] and isinstance(function.get("parameters"), dict), "tool_contract_invalid")
        need(function["name"] == "bash", "unsupported_source_tool")
        need("command" in (function["parameters"].get("properties") or {}), "bash_command_contract_missing")
    schema = {"type": "object", "properties": {"cmd": {"type": "string", "description": "Shell command to execute."}}, "required": ["cmd"], "additionalProperties": False}
    return [{"type": "function", "function": {"name": "exec_command", "description": "Run a shell command in the active task environment.", "parameters": schema}}]


def shell_call(call, action: int, place: int) -> dict:
    """``bash.command`` as ``exec_command.cmd`` with an id by place."""
    need(isinstance(call, dict) and isinstance(call.get("function"), dict), "tool_call_invalid")
    need(call["function"].get("name") == "bash", "unsupported_source_call")
    command = parsed(call["function"].get("arguments"), "tool_arguments").get("command")
    need(isinstance(command, str) and command, "bash_command_missing")
    return {"id": f"call_a{action:04d}_c{place:02d}", "type": "function", "function": {"name": "exec_command", "arguments": {"cmd": command}}}


def task_message(role: str, content: str, sentinel: str) -> tuple[str, bool]:
    """User text without the wrapper of its harness, and whether there was one."""
    if role != "user" or "<instructions>" not in content.lower() or sentinel not in content:
        return content, False
    found = PR_TEXT.search(content)
    need(found, "source_harness_pr_description_missing")
    need(found[1].strip(), "source_harness_pr_description_empty")
    return f"Repository task:\n\n{found[1].strip()}", True


def trajectory(row: dict, sentinel: str) -> dict:
    """Base messages and action turns, each with its observations by place; a closing text or sentinel is no action."""
    given = row.get("messages")
    need(isinstance(given, list) and len(given) >= 3, "messages_invalid")
    from sessionweave.operators.records import _marker

    need(not any(isinstance(m.get("content"), str) and _marker.search(m["content"]) for m in objects(given)), "visible_reasoning_marker")
    tools, base, turns = shell_tools(row.get("tools")), [], []
    left = list(given)
    while left and isinstance(left[0], dict) and left[0].get("role") in {"system", "user"}:
        m = left.pop(0)
        need(isinstance(m.get("content"), str), "base_message_content_invalid")
        base.append({"role": m["role"], "content": task_message(m["role"], m["content"], sentinel)[0]})
    need(any(m["role"] == "user" for m in base), "initial_user_missing")
    ended = False
    while left:
        m = left.pop(0)
        need(isinstance(m, dict) and m.get("role") == "assistant", "unexpected_message_order")
        if not m.get("tool_calls"):
            need(not left, "nonterminal_text_action")
            break
        calls = [shell_call(c, len(turns), k) for k, c in enumerate(m["tool_calls"])]
        if not left and len(calls) == 1 and sentinel in calls[0]["function"]["arguments"]["cmd"]:
            ended = True
            break
        told = []
        while left and isinstance(left[0], dict) and left[0].get("role") == "tool":
            told.append(left.pop(0))
        need(len(told) >= len(calls), "observation_missing")
        need(len(told) == len(calls) and all(isinstance(o.get("content"), str) for o in told), "observation_join_ambiguous")
        seen = [{"role": "tool", "content": o["content"], "name": c["function"]["name"], "tool_call_id": c["id"]} for c, o in zip(calls, told, strict=True)]
        turns.append({"target": {"role": "assistant", "content": "", "tool_calls": calls}, "observations": seen})
    need(turns, "tool_actions_missing")
    return {"base": base, "turns": turns, "tools": tools, "ended": ended}


def bounded_prompt(of: dict, action: int, most: int) -> tuple[list[dict], bool]:
    """Base, the newest whole turns before an action that fit, and the action; whether any turn was left out."""
    size = lambda messages: len(canonical({"messages": messages, "tools": of["tools"]}).encode())
    target, kept = of["turns"][action]["target"], []
    need(size([*of["base"], target]) <= most, "window_fixed_context_too_large")
    for turn in reversed(of["turns"][:action]):
        more = [turn["target"], *turn["observations"], *kept]
        if size([*of["base"], *more, target]) > most:
            return [*of["base"], *kept, target], True
        kept = more
    return [*of["base"], *kept, target], False


# Policies.


def payload(call: dict) -> dict:
    of = sub(call, "function") or call
    given = of.get("arguments")
    return {"name": str(of.get("name") or "unknown"), "arguments": given if isinstance(given, dict) else {"raw": given}}


def script_of(command) -> str | None:
    """The script of a shell command given as text or as a list."""
    if isinstance(command, list):
        words = [str(x) for x in command]
        wrapped = len(words) >= 3 and words[0].rsplit("/", 1)[-1] in {"bash", "dash", "sh", "zsh"} and words[1] in {"-c", "-lc"}
        return (words[2] if wrapped else " ".join(words)).strip()
    return command.strip() if isinstance(command, str) else None


def only_reads(script: str) -> bool:
    """Whether every part of a script is a program that reads."""
    script = re.sub(r"\d?>\s*/dev/null|2>&1", "", script)
    parts = [p.strip() for p in re.split(r"&&|\|\||[;|]", script) if p.strip()]
    if not parts or any(x in script for x in (">", "<", "`", "$(")):
        return False

    def reads(part: str) -> bool:
        try:
            words = shlex.split(part)
        except ValueError:
            return False
        while words and re.match(r"[^=-][^=]*=", words[0]):
            words.pop(0)
        name = words[0].rsplit("/", 1)[-1] if words else "cd"
        if name == "sed":
            return "-i" not in words and not any(w.startswith("--in-place") for w in words)
        if name == "git":
            return len(words) > 1 and words[1] in GIT_READERS
        return name == "cd" or name in READERS

    return all(map(reads, parts))


def call_reads(call: dict) -> bool:
    of = payload(call)
    script = script_of(of["arguments"].get("cmd")) if of["name"] == "exec_command" else None
    return bool(script) and only_reads(script)


def call_changes(call: dict) -> bool:
    of = payload(call)
    command = of["arguments"].get("cmd", of["arguments"].get("command", ""))
    return of["name"] in CHANGERS or (of["name"] in SHELLS and isinstance(command, str) and bool(SHELL_CHANGE.search(command)))


def calls_of(message: dict) -> list[dict]:
    return message.get("tool_calls") or []


def signature(message: dict) -> str:
    return canonical([payload(c) for c in calls_of(message)])


def action_policy(messages: list[dict]) -> str | None:
    """Why a target action must not be taught: it repeats a call, or changes what nobody asked to change."""
    target, before = calls_of(messages[-1]), messages[:-1]
    done = {canonical(payload(c)) for m in before for c in calls_of(m)}
    if any(canonical(payload(c)) in done for c in target):
        return "target_repeats_prior_call"
    said = [m["content"] for m in before if m.get("role") == "user"]
    if not any(map(call_changes, target)):
        return None
    if said and NO_CHANGE.search(said[-1]):
        return "target_violates_no_mutation_instruction"
    return None if WANTS_CHANGE.search("\n".join(said)) else "target_mutation_intent_unproven"


def split_prompt(messages: list[dict]) -> tuple[list[dict], list[dict]]:
    """Base messages, and observed turns with whether all calls are answered and only read."""
    head = next((k for k, m in enumerate(messages) if m.get("role") not in {"system", "user"}), len(messages))
    base, turns = messages[:head], []
    need(any(m.get("role") == "user" for m in base), "cycle_prompt_base_invalid")
    for m in messages[head:]:
        if m.get("role") == "tool":
            need(turns, "cycle_prompt_action_order_invalid")
            turns[-1]["chunk"].append(m)
            continue
        need(m.get("role") == "assistant" and calls_of(m), "cycle_prompt_action_order_invalid")
        turns.append({"action": m, "chunk": [m], "read_only": all(map(call_reads, calls_of(m)))})
    for t in turns:
        ids = {str(c["id"]) for c in calls_of(t["action"]) if c.get("id") is not None}
        t["complete"] = bool(ids) and ids <= {str(o.get("tool_call_id")) for o in t["chunk"][1:]}
    return base, turns


def repeat_distance(prompt: list[dict], action: dict) -> int | None:
    """How many action turns back an equal action stands."""
    wanted, done = signature(action), [signature(m) for m in objects(prompt) if m.get("role") == "assistant" and calls_of(m)]
    return next((k for k, s in enumerate(reversed(done), 1) if s == wanted), None)


def strict_status(prompt: list[dict], action_at: int) -> str:
    """Status of an action by explicit return codes alone."""
    codes = []
    for m in prompt[action_at + 1 :]:
        try:
            told = json.loads(m["content"]) if m.get("role") == "tool" and isinstance(m.get("content"), str) else None
        except ValueError:
            told = None
        if not isinstance(told, dict) or not isinstance(told.get("returncode"), int):
            return "unknown"
        codes.append(told["returncode"])
    return "unknown" if not codes else "explicit_failure" if any(codes) else "explicit_success"


# Negatives and pairs.


def made_call(tool: str, /, **arguments) -> dict:
    return {"role": "assistant", "content": "", "tool_calls": [{"id": "call-rejected", "type": "function", "function": {"name": tool, "arguments": arguments}}]}


def again(message: dict) -> dict:
    """The same action under new call ids."""
    return message | {"tool_calls": [c | {"id": f"call-rejected-{k:02d}"} for k, c in enumerate(calls_of(message))]}


def prior_actions(messages: list[dict]) -> list[dict]:
    return [m for m in messages[:-1] if m.get("role") == "assistant" and calls_of(m)]


#: Kinds of policy rows, the family of each negative, and what a negative does.
DONE = {"role": "assistant", "content": "The task is complete."}
NEGATIVES_1 = {
    "skill_route": ("bypasses_required_skill", lambda m: made_call("search_code", query="implement the requested change")),
    "skill_apply": ("repeats_completed_skill_read", lambda m: again(next(x for x in m[:-1] if x.get("role") == "assistant"))),
    "skill_skip_low_return": ("unnecessary_skill_overhead", lambda m: made_call("read_skill", name="core-principles")),
    "bounded_termination": ("delays_required_decision", lambda m: made_call("read_skill", name="core-principles")),
}
READ_ONLY_KINDS = (
    "bounded_command_report", "diagnose_without_repair", "diagnostic_report_holdout", "read_only_report", "skill_bounded_read_only",
    "untrusted_observation_holdout", "untrusted_observation_report", "verified_noop_report",
)
FINISH_KINDS = ("verified_finish", "verified_finish_holdout", "verified_mutation_finish", "single_inspection_report")


def negative(example: dict, kind: str) -> tuple[dict, str]:
    """First rules: a rejected action for a policy row, and why it is wrong."""
    messages = example["messages"]
    if kind in NEGATIVES_1:
        why, make = NEGATIVES_1[kind]
        return make(messages), why
    if before := prior_actions(messages):
        return again(before[-1]), "repeats_observed_action_instead_of_follow_through"
    need("read_skill" in {sub(t, "function").get("name") for t in example.get("tools") or []}, f"no_controlled_negative:{kind}")
    return made_call("read_skill", name="core-principles"), "unnecessary_skill_overhead"


def family_negative(example: dict, kind: str) -> tuple[dict, str]:
    """Second rules: a rejected action and the behavior family it belongs to."""
    messages, names = example["messages"], {sub(t, "function").get("name") for t in example.get("tools") or []}
    needs_tool = lambda n, why: need(n in names, why)

    def last() -> dict:
        before = prior_actions(messages)
        need(before, "prior_tool_action_missing")
        return again(before[-1])

    if kind in READ_ONLY_KINDS:
        needs_tool("apply_patch", "read_only_negative_requires_apply_patch")
        return made_call("apply_patch", patch="*** Begin Patch\n*** End Patch"), "permission_read_only_boundary"
    if kind in ("evidence_bound_blocker", "blocker_holdout"):
        needs_tool("finish_task", "blocker_negative_requires_finish_task")
        return made_call("finish_task", summary="The task is complete.", evidence="No blocking prerequisite remains."), "blocker_over_false_completion"
    if kind in FINISH_KINDS:
        return last(), "verified_finish_over_unnecessary_continuation"
    if kind in ("no_repeat_alternate", "skill_fallback_report"):
        return last(), "post_error_changed_recovery"
    if kind == "bounded_termination":
        stops = any(sub(c, "function").get("name") == "search_code" for c in calls_of(messages[-1])[:1])
        return (dict(DONE), "premature_stop_before_required_work") if stops else (made_call("search_code", query="continue investigating"), "verified_finish_over_unnecessary_continuation")
    plain = {
        "skill_route": (made_call("search_code", query="implement the requested change"), "required_skill_routing"),
        "skill_skip_low_return": (made_call("read_skill", name="core-principles"), "unnecessary_skill_overhead"),
        "skill_apply": (dict(DONE), "premature_stop_before_required_work"),
    }
    need(kind in plain, f"no_policy_negative:{kind}")
    return plain[kind]


def pair(split: str, lane: str, prompt: list[dict], chosen: dict, rejected: dict, tools: list[dict], identity: dict) -> dict:
    """A preference pair under the digest of all it is made of."""
    body = {"identity": identity, "prompt": prompt, "chosen": chosen, "rejected": rejected, "tools": tools}
    out = {"pair_id": stable_id(body), "split": split, "lane": lane, "prompt": prompt, "chosen": [chosen], "rejected": [rejected], "tools": tools}
    check_pair(out, split)
    return out


# Validators.


def check_messages(messages) -> None:
    need(isinstance(messages, list) and len(messages) >= 2, "messages_invalid")
    for m in messages:
        need(isinstance(m, dict), "message_not_object")
        need(m.get("role") in ROLES, "message_role_invalid")
        need(isinstance(m.get("content"), str), "message_content_invalid")
        calls = m.get("tool_calls")
        if calls is None:
            continue
        need(m["role"] == "assistant" and isinstance(calls, list) and calls, "tool_calls_invalid")
        for c in calls:
            need(sub(c, "function"), "tool_function_invalid")
            need(isinstance(c["function"].get("name"), str) and c["function"]["name"], "tool_name_invalid")
            need(isinstance(c["function"].get("arguments"), dict), "tool_arguments_invalid")
    need(messages[-1]["role"] == "assistant", "target_not_assistant")


def check_schemas(tools) -> dict[str, dict]:
    """Schemas by name: not empty, of unique names, with an object of parameters."""
    need(isinstance(tools, list) and tools, "tool_schemas_invalid")
    out: dict[str, dict] = {}
    for t in tools:
        f = sub(t, "function")
        need(isinstance(f.get("name"), str) and f["name"] and f["name"] not in out and isinstance(f.get("parameters"), dict), "tool_schema_malformed_or_duplicated")
        out[f["name"]] = f["parameters"]
    return out


def check_calls(messages: list[dict], schemas: dict[str, dict]) -> None:
    seen = Counter(c.get("id") for m in messages for c in calls_of(m) if isinstance(c, dict))
    for c in (c for m in messages for c in calls_of(m)):
        f = sub(c, "function")
        whole = isinstance(f.get("name"), str) and isinstance(f.get("arguments"), dict) and isinstance(c.get("id"), str) and c["id"]
        need(whole, "tool_call_malformed")
        need(seen[c["id"]] == 1, "tool_call_id_duplicated")
        need(f["name"] in schemas, "tool_call_without_schema")
        of = schemas[f["name"]]
        fields, wanted = of.get("properties"), of.get("required", [])
        need(isinstance(fields, dict) and isinstance(wanted, list), "tool_parameter_contract_invalid")
        need(set(wanted) <= set(f["arguments"]), "tool_call_missing_required_argument")
        need(of.get("additionalProperties") is not False or set(f["arguments"]) <= set(fields), "tool_call_undeclared_argument")


def check_example(row: dict, split: str) -> None:
    """A trainer example: columns, split, lane, messages, schemas and calls."""
    need(set(row) <= COLUMNS, "unsupported_columns")
    need(row.get("schema_version") == EXAMPLE_SCHEMA, "schema_mismatch")
    need(row.get("split") == split, "split_mismatch")
    need(isinstance(row.get("example_id"), str) and row["example_id"], "identity_missing")
    need(row.get("lane") in LANES, "lane_invalid")
    check_messages(row.get("messages"))
    check_calls(row["messages"], {} if row.get("tools") is None else check_schemas(row["tools"]))


def check_pair(row: dict, split: str) -> None:
    """A preference pair: both branches valid after the prompt, and different."""
    need(row.get("split") == split, "split_mismatch")
    need(isinstance(row.get("pair_id"), str) and row["pair_id"], "identity_missing")
    for side in ("chosen", "rejected"):
        need(isinstance(row.get(side), list) and len(row[side]) == 1, f"{side}_invalid")
        check_messages([*row["prompt"], *row[side]])
    need(canonical(row["chosen"]) != canonical(row["rejected"]), "branches_equal")


def clean_text(value, patterns: Iterable[re.Pattern] = ()) -> None:
    """No hidden key, marker or blocked pattern at any depth."""
    from sessionweave.functions.text import HIDDEN_KEYS
    from sessionweave.operators.records import _marker, key_of, leaves

    for _, key, v, _, _ in leaves(value):
        if key is not None:
            need(key_of(key) not in HIDDEN_KEYS, "reasoning_field_survived")
        elif isinstance(v, str):
            need(not _marker.search(v), "reasoning_marker_survived")
            need(not any(p.search(v) for p in patterns), "blocked_text_survived")


def protocol_absent(value) -> None:
    """No wrapper of a source harness at any depth."""
    from sessionweave.operators.records import leaves

    need(not any(k is None and PROTOCOL.search(v) for _, k, v, _, _ in leaves(value)), "source_protocol_survived")


def visible_rejection(view: dict, most: int, forbidden: dict[str, re.Pattern]) -> str | None:
    """First reason that keeps a visible row out: size, brand, reasoning, privacy, marker."""
    from sessionweave.operators.records import findings

    body = canonical(view)
    if len(body.encode()) > most:
        return "visible_character_limit"
    if (hit := next((r for r, p in forbidden.items() if p.search(body)), None)) is not None:
        return hit
    found = findings(view)
    if found["hidden_keys"]:
        return "reasoning_field"
    if any(found[k] for k in ("raw_keys", "secret_keys", "secret_values", "private_values")):
        return "privacy_firewall"
    return "reasoning_marker" if any(found[k] for k in ("trainer_blocker", "tool_observation_review", "unknown_context_review", "metadata")) else None


def event_summary(events: list[dict]) -> dict:
    """Counts of a trajectory's events; ids and ordinals are unique and every call is observed."""
    for field, why in (("event_id", "event_ids_not_unique"), ("ordinal", "event_ordinals_not_unique")):
        values = [e.get(field) for e in events]
        need(len(set(values)) == len(values) and None not in values, why)
    ids = {k: {e["call_id"] for e in events if e.get("kind") == k and e.get("call_id")} for k in ("action", "observation")}
    need(ids["action"] == ids["observation"], "call_and_observation_sets_differ")
    return {"events": len(events), "calls": len(ids["action"]), "kinds": dict(Counter(e.get("kind") for e in events))}


def tool_activity(record: dict) -> bool:
    """Whether any message or event of a record is of a tool."""
    of_messages = any(m.get("role") == "tool" or m.get("tool_calls") for m in objects(record.get("messages") or []))
    return of_messages or any(e.get("kind") in ("action", "observation") for e in objects(record.get("events") or []))


def trainer_view(record: dict, columns: Iterable[str] = ("messages", "tools", "example_id", "split")) -> dict:
    """Allowed columns of a row; one with tool activity needs its schemas."""
    out = {c: record[c] for c in columns if c in record}
    if tool_activity(record):
        check_schemas(record.get("tools"))
    return out


def skill_output(found, expected: int) -> None:
    """Skills as a generator must return them: as many as asked, named, of bounded lengths, unique."""
    need(isinstance(found, list) and len(found) == expected, "skill_count")
    names = [s.get("name") for s in objects(found)]
    need(len(names) == expected and all(isinstance(n, str) and re.fullmatch(r"[a-z0-9][a-z0-9-]{2,63}", n) for n in names), "skill_name")
    need(len(set(names)) == expected, "skill_name_duplicated")
    need(all(isinstance(s.get("description"), str) and 10 <= len(s["description"]) <= 1024 for s in found), "skill_description")


def prompt_completion(row: dict) -> tuple[list[dict], dict]:
    """Prompt and completion of an action window: its context, the last message being the target; refused as a unit."""
    context = sub(row, "context").get("messages")
    check_messages(context)
    target = context[-1]
    need(len(calls_of(target)) == 1, "target_call_count")
    told = sub(row, "tool_call")
    need(told.get("name") == target["tool_calls"][0]["function"]["name"], "target_call_mismatch")
    need(sub(row, "observation").get("status") == "success", "observation_not_success")
    return context[:-1], target


def strict_messages(messages: list[dict]) -> list[dict]:
    """Argument texts parsed; repeated keys and numbers that are none refuse the row."""

    def unique(pairs: list) -> dict:
        need(len({k for k, _ in pairs}) == len(pairs), "duplicate_argument_key")
        return dict(pairs)

    def refuse(_):
        raise Refused("non_finite_number")

    out = []
    for m in messages:
        calls = []
        for c in calls_of(m):
            given = sub(c, "function").get("arguments")
            if isinstance(given, str):
                try:
                    given = json.loads(given, object_pairs_hook=unique, parse_constant=refuse)
                except json.JSONDecodeError:
                    raise Refused("arguments_invalid_json") from None
            need(isinstance(given, dict), "arguments_not_object")
            calls.append(c | {"function": c["function"] | {"arguments": given}})
        out.append(m | ({"tool_calls": calls} if calls else {}))
    return out


def loader_safe(record: dict) -> dict:
    """Messages with arguments as JSON text, and events as JSON texts: one type a column."""
    text = lambda v: v if isinstance(v, str) else canonical(v)
    messages = [
        m | ({"tool_calls": [c | {"function": c["function"] | {"arguments": text(c["function"].get("arguments"))}} for c in calls_of(m)]} if calls_of(m) else {})
        for m in objects(record.get("messages") or [])
    ]
    return {"messages": messages, "events": [canonical(e) for e in record.get("events") or []]}


def final_answer(messages: list[dict], least: int = 200, most: int = 32_768) -> tuple[list[dict], dict]:
    """User turns before the closing answer, which comes after the last tool activity and is whole."""
    need(messages and messages[-1].get("role") == "assistant" and not calls_of(messages[-1]), "terminal_answer_missing")
    answer = messages[-1]["content"].strip()
    need(least <= len(answer) <= most, "answer_length")
    need(not re.search(r"(?i)(?:\.\.\.|…|\b(?:i will|let me|next,? i)\b[^.]*)$", answer), "answer_incomplete")
    asked = [m for m in messages[:-1] if m.get("role") == "user"]
    need(asked, "user_turn_missing")
    return asked, {"role": "assistant", "content": answer}


def pair_digest(prompt: list[dict], tools: list[dict]) -> str:
    return sha(canonical({"prompt": prompt, "tools": tools}))
