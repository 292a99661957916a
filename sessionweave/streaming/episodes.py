"""Episodes of a harness as keyed state: what may follow what, and when an episode ends.

A step takes the state of an episode and one observed event and tells the first
rule that the event breaks; an event that breaks a rule changes nothing.  The
same steps run over a stream (state in Spark's state store, one row an event
out) and over a table (events of an episode in order).
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Words of the contract.
READS = ("read", "not_read", "unavailable")
SCOPES = ("in_scope", "out_of_scope", "not_applicable")
SKIPS = ("not_triggered", "out_of_scope", "low_return", "already_read")
DECISIONS = ("use", "skip", "defer", "ask")
PERMISSIONS = ("granted", "denied", "not_required")
STATUSES = ("success", "failure", "timeout", "unmatched")
RESULTS = ("pass", "fail", "unknown")
ENDS = ("success", "failure", "bounded_stop", "aborted")
DESTRUCTIVE = ("write", "network_write", "destructive", "external")
SHA = __import__("re").compile("[0-9a-f]{64}")


def fresh(required: tuple[str, ...] = (), calls: int = 64, repeats: int = 3, stalls: int = 3) -> dict:
    """State of an episode before its first event; only counts, names and ids are kept."""
    return {
        "n": 0, "skills": {}, "tools": None, "decided": {}, "calls": {}, "seen": [], "checked": None, "last_call": -1, "signatures": {}, "states": {}, "ended": None,
        "required": list(required), "limits": [calls, repeats, stalls],
    }


def bounded_text(text: str, most: int) -> tuple[str, str, int, bool]:
    """Text cut to so many bytes, half from either end, with the digest and size of the whole."""
    data = text.encode("utf-8", "surrogatepass")
    whole = hashlib.sha256(data).hexdigest()
    if len(data) <= most:
        return text, whole, len(data), False
    head = most // 2
    cut = data[:head].decode("utf-8", "ignore") + data[len(data) - (most - head) :].decode("utf-8", "ignore")
    return cut, whole, len(data), True


def _skill(s: dict, e: dict):
    yield e.get("read_result") not in READS, "invalid_read_result"
    yield e.get("scope_decision") not in SCOPES, "invalid_scope_decision"
    read = e["read_result"] == "read"
    yield read and not SHA.fullmatch(e.get("content_sha256") or ""), "content_digest_missing"
    yield not read and e.get("content_sha256") is not None, "content_digest_without_read"
    yield not read and not e.get("mandatory") and e.get("skip_reason") not in SKIPS, "optional_skip_without_reason"
    s["skills"][e["skill"]] = [e["read_result"], e["scope_decision"]]
    yield not read and e.get("mandatory"), "mandatory_skill_not_read"


def _registry(s: dict, e: dict):
    yield s["tools"] is not None, "registry_assigned_twice"
    names = [t.get("name") for t in e.get("tools", [])]
    yield any(not isinstance(n, str) or not n.strip() for n in names), "tool_name_missing"
    yield len(set(names)) < len(names), "tool_name_duplicated"
    s["tools"] = {t["name"]: t.get("side_effect_class", "read_only") for t in e.get("tools", [])}


def _decision(s: dict, e: dict):
    yield e.get("decision") not in DECISIONS, "invalid_decision"
    yield not e.get("decision_basis") or len(e["decision_basis"]) > 256, "decision_basis"
    unread = [k for k in s["required"] if s["skills"].get(k) != ["read", "in_scope"]]
    yield e["decision"] == "use" and e.get("tool_name") is not None and bool(unread), "required_skill_unread"
    if e.get("tool_name") is not None:
        s["decided"][e["tool_name"]] = [e["decision"], e.get("required_gate_status")]


def _call(s: dict, e: dict):
    yield e.get("call_id") in s["calls"], "call_id_duplicated"
    yield e.get("permission_decision") not in PERMISSIONS, "invalid_permission"
    if len(s["calls"]) >= s["limits"][0]:
        s["ended"] = "bounded_stop"
        yield True, "call_limit"
    yield s["tools"] is None, "registry_missing"
    yield e.get("tool_name") not in s["tools"], "tool_not_exposed"
    decided = s["decided"].get(e["tool_name"])
    yield decided is None or decided[0] != "use", "use_decision_missing"
    yield decided[1] not in ("passed", "not_required"), "gate_not_passed"
    yield s["tools"][e["tool_name"]] in DESTRUCTIVE and e["permission_decision"] != "granted", "permission_not_granted"
    s["calls"][e["call_id"]] = e["tool_name"]
    s["last_call"] = s["n"]


def _observation(s: dict, e: dict):
    yield e.get("status") not in STATUSES, "invalid_status"
    yield e.get("call_id") not in s["calls"] and e["status"] != "unmatched", "unknown_call"
    yield e["call_id"] in s["seen"], "observation_duplicated"
    s["seen"].append(e["call_id"])


def _delta(s: dict, e: dict):
    values = [v for side in ("before", "after") for v in (e.get(side) or {}).values()]
    yield any(v is not None and not SHA.fullmatch(str(v)) for v in values), "state_not_a_digest"
    yield any(not isinstance(c, str) for c in e.get("changed", [])), "changed_label"


def _verification(s: dict, e: dict):
    yield e.get("result") not in RESULTS, "invalid_result"
    yield e["result"] == "pass" and not (e.get("checks") and e.get("durable_evidence")), "pass_without_evidence"
    s["checked"] = [s["n"], e["result"]]


def _terminal(s: dict, e: dict):
    yield e.get("status") not in ENDS, "invalid_terminal_status"
    if e["status"] == "success":
        yield bool(set(s["calls"]) - set(s["seen"])), "unobserved_calls"
        yield s["checked"] is None, "verification_missing"
        yield s["checked"][0] < s["last_call"], "verification_before_last_call"
        yield s["checked"][1] != "pass", "verification_not_passed"
    s["ended"] = e["status"]


def _guard(s: dict, e: dict):
    yield not e.get("signature"), "signature_missing"
    yield not SHA.fullmatch(e.get("state_hash") or ""), "state_not_a_digest"
    hits = []
    for kept, key, most in (("signatures", e["signature"], e.get("limit") or s["limits"][1]), ("states", e["state_hash"], s["limits"][2])):
        s[kept][key] = s[kept].get(key, 0) + 1
        hits.append(s[kept][key] >= most)
    if any(hits):
        s["ended"] = "bounded_stop"


def _health(s: dict, e: dict):
    yield not all(isinstance(e.get(k), str) and e[k] for k in ("server", "revision", "health_result")), "health_fields"
    yield any(not isinstance(c, str) or not c.strip() for c in e.get("capabilities", [])), "capability_name"


RULES: dict[str, Callable] = {
    "skill_preflight": _skill, "tool_registry": _registry, "decision": _decision, "tool_call": _call, "tool_observation": _observation, "state_delta": _delta,
    "verification": _verification, "terminal": _terminal, "loop_guard": _guard, "mcp_health": _health,
}


def step(state: dict, event: dict) -> str | None:
    """Apply an event; the rule it breaks, or None.  Mandatory skills and limits leave their mark even so."""
    kind = event.get("event_type")
    if kind not in RULES:
        return "unsupported_event_type"
    if state["ended"]:
        return "episode_ended"
    for broken, why in RULES[kind](state, event):
        if broken:
            return why
    state["n"] += 1
    return None


def replay(events: list[dict], **limits) -> tuple[list[str | None], dict]:
    """What each event of an episode breaks, and the last state."""
    state = fresh(**limits)
    return [step(state, e) for e in events], state


OUT = "episode string, ordinal bigint, broken string, ended string, calls bigint"


def _rows(key: str, frame: pd.DataFrame, state: dict) -> pd.DataFrame:
    out = []
    for ordinal, event in zip(frame["ordinal"], frame["event"], strict=True):
        broken = step(state, json.loads(event))
        out.append((key, ordinal, broken, state["ended"], len(state["calls"])))
    return pd.DataFrame(out, columns=["episode", "ordinal", "broken", "ended", "calls"])


def checked(events: DataFrame, **limits) -> DataFrame:
    """``(episode, ordinal, broken, ended, calls)`` of a table ``(episode, ordinal, event)``; an episode is bounded by its call limit and ends once."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _rows(key[0], frame.sort_values("ordinal"), fresh(**limits))

    return events.groupBy("episode").applyInPandas(run, OUT)


def checked_stream(events: DataFrame, **limits) -> DataFrame:
    """The same of a stream, whose events of an episode come in order batch by batch; state is kept as JSON."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        state = json.loads(kept.get[0]) if kept.exists else fresh(**limits)
        frame = pd.concat(list(frames)).sort_values("ordinal")
        yield _rows(key[0], frame, state)
        kept.update((json.dumps(state),))

    return events.groupBy("episode").applyInPandasWithState(run, OUT, "state string", "append", GroupStateTimeout.NoTimeout)


def join_trace(record: dict, events: list[dict]) -> list[str]:
    """What does not agree between a projected episode and its trace: call ids, arguments, and the order of their events."""
    calls = {c["id"]: c for m in record.get("messages", []) for c in m.get("tool_calls") or []}
    traced, seen, out = {}, {}, []
    for k, e in enumerate(events):
        if e["event_type"] == "tool_call":
            traced[e["call_id"]] = (k, e)
        elif e["event_type"] == "tool_observation":
            seen[e["call_id"]] = k
    if set(calls) != set(traced):
        out.append("call_ids_differ")
    if set(traced) != set(seen):
        out.append("observations_differ")
    decided = {e.get("tool_name"): k for k, e in reversed(list(enumerate(events))) if e["event_type"] == "decision"}
    checks = [k for k, e in enumerate(events) if e["event_type"] == "verification"]
    for i, (k, e) in traced.items():
        own = calls.get(i, {}).get("function", {}).get("arguments", e.get("arguments"))
        out += [why for bad, why in (
            (own != e.get("arguments"), f"arguments_differ:{i}"), (decided.get(e["tool_name"], k + 1) > k, f"decision_after_call:{i}"),
            (seen.get(i, k + 1) < k, f"observation_before_call:{i}"), (bool(checks) and checks[-1] < seen.get(i, -1), f"verification_before_observation:{i}"),
        ) if bad]
    return out


def totals(broken: list[str | None]) -> Counter:
    return Counter(b for b in broken if b)
