"""Rows for reviews and training: preferences, salvage, queues, replay tasks, cycles, packages and their checks.

Functions of one row, to be run by ``records.each``, and ledgers over flat tables.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionweave.operators import curriculum as rows
from sessionweave.operators.curriculum import Refused, need
from sessionweave.operators.records import SESSION_IDS, Cleaner, canonical, findings, first, metadata, model_tier, objects, provider, raw_messages, sha, stable_id, sub

#: Evidence of progress, and the family of a cycle by its distance.
PROGRESS = {"first_grounded_action", "post_failure_recovery", "first_mutation", "post_mutation_verification"}
CYCLES = {1: "immediate_repeat_to_progress", 2: "period_two_to_progress", 3: "period_three_to_progress"}
TIERS = ("tier1_frontier", "tier2_open_source", "tier3_local")


# Preferences told by a source.


def candidate(value, cleaner: Cleaner) -> list[dict]:
    """Messages of a preferred or rejected answer: text, an object of messages, or an object of content."""
    if isinstance(value, dict) and isinstance(value.get("messages"), list):
        return cleaner.messages({"messages": value["messages"]})[0]
    text = cleaner.text(value) if isinstance(value, str) else cleaner.shown(value) if isinstance(value, dict) else ""
    return [{"role": "assistant", "content": text}] if text else []


def preference(record: dict) -> dict | None:
    """A pair that a record tells of by name; the prompt is told, or its system and user messages."""
    of, c = sub(record, "preference") or record, Cleaner()
    sides = [next((of[k] for k in (side, f"{side}_response") if of.get(k) is not None), None) for side in ("chosen", "rejected")]
    if None in sides:
        return None
    if of.get("prompt") is not None:
        prompt = candidate(of["prompt"], c)
        prompt = [{"role": "user", "content": prompt[0]["content"]}] if prompt and prompt[0]["role"] == "assistant" else prompt
    else:
        prompt = [m for m in c.messages({"messages": raw_messages(record) or []})[0] if m["role"] in ("system", "user")]
    chosen, rejected = (candidate(s, c) for s in sides)
    if not (prompt and chosen and rejected):
        return None
    body = {"prompt": prompt, "chosen": chosen, "rejected": rejected}
    return {"example_id": stable_id({"dataset": "preference", "session": first(record, SESSION_IDS)} | body)} | body


# Salvage of canonical rows.


def lineage_values(row: dict, binding: dict, line: int, row_sha: str) -> dict:
    """Where a salvaged row comes from, under one set of names."""
    of = sub(row, "metadata") | sub(row, "lineage")
    parent = next(((of[k], k) for k in ("parent_record_sha256", "source_record_sha256", "session_id") if isinstance(of.get(k), str) and of[k]), (None, "missing"))
    return {
        "source_id": binding["id"], "source_sha256": binding["sha256"], "source_line": line, "source_row_sha256": row_sha, "parent": parent[0], "parent_basis": parent[1],
        "parser_revision": of.get("parser_revision"),
    }


def context(row: dict, binding: dict, line: int, row_sha: str) -> dict:
    """What decides over a salvaged row: provider, tier, gate, lane and parent."""
    of, quality = sub(row, "metadata"), sub(row, "quality")
    tier, basis, _ = model_tier(of | {"source": of.get("provider")})
    return {
        "provider": provider({"source": of.get("provider") or binding.get("provider")}), "tier": tier, "tier_basis": basis,
        "gate": quality.get("session_quality_gate") or of.get("quality_gate") or "unspecified", "lane": of.get("training_lane") or "primary",
    } | lineage_values(row, binding, line, row_sha)


def sft_candidate(row: dict, of: dict) -> tuple[dict | None, list[str]]:
    """A view of a row for training, or all the reasons against it."""
    found = findings(row)
    redactions = int(sub(row, "metadata").get("structural_redactions") or 0) + int(sub(row, "privacy").get("structural_redactions") or 0)
    checks = {
        "dataset_not_sft": row.get("dataset") != "sft", "tool_activity_not_sft": rows.tool_activity(row), "quality_gate_not_candidate": of["gate"] != "candidate",
        "model_tier_unclassified": of["tier"] not in TIERS, "parent_identity_missing": of["parent"] is None, "privacy_redactions_present": redactions > 0,
        "reasoning_content_present": found["hidden_keys"] > 0, "privacy_marker_finding": any(found[k] for k in ("trainer_blocker", "tool_observation_review", "unknown_context_review")),
        "hard_privacy_finding": any(found[k] for k in ("hidden_keys", "raw_keys", "secret_keys", "secret_values", "private_values")),
    }
    reasons = sorted(k for k, hit in checks.items() if hit)
    if reasons:
        return None, reasons
    why = rows.reason_of(rows.trainer_view, row)
    return (None, [f"trainer_contract:{why}"]) if why else (rows.trainer_view(row) | {"split": "pending"}, ["sft_candidate_eligible"])


def event_pairs(events: list[dict]) -> list[dict]:
    """The k-th action of a call id with its k-th observation."""
    seen: dict = {}
    for e in events:
        if e.get("kind") == "observation":
            seen.setdefault(e.get("call_id"), []).append(e)
    out = []
    for e in events:
        if e.get("kind") == "action":
            answers = seen.get(e.get("call_id"), [])
            o = answers.pop(0) if answers else None
            out.append({"call_id": e.get("call_id"), "name": e.get("name"), "input": e.get("input"), "observed": o is not None, "output": None if o is None else o.get("output")})
    return out


def tool_review(row: dict, of: dict, split: str) -> dict:
    """A row for the review of tool use: everything of any shape as JSON text, nothing authorized."""
    return {
        "review_id": stable_id([of["source_row_sha256"], row.get("example_id")]), "split": split, "training_authorized": False, "decision": "pending",
        "messages_json": canonical(row.get("messages") or []), "event_pairs_json": canonical(event_pairs(objects(row.get("events") or []))),
    } | {k: of[k] for k in ("provider", "tier", "gate", "lane", "parent")}


def queue_row(row: dict, raw: str, manifest_sha: str, split: str, registry: set[str] | None) -> dict:
    """A task of the queue for tool schemas: pairs, names, registry status and what blocks a replay."""
    pairs, events = event_pairs(objects(row.get("events") or [])), objects(row.get("events") or [])
    names = sorted({str(p["name"]) for p in pairs if p["name"]})
    known = sorted(set(names) & (registry or set()))
    whole = all(p["observed"] for p in pairs) and len(pairs) == sum(e.get("kind") == "observation" for e in events)
    private = sub(row, "privacy").get("eligible_for_training") is not True
    blockers = [b for b, hit in (("privacy_review_required", private), ("observation_edges_incomplete", not whole), ("registry_unbound", True), ("verifier_missing", True)) if hit]
    return {
        "queue_id": stable_id([manifest_sha, sha(raw), row.get("example_id")]), "split": split, "action_names": names, "pairs_json": canonical(pairs), "candidates": known,
        "registry_status": "not_provided" if registry is None else "name_candidate_unbound" if known else "no_name_candidate", "blockers": blockers, "training_authorized": False,
        "parent": str(sub(row, "lineage").get("parent_record_sha256") or ""), "provider": str(row.get("provider") or sub(row, "metadata").get("provider") or ""),
    }


def workspaces(pairs: list[dict]) -> list[str]:
    """Work folders and paths that action inputs name."""
    found = set()
    for p in pairs:
        given = p.get("input")
        if isinstance(given, str):
            try:
                given = json.loads(given)
            except ValueError:
                continue
        found |= {given[k] for k in ("workdir", "path") if isinstance(given, dict) and isinstance(given.get(k), str) and given[k]}
    return sorted(found)


def replay_task(task: dict, registry: set[str]) -> dict:
    """A queued task as a replay decision: always blocked here, with all that blocks it."""
    pairs = json.loads(task["pairs_json"])
    matched = sorted(set(task["action_names"]) & registry)
    reasons = {"registry_call_identity_unbound" if matched else "registry_name_unmatched", "workspace_snapshot_unbound", "verifier_not_provided", "privacy_review_required"}
    return {
        "queue_id": task["queue_id"], "matches": matched, "binding": "blocked_call_identity_unbound" if matched else "blocked_no_exact_registry_match",
        "workspaces": workspaces(pairs), "decision": "blocked", "reasons": sorted(reasons),
    }


def reproject(row: dict, lineage: dict, source: str, manifest_sha: str) -> tuple[dict, dict]:
    """A row of another release under an id and a parent of this one, with its lineage."""
    out = row | {"example_id": stable_id({"source_manifest": manifest_sha, "example_id": row["example_id"]})}
    rows.clean_text(out)
    rows.check_example(out, out["split"])
    parent = lineage.get("parent_id")
    need(isinstance(parent, str) and parent, "source_parent_identity_missing")
    return out, {"example_id": out["example_id"], "parent_id": f"{source}:{parent}", "source_partition": source, "source_example_id": row["example_id"], "source_lane": row["lane"]}


def historical_candidate(row: dict, split: str) -> tuple[dict | None, str | None]:
    """A finished trajectory as a candidate of its closing answer, or why it is none."""
    try:
        summary = rows.event_summary(objects(row.get("events") or []))
        prompt, answer = rows.final_answer(row.get("messages") or [])
    except Refused as why:
        return None, str(why)
    safe = rows.loader_safe(row)
    return {"example_id": stable_id([prompt, answer]), "split": split, "prompt": prompt, "completion": [answer], "calls": summary["calls"], "events": safe["events"]}, None


def trainer_example(row: dict, parent_sha: str, fraction: float = 0.1) -> dict:
    """A window as an example: its split by parent, its lineage, and the decision that let it in."""
    prompt, completion = rows.prompt_completion(row)
    split = "validation" if int(parent_sha[:8], 16) % 100 < round(fraction * 100) else "train"
    messages = rows.strict_messages([*prompt, completion])
    return {"example_id": stable_id([parent_sha, messages]), "split": split, "messages": messages, "parent_sha256": parent_sha, "decision": "selected"}


def rendered(record: dict, most: int = 100_000) -> str | None:
    """A conversation as compact JSON of allowed fields, cleaned; None if nothing of it is seen or it is too long."""
    c = Cleaner()
    messages = [{"role": m["role"], "content": m["content"]} for m in c.messages(record)[0] if m["content"]]
    kept = {k: v for k, v in metadata(record, "", c).items() if k in ("model", "mode", "title")}
    text = canonical({"messages": messages} | kept)
    return text if messages and len(text) <= most else None


def without_root(value, root: str):
    """Any JSON value without the folder of a checkout."""
    if isinstance(value, str):
        return value.replace(root.rstrip("/") + "/", "").replace(root.rstrip("/"), ".")
    if isinstance(value, list):
        return [without_root(v, root) for v in value]
    return {k: without_root(v, root) for k, v in value.items()} if isinstance(value, dict) else value


def skill_rows(cases: list[dict], skills: dict[str, str], schemas: dict[str, dict]) -> Iterator[dict]:
    """Policy rows of stated cases: each names the skill it reads and the tools it may use."""
    for case in cases:
        tools = [{"type": "function", "function": {"name": n, "parameters": schemas[n]}} for n in case["tools"]]
        messages = [{"role": "user", "content": case["prompt"]}]
        if case.get("skill"):
            call = {"id": "call_skill", "type": "function", "function": {"name": "read_skill", "arguments": {"name": case["skill"]}}}
            messages += [{"role": "assistant", "content": "", "tool_calls": [call]}, {"role": "tool", "content": skills[case["skill"]], "tool_call_id": "call_skill"}]
        row = {"schema_version": rows.EXAMPLE_SCHEMA, "split": case["split"], "lane": "skill_policy", "messages": [*messages, case["target"]], "tools": tools}
        row["example_id"] = stable_id(row)
        rows.check_example(row, case["split"])
        yield row


# Cycles.


def cycle_pair(row: dict, source: dict, distance: int, tokens: Callable[[list[dict]], int], most: int) -> tuple[dict, dict]:
    """The action of some turns ago against the one that made progress, with as many turns before as fit."""
    prompt, chosen = row["messages"][:-1], row["messages"][-1]
    base, turns = rows.split_prompt(prompt)
    need(len(turns) >= distance, "insufficient_prior_actions")
    path = turns[-distance:]
    need(all(t["complete"] for t in path), "cycle_path_observation_incomplete")
    need(all(t["read_only"] for t in path), "cycle_path_contains_mutation")
    old = path[0]["action"]
    need(rows.signature(old) != rows.signature(chosen), "chosen_revisits_cycle_action")
    need(rows.repeat_distance(prompt, old) == distance, "rejected_action_nearest_distance_mismatch")
    need(set(source.get("selection_categories") or []) & PROGRESS, "chosen_action_not_progress_backed")
    need(source.get("outcome") == "resolved", "source_outcome_not_resolved")
    for kept in range(len(turns), distance - 1, -1):
        context_ = [*base, *(m for t in turns[-kept:] for m in t["chunk"])]
        made = rows.pair(row["split"], "state_transition_preference", context_, chosen, rows.again(old), row["tools"], {"source": row["example_id"], "distance": distance, "kept": kept})
        if max(tokens([*context_, *made[side]]) for side in ("chosen", "rejected")) <= most:
            return made, {"pair_id": made["pair_id"], "parent_id": source["parent_id"], "family": CYCLES[distance], "kept_turns": kept}
    raise Refused("no_turns_fit")


def cycle_candidates(row: dict, source: dict, tokens: Callable[[list[dict]], int], most: int) -> Iterator[tuple[int, dict | None, str | None]]:
    """For each distance the pair, or why there is none."""
    for distance in (1, 2, 3):
        try:
            yield distance, cycle_pair(row, source, distance, tokens, most)[0], None
        except Refused as why:
            yield distance, None, str(why)


# Packages.


def rejoined(selected: DataFrame, raw: DataFrame, place: str, row_sha: str, projected: Column) -> DataFrame:
    """Selected rows with the raw rows they were made of; the digest and the projection must still agree."""
    r = raw.select(F.col(place).alias("__p"), F.col(row_sha).alias("__s"), projected.alias("__v"))
    both = selected.join(r, F.col(place) == F.col("__p"), "left")
    why = F.when(F.col("__p").isNull(), "source_row_missing").when(F.col(row_sha) != F.col("__s"), "source_row_changed").when(F.col("projection") != F.col("__v"), "projection_changed")
    return both.withColumn("reason", why).drop("__p", "__s", "__v")


def inherited(pairs: DataFrame, lineage: DataFrame, partitions: list[str]) -> DataFrame:
    """Pairs of a base release that some partitions pass on, with their lineage."""
    return pairs.join(lineage.filter(F.col("source_partition").isin(*partitions)), "pair_id")


def composed(parts: dict[str, DataFrame], split_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packages under one split by parent, and what keeps them apart: repeated ids, parents without a split."""
    from sessionweave.operators.release import union_lanes, union_violations

    union = union_lanes(parts, "package").drop("split").join(split_of.select("parent", "split"), "parent", "left")
    lost = union.filter("split is null").select(F.lit("parent_without_split").alias("reason"), F.col("parent").cast("string").alias("value")).distinct()
    return union, union_violations(union, "id", "parent", "split").unionByName(lost)


def package_faults(package: DataFrame, told: dict, columns: list[str]) -> DataFrame:
    """What is wrong with a package as a loader sees it, as ``(reason, n)``: counts, columns, ids, parents, rewards."""
    n = package.agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), F.count_if(F.col("reward").isNotNull()).alias("rewarded") if "reward" in package.columns else F.lit(0).alias("rewarded"),
    )
    apart = package.groupBy("parent").agg(F.count_distinct("split").alias("n")).agg(F.count_if(F.col("n") > 1).alias("parents"))
    extra = len(set(package.columns) ^ set(columns))
    checks = F.array(*(F.struct(F.lit(name).alias("reason"), c.cast("long").alias("n")) for name, c in (
        ("record_count_differs", F.abs(F.col("rows") - told["records"])), ("id_repeated", F.col("rows") - F.col("ids")), ("reward_present", F.col("rewarded")),
        ("parent_in_two_splits", F.col("parents")), ("columns_differ", F.lit(extra)),
    )))
    # One row meets one row.
    return n.withColumn("__k", F.lit(1)).join(apart.withColumn("__k", F.lit(1)), "__k").select(F.explode(checks).alias("x")).select("x.*").filter("n > 0")


def named_in(names: DataFrame, registry: set[str]) -> DataFrame:
    """Action names that a registry holds."""
    return names.withColumn("matches", F.array_sort(F.array_intersect("names", F.array(*(F.lit(r) for r in sorted(registry))).cast("array<string>"))))


def plain_name(text: str) -> str:
    return re.sub("[^a-z0-9]+", "-", text.lower()).strip("-")
