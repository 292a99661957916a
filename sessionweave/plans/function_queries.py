"""Queries of scalar rules and of segments, with SQL where it can say the same."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sessionweave.functions import identity, text
from sessionweave.operators import curriculum, records, segments, transitions
from sessionweave.plans import fixture
from sessionweave.plans.record_queries import of_each
from sessionweave.plans.registry import query
from sessionweave.sources import files


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def picked(names) -> str:
    return "case event_id % {} {} end".format(len(names), " ".join(f"when {k} then {'null' if n is None else repr(n)}" for k, n in enumerate(names)))


def pick(names):
    return fixture.pick(F.col("event_id") % len(names), names)


_ROLES = ("human", " Developer ", "Tool Result", "BOT", "narrator", "", None)
_SOURCES = ("claude-code", "Cursor_Chat", "PI", "ohmypi", "none", None)
_TIERS = ("Frontier", "open source", "self-hosted", "TIER3", "what", None)


@query(f"""select event_id, case {picked(_ROLES)} when 'human' then 'user' when ' Developer ' then 'system' when 'Tool Result' then 'tool' when 'BOT' then 'assistant' end as role,
    case {picked(_SOURCES)} when 'claude-code' then 'claude' when 'Cursor_Chat' then 'cursor' when 'PI' then 'pi-agent' when 'ohmypi' then 'oh-my-pi' else 'unknown' end as provider,
    case {picked(_TIERS)} when 'Frontier' then 'tier1_frontier' when 'open source' then 'tier2_open_source' when 'self-hosted' then 'tier3_local' when 'TIER3' then 'tier3_local' end as tier,
    nullif(trim({picked(_ROLES)}), '') as token, replace(replace(lower({picked(_ROLES)}), '-', '_'), ' ', '_') as field from events""")
def fn_aliases(spark, sf_dir):
    role = pick(_ROLES)
    return events(spark, sf_dir).select(
        "event_id", identity.canonical_role(role).alias("role"), identity.canonical_provider(pick(_SOURCES)).alias("provider"), identity.canonical_tier(pick(_TIERS)).alias("tier"),
        identity.token(role).alias("token"), identity.field_key(role).alias("field"),
    )


_STATUS = ("Done", " ok", "CANCELED", "running", None)


@query(f"""with e as (select event_id, lower(trim({picked(_STATUS)})) as s, event_id % 3 as a, case when event_id % 5 = 0 then event_id % 2 end as b from events)
    select event_id, case when s in ('done', 'ok') then 'success' when s = 'canceled' then 'failure' else 'unknown' end as status, case when b is null or a = b then a end as code,
      case when b is null or a = b then 'structured_field' else 'conflicting_structured_fields' end as code_source,
      case when event_id % 4 = 0 then 'partial' when event_id % 4 = 1 then case when event_id % 2 = 0 then 'success' else 'failure' end else 'unknown' end as outcome from e""")
def fn_statuses(spark, sf_dir):
    i = F.col("event_id")
    code, source = text.result_code(F.array(i % 3, F.when(i % 5 == 0, i % 2)))
    outcome = text.outcome(F.when(i % 4 == 0, " Partial ").when(i % 4 == 2, "odd"), F.when(i % 4 == 1, i % 2 == 0))
    return events(spark, sf_dir).select("event_id", text.status_token(pick(_STATUS)).alias("status"), code.alias("code"), source.alias("code_source"), outcome.alias("outcome"))


_TOOLS = ("bash", "web_search", "code_indexer search", "git commit", "read_file", "thread_pool", "pytest run", "mcp: hover")


@query("select event_id, " + picked(("shell", "research", "code-indexer", "source-control", "filesystem", "unclassified", "shell,testing", "lsp,mcp")) + " as families from events")
def fn_tool_families(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.array_join(text.tool_families(F.array(pick(_TOOLS))), ",").alias("families"))


_HIDDEN = ("Sequential-Thinking", "scratch_pad", "hidden.reasoning", "exec", None)


@query(f"""select event_id, event_id % 5 in (0, 1, 2) as hidden, 'sha256:' || sha256('["' || event_type || '"]') as prompt_group, case when event_id % 3 = 0 then 'u' || event_id else 'sha256:' || sha256(props) end as unit_id,
    printf('call_a%04d_c%02d', event_id % 1000, event_id % 7) as call_id, '$.a[].b[]' as path, case when event_id % 2 = 0 then sha256(event_type) end as digest, sha256('run' || chr(0) || props) as signature from events""")
def fn_identities(spark, sf_dir):
    i = F.col("event_id")
    sha = identity.digest(F.col("event_type"))
    return events(spark, sf_dir).select(
        "event_id", text.hidden_tool(pick(_HIDDEN)).alias("hidden"), identity.user_group(F.lit(""), F.array("event_type")).alias("prompt_group"),
        identity.unit_id(F.col("props"), F.when(i % 3 == 0, F.concat(F.lit("u"), i.cast("string")))).alias("unit_id"), identity.call_label(i % 1000, i % 7).alias("call_id"),
        identity.open_path(F.concat(F.lit("$.a["), i.cast("string"), F.lit("].b[0]"))).alias("path"),
        identity.bare_digest(F.when(i % 2 == 0, F.concat(F.lit("SHA256:"), sha)).otherwise("no digest")).alias("digest"), identity.action_signature(F.lit("run"), F.col("props")).alias("signature"),
    )


_SHELL = ('["bash", "-lc", "ls -l"]', "bash -c 'cat a'", " plain ", '["git", "log"]')


@query(f"""select event_id, {picked(("ls -l", "cat a", "plain", "git log"))} as script, case when event_id % 2 = 0 then '/srv/app' end as folder, 'a,b' as tags,
    event_id % 9 as cap, 'v' || event_id as field, length('{{"a":' || event_id || ',"b":null}}') as size from events""")
def fn_texts(spark, sf_dir):
    i = F.col("event_id")
    n = i.cast("string")
    prefix = F.concat(F.lit('{"source": "v'), n, F.lit('", "source": "no", "cut": "off'))
    return events(spark, sf_dir).select(
        "event_id", text.unwrap_shell(pick(_SHELL)).alias("script"), text.project_folder(F.when(i % 2 == 0, "cwd: /srv/app now").otherwise("none here")).alias("folder"),
        F.array_join(identity.tag_values(F.array(F.lit("tool:b"), F.lit("x:y"), F.lit("tool:a"), F.lit("tool:b")), "tool:"), ",").alias("tags"),
        identity.caps(F.concat(F.lit("go=1, py="), (i % 9).cast("string")))["py"].alias("cap"), text.prefix_fields(prefix)["source"].alias("field"),
        identity.canonical_size(F.struct(i.alias("a"), F.lit(None).cast("string").alias("b"))).alias("size"),
    )


@query("""select doc_id, case when doc_id % 4 = 0 then 'kept' when doc_id % 4 = 1 then 'a  b' when doc_id % 4 = 2 then '' else 'tail' end as clean, (case when doc_id % 4 = 1 then 2 else 0 end)::bigint as markers from documents""")
def fn_reasoning_blocks(spark, sf_dir):
    said = fixture.pick(F.col("doc_id") % 4, ("kept", "a <thinking>hm</thinking> b", "<analysis>all of it", "```reasoning\nx\n``` tail"))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.clean(said).alias("clean"), text.marker_count(F.when(F.col("doc_id") % 4 == 1, said)).alias("markers"))


_PATHS = ("sessions/rollout-1.jsonl", "x/projects/agent-2.jsonl", "cache/a.lock", "opencode.db", "notes.json")
_OWNERS = ("codex", "claude", "opencode")


@query(f"""with e as (select event_id, {picked(_PATHS)} as p, {picked(_OWNERS)} as o from events)
    select event_id, case when p = 'opencode.db' then case when o = 'opencode' then 'conversation_store' else 'structured_candidate' end when p = 'notes.json' then 'structured_candidate'
        when p like 'cache/%' then 'support_state' when o = 'codex' and p like 'sessions/%' then 'session_active' when o = 'claude' and p like '%agent-%' then 'subagent_session'
        when o = 'claude' then 'session_active' else 'jsonl_candidate' end as class,
      case when p = 'opencode.db' and o = 'opencode' then 'candidate' when p like 'cache/%' then 'excluded' when o = 'codex' and p like 'sessions/%' then 'candidate' when o = 'claude' and p like '%.jsonl' then 'candidate' else 'review' end as treatment from e""")
def fn_file_classes(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", files.classify(pick(_OWNERS), pick(_PATHS)).alias("c")).select("event_id", "c.class", "c.treatment")


@query("""with e as (select event_id, (event_id * 7919) % 300 as n from events) select event_id, case when n <= 200 then 'full' else 'truncated' end as how, least(n, 200)::bigint as chars,
    case when n <= 200 then '' else chr(10) || '<CUT>' || chr(10) end as mark from e""")
def payload_bounding(spark, sf_dir):
    n = (F.col("event_id") * 7919) % 300
    body = text.bounded(F.repeat(F.lit("x"), n.cast("int")), 200, "\n<CUT>\n")
    return events(spark, sf_dir).select("event_id", F.when(n <= 200, "full").otherwise("truncated").alias("how"), F.length(body).cast("long").alias("chars"), F.regexp_replace(body, "x+", "").alias("mark"))


def cuts(record: dict) -> list[dict]:
    made = segments.variants(record, 1500)
    return [{"segment": v.get("_chunk_index", 0), "first": v.get("_chunk_message_start", 0), "last": v.get("_chunk_message_end", len(record["messages"]) - 1), "anchor": v.get("_chunk_anchor_message_index")} for v in made]


@query()
def rec_segments(spark, sf_dir):
    """Order-dependent: held against a plain loop in the tests."""
    return of_each(spark, sf_dir, cuts, "segment bigint, first bigint, last bigint, anchor bigint")


@query(f"with {fixture.SQL} select user_id, rec, count(*) as messages, sum(case when event_type = 'click' then 1 else 0 end)::bigint as calls from raw group by all")
def rec_message_sizes(spark, sf_dir):
    def rows(r):
        yield {"messages": len(r["messages"]), "calls": sum(len(segments.asked(m)) for m in r["messages"])}

    return of_each(spark, sf_dir, rows, "messages bigint, calls bigint")


_COMMANDS = ("ls -la", "git push", "sed -i s/a/b/ f", "rg x | head", "echo a > b")


@query(f"""select event_id, event_id % 5 in (0, 3) as reads, event_id % 5 in (1, 2, 4) as changes,
    case when event_id % 5 in (0, 3) then null when event_id % 3 = 0 then 'target_violates_no_mutation_instruction' when event_id % 3 = 1 then 'target_mutation_intent_unproven' end as policy from events""")
def action_policies(spark, sf_dir):
    asked = ("please do not edit anything", "explain this", "fix the bug")
    row = events(spark, sf_dir).select("event_id", F.to_json(F.struct(pick(_COMMANDS).alias("cmd"), pick(asked).alias("said"))).alias("row"))

    def rows(x):
        call = {"function": {"name": "exec_command", "arguments": {"cmd": x["cmd"]}}}
        messages = [{"role": "user", "content": x["said"]}, {"role": "assistant", "content": "", "tool_calls": [call]}]
        yield {"reads": curriculum.call_reads(call), "changes": curriculum.call_changes(call), "policy": curriculum.action_policy(messages)}

    return records.each(row, ["event_id"], "row", rows, "reads boolean, changes boolean, policy string")


_TYPES = ("str", "List[int]", "Union[int, float]", "bytes", "dict, optional")


@query("select event_id, " + picked(('{"type":"string"}', '{"items":{"type":"integer"},"type":"array"}', '{"type":"number"}', "tool_property_type_unsupported", '{"type":"object"}')) + " as schema from events")
def tool_types(spark, sf_dir):
    row = events(spark, sf_dir).select("event_id", F.to_json(F.struct(pick(_TYPES).alias("type"))).alias("row"))

    def rows(x):
        why = curriculum.reason_of(curriculum.json_type, x["type"])
        yield {"schema": why or records.canonical(curriculum.json_type(x["type"]))}

    return records.each(row, ["event_id"], "row", rows, "schema string")


@query("""with p as (select event_id, case event_id % 4 when 0 then null when 1 then 'lane_invalid' when 2 then 'tool_call_missing_required_argument' else 'target_not_assistant' end as reason from events) select * from p""")
def trainer_validation(spark, sf_dir):
    row = events(spark, sf_dir).select("event_id", F.to_json(F.struct((F.col("event_id") % 4).alias("k"))).alias("row"))
    schema = {"function": {"name": "find", "parameters": {"properties": {"q": {}}, "required": ["q"]}}}

    def rows(x):
        call = {"id": "c", "function": {"name": "find", "arguments": {} if x["k"] == 2 else {"q": 1}}}
        last = {"role": "user" if x["k"] == 3 else "assistant", "content": ""} | ({} if x["k"] == 3 else {"tool_calls": [call]})
        example = {
            "schema_version": curriculum.EXAMPLE_SCHEMA, "example_id": "e", "split": "train", "lane": "none" if x["k"] == 1 else "skill_policy",
            "messages": [{"role": "user", "content": "q"}, last], "tools": [schema],
        }
        yield {"reason": curriculum.reason_of(curriculum.check_example, json.loads(json.dumps(example)), "train")}

    return records.each(row, ["event_id"], "row", rows, "reason string")


_KINDS = ("skill_route", "skill_apply", "verified_finish", "read_only_report", "new")


@query("select event_id, " + picked(("required_skill_routing", "premature_stop_before_required_work", "verified_finish_over_unnecessary_continuation", "permission_read_only_boundary", "no_policy_negative:new")) + " as family from events")
def preference_negatives(spark, sf_dir):
    row = events(spark, sf_dir).select("event_id", F.to_json(F.struct(pick(_KINDS).alias("kind"))).alias("row"))
    call = {"id": "c", "function": {"name": "run", "arguments": {}}}
    example = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "", "tool_calls": [call]}, {"role": "assistant", "content": "done"}], "tools": [{"function": {"name": "apply_patch"}}]}

    def rows(x):
        why = curriculum.reason_of(curriculum.family_negative, example, x["kind"])
        yield {"family": why or curriculum.family_negative(example, x["kind"])[1]}

    return records.each(row, ["event_id"], "row", rows, "family string")


@query("select event_id, '" + "', '".join(()) + "exact' as strength from events where event_id % 4 = 0 union all select event_id, 'ordered' from events where event_id % 4 = 1 union all select event_id, 'heuristic' from events where event_id % 4 = 2 union all select event_id, 'absent' from events where event_id % 4 = 3")
def match_strengths(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", identity.aliased(pick(tuple(transitions.STRENGTH)), transitions.STRENGTH).alias("strength"))
