"""Queries over raw session records; the SQL states from ``events`` what each record must become."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.functions import identity, text
from sessionweave.operators import records
from sessionweave.plans import fixture
from sessionweave.plans.registry import query

KEYS = ["user_id", "rec"]


def of_each(spark, sf_dir, fn, schema: str) -> DataFrame:
    return records.each(fixture.records(spark, sf_dir), KEYS, "record", fn, schema)


def both(record: dict) -> tuple[list[dict], list[dict]]:
    """Messages and events of a record."""
    c = records.Cleaner()
    messages, kept = c.messages(record)
    return messages, c.events(record, kept)


@query(f"""with {fixture.SQL} select user_id, rec, position, role, content, (calls)::int as n_calls,
    case when event_type = 'purchase' then 'c' || k end as tool_call_id from msg""")
def rec_messages(spark, sf_dir):
    def rows(r):
        for k, m in enumerate(records.Cleaner().messages(r)[0]):
            yield {"position": k, "role": m["role"], "content": m["content"], "n_calls": len(m["calls"]), "tool_call_id": m["tool_call_id"]}

    return of_each(spark, sf_dir, rows, "position bigint, role string, content string, n_calls int, tool_call_id string")


@query(f"""with {fixture.SQL} select user_id, rec, position, 'c' || k as call_id, tool as name, '{{"cmd":"ls ' || i || '"}}' as arguments from msg where calls""")
def rec_tool_calls(spark, sf_dir):
    def rows(r):
        for k, m in enumerate(records.Cleaner().messages(r)[0]):
            yield from ({"position": k, "call_id": c["id"], "name": c["name"], "arguments": records.canonical(c["arguments"])} for c in m["calls"])

    return of_each(spark, sf_dir, rows, "position bigint, call_id string, name string, arguments string")


@query(f"""with {fixture.SQL}, s as (
      select *, (value > 50)::int as code, case when i % 11 = 0 then 'structured_error' when i % 7 = 0 then 'structured_status' else 'structured_result_code' end as basis
      from msg where event_type = 'purchase')
    select user_id, rec, position as message_index, 'action' as kind, 'c' || k as call_id, tool as name, 'unknown' as status, 'absent' as status_source,
      null::bigint as result_code, sha256('{{"cmd":"ls ' || i || '"}}') as payload from msg where calls
    union all
    select user_id, rec, position, 'observation', 'c' || k, 'unknown', case when i % 11 <> 0 and i % 7 = 0 and code = 0 then 'unknown' when i % 11 = 0 or i % 7 = 0 or code = 1 then 'failure' else 'success' end,
      case when i % 11 <> 0 and i % 7 = 0 and code = 0 then 'conflicting_structured_evidence' else basis end, code, sha256('"out ' || i || '"') from s""")
def rec_events(spark, sf_dir):
    def rows(r):
        for e in both(r)[1]:
            yield {k: e.get(k) for k in ("message_index", "kind", "call_id", "name", "status", "status_source", "result_code")} | {"payload": records.sha(e["payload"])}

    return of_each(spark, sf_dir, rows, "message_index bigint, kind string, call_id string, name string, status string, status_source string, result_code bigint, payload string")


@query(f"""with {fixture.SQL}, h as (select user_id, rec, count(*) filter (event_type = 'click' and role is not null) as clicks,
      count(*) filter (event_type = 'click' and role is not null and tool = 'sequential_thinking') as thought,
      count(*) filter (role is null) as dropped, count(*) filter (event_type = 'error' and role is not null and i % 4 = 0) as blocks,
      count(*) filter (event_type = 'view' and role is not null and i % 3 = 1) + 2 * count(*) filter (event_type = 'view' and role is not null and i % 3 = 2) as redactions from raw group by all)
    select user_id, rec, dropped::bigint as dropped, blocks::bigint as blocks, (thought + clicks)::bigint as fields, redactions::bigint as redactions from h""")
def rec_normalization_counts(spark, sf_dir):
    def rows(r):
        c = records.Cleaner()
        c.messages(r)
        yield {k: c.counts[k] for k in ("dropped", "blocks", "fields", "redactions")}

    return of_each(spark, sf_dir, rows, "dropped bigint, blocks bigint, fields bigint, redactions bigint")


@query(f"with {fixture.SQL} select user_id, rec, 1::bigint as n, 'exec_command' as names, 1::bigint as hidden from rec where user_id % 3 = 0")
def rec_tool_schemas(spark, sf_dir):
    def rows(r):
        c = records.Cleaner()
        made = c.schemas(r)
        if made:
            yield {"n": len(made), "names": ",".join(records.tool_name(s["function"]) for s in made), "hidden": c.counts["fields"]}

    return of_each(spark, sf_dir, rows, "n bigint, names string, hidden bigint")


_PROVIDER = "case user_id % 6 when 0 then 'claude' when 1 then 'codex' when 2 then 'cursor' when 3 then 'pi-agent' else 'unknown' end"
_OUTCOME = "case rec % 4 when 0 then 'success' when 1 then 'partial' when 2 then 'success' else 'unknown' end"


@query(f"""with {fixture.SQL} select user_id, rec, {_PROVIDER} as provider, {_OUTCOME} as outcome, case when rec % 4 = 3 then 'unscored' else 'explicit' end as outcome_source,
    case when rec % 3 = 0 then 1.5 end::double as reward, case when rec % 3 = 0 then 'source' else 'unscored' end as reward_source from rec""")
def rec_outcomes(spark, sf_dir):
    def rows(r):
        (o, os), (w, ws) = records.outcome(r), records.reward(r)
        yield {"provider": records.provider(r), "outcome": o, "outcome_source": os, "reward": w, "reward_source": ws}

    return of_each(spark, sf_dir, rows, "provider string, outcome string, outcome_source string, reward double, reward_source string")


#: Tier, basis and conflict of a record in SQL: declared by user_id % 7, models by user_id % 5.
_TIER = """case when user_id % 7 in (0, 1) and user_id % 5 = 2 and user_id % 7 <> 1 then 'unclassified' when user_id % 7 = 0 then 'tier1_frontier' when user_id % 7 = 1 then 'tier3_local'
    when user_id % 5 = 2 then 'tier3_local' when user_id % 5 in (0, 3) then 'tier1_frontier' when user_id % 5 = 1 then 'tier2_open_source' else 'unclassified' end"""
_CONFLICT = "(user_id % 7 = 0 and user_id % 5 = 2)"
_BASIS = f"""case when {_CONFLICT} then 'conflicting_declared_and_local_provenance' when user_id % 7 in (0, 1) then 'adapter_declared' when user_id % 5 = 2 then 'inferred_local_provenance_marker'
    when user_id % 5 in (0, 3) then 'model_registry:frontier_model_family' when user_id % 5 = 1 then 'model_registry:open_source_model_family' else 'missing_authoritative_tier' end"""


@query(f"with {fixture.SQL} select user_id, rec, {_TIER} as tier, {_BASIS} as basis, {_CONFLICT} as conflict from rec")
def rec_model_tiers(spark, sf_dir):
    return of_each(spark, sf_dir, lambda r: [dict(zip(("tier", "basis", "conflict"), records.model_tier(r)))], "tier string, basis string, conflict boolean")


@query(f"""with {fixture.SQL} select case user_id % 5 when 0 then 'optional_alt' when 1 then 'quarantine' else 'primary' end as lane,
    case user_id % 7 when 0 then 'tier1_frontier' when 1 then 'tier3_local' end as declared, {_PROVIDER} as provider, count(*) as records from rec group by all""")
def rec_lane_selection(spark, sf_dir):
    field = lambda k: F.get_json_object("record", f"$.{k}")
    return fixture.records(spark, sf_dir).select(
        identity.lane(field("training_lane")).alias("lane"), identity.canonical_tier(field("model_tier")).alias("declared"),
        identity.canonical_provider(field("source")).alias("provider"),
    ).groupBy("lane", "declared", "provider").agg(F.count("*").alias("records"))


#: Flags of a record by its messages, and its gate.
_FLAGS = f"""
    ids as (
      select user_id, rec, list_distinct(list('c' || k) filter (calls)) as asked, list_distinct(list('c' || k) filter (event_type = 'purchase')) as told,
             count(*) filter (role = 'user') as users, count(*) filter (role = 'assistant') as assistants, count(*) as n from msg group by all
    ), fl as (
      select r.user_id, r.rec, coalesce(n, 0) as n, list_sort(list_filter([
          case when coalesce(n, 0) = 0 then 'no_normalized_messages' end, case when coalesce(users, 0) = 0 then 'missing_user_objective' end,
          case when coalesce(assistants, 0) = 0 then 'missing_visible_assistant_response' end,
          case when len(list_filter(coalesce(asked, []), lambda x: not list_contains(coalesce(told, []), x))) > 0 then 'unmatched_tool_calls' end,
          case when len(list_filter(coalesce(told, []), lambda x: not list_contains(coalesce(asked, []), x))) > 0 then 'unmatched_tool_observations' end,
          case when r.rec % 9 = 5 then 'payload_truncated' end, case when r.user_id % 5 = 2 then 'model_provenance_local_or_self_hosted' end,
          case when r.user_id % 5 = 4 then 'model_provenance_unknown' end, case when r.rec % 4 = 3 then 'outcome_unverified' end,
          case when {_TIER.replace('user_id', 'r.user_id')} = 'unclassified' then 'model_tier_unclassified' end, case when {_CONFLICT.replace('user_id', 'r.user_id')} then 'conflicting_model_tiers' end
        ], lambda x: x is not null)) as seen
      from rec r left join ids i on r.user_id = i.user_id and r.rec = i.rec
    ), judged as (
      select user_id, rec, case when user_id % 10 = 3 then ['by_hand', 'seen'] else seen end as flags,
        case when user_id % 10 = 3 then 'review_required' when n = 0 then 'quarantine'
          when len(list_intersect(seen, [{', '.join(repr(b) for b in sorted(records.BLOCKING))}])) > 0 then 'review_required' else 'candidate' end as gate
      from fl
    )"""


@query(f"""with {fixture.SQL}, {_FLAGS} select user_id, rec, gate as automatic_gate, case when user_id % 50 = 7 then 'quarantine' else gate end as gate,
    array_to_string(flags, ',') as flags from judged""")
def rec_quality_gates(spark, sf_dir):
    def rows(r):
        override = {"quality_gate": "quarantine"} if int(r["session_id"][1:]) % 50 == 7 else None
        a = records.assessment(r, *both(r), override)
        yield {"automatic_gate": a["automatic_gate"], "gate": a["gate"], "flags": ",".join(a["flags"])}

    return of_each(spark, sf_dir, rows, "automatic_gate string, gate string, flags string")


@query(f"""with {fixture.SQL} select user_id, rec, least(greatest(rec, 0), 4)::bigint as index, case when rec = 0 then 'start' when rec >= 4 then 'end' else 'middle' end as continuation,
    case when rec > 0 then sha256('s' || user_id) else 'own' end as parent from rec""")
def rec_lineage(spark, sf_dir):
    def rows(r):
        of = records.lineage(r, "own")
        yield {k: of[k] for k in ("index", "continuation", "parent")}

    return of_each(spark, sf_dir, rows, "index bigint, continuation string, parent string")


@query(f"""with {fixture.SQL} select user_id, rec, 'sha256:' || sha256('"s' || user_id || '"') as session_id, 'sha256:' || sha256('"/srv/u' || user_id || '"') as cwd_sha256,
    case user_id % 5 when 0 then 'optional_alt' when 1 then 'weird' end as training_lane, model, case when user_id % 4 = 1 then 'plan Mode!' end as mode from rec""")
def rec_metadata(spark, sf_dir):
    names = ("session_id", "cwd_sha256", "training_lane", "model", "mode")

    def rows(r):
        of = records.metadata(r, "own", records.Cleaner())
        yield {k: of.get(k) for k in names}

    return of_each(spark, sf_dir, rows, ", ".join(f"{n} string" for n in names))


@query(f"""with {fixture.SQL}, {_FLAGS}, k as (
      select user_id, rec, bool_or(calls or event_type = 'purchase') as tools, bool_or(event_type = 'view' and i % 3 = 2) as claude, coalesce(string_agg(lower(content), chr(10)) filter (role = 'user'), '') as said
      from msg group by all), t as (
      select j.*, coalesce(tools, false) as tools, coalesce(claude, false) as claude,
        case when contains(said, 'failing') then 'debugging' when contains(said, 'what is') then 'question' when contains(said, 'implement') then 'code-edit' else 'unknown' end as family
      from judged j left join k using (user_id, rec))
    select user_id, rec, array_to_string(list_sort(list_filter(list_concat([
        'provider:' || {_PROVIDER}, 'task:' || family, 'outcome:' || {_OUTCOME}, 'privacy:heuristic', 'privacy:review', 'has:reasoning-removed', 'quality-scope:source-session',
        'lane:' || case user_id % 5 when 0 then 'optional_alt' when 1 then 'weird' else 'primary' end, 'tier:' || replace({_TIER}, '_', '-'),
        case when claude then 'provider-mention:anthropic' end, case when claude then 'content:provider-specific' end, case when tools then 'has:tools' end,
        case when user_id % 4 = 1 then 'mode:plan-mode' end, 'quality-gate:' || gate], list_transform(flags, lambda f: 'quality-flag:' || f)), lambda x: x is not null)), ' ') as tags from t""")
def rec_tags(spark, sf_dir):
    families = text.TASK_FAMILIES

    def rows(r):
        messages, events = both(r)
        said = "\n".join(m["content"] for m in messages if m["role"] == "user").lower()
        family = next((f for f, words in families.items() if any(w in said for w in words)), "unknown")
        yield {"tags": " ".join(records.tags(r, messages, events, records.assessment(r, messages, events), family))}

    return of_each(spark, sf_dir, rows, "tags string")


@query(f"""with {fixture.SQL}, v as (select user_id, rec, count(*) filter (event_type = 'view' and i % 3 > 0) as private, 2 * count(*) filter (event_type = 'error' and i % 4 = 0 and i % 29 > 0) as unknown,
      2 * count(*) filter (event_type = 'error' and i % 4 = 0 and i % 29 = 0) as narrated from raw group by all)
    select user_id, rec, (user_id % 8 = 0)::bigint as hidden_keys, 2::bigint as private_keys, 0::bigint as secret_keys, private::bigint as private_values,
      (unknown + narrated)::bigint as unknown_context_review, 0::bigint as trainer_blocker from v""")
def rec_firewall(spark, sf_dir):
    names = ("hidden_keys", "private_keys", "secret_keys", "private_values", "unknown_context_review", "trainer_blocker")

    def rows(r):
        found = records.findings(r)
        yield {k: found[k] for k in names}

    return of_each(spark, sf_dir, rows, ", ".join(f"{n} bigint" for n in names))


@query(f"""with {fixture.SQL} select user_id, rec, array_to_string(list_filter([case when user_id % 2 = 1 then 'source_digest_missing' end, case when user_id % 4 > 0 then 'snapshot_revision_missing' end,
    case when user_id % 3 > 0 then 'parser_revision_missing' end, case when rec % 2 = 1 then 'source_or_message_range_missing' end], lambda x: x is not null), ',') as gaps from rec""")
def rec_lineage_gaps(spark, sf_dir):
    return of_each(spark, sf_dir, lambda r: [{"gaps": ",".join(records.lineage_gaps(r))}], "gaps string")


@query(f"""with {fixture.SQL}, c as (select user_id, rec, k, count(*) filter (event_type = 'click') as a, count(*) filter (event_type = 'purchase' and false) as b from raw group by all),
    s as (select user_id, rec, sum(a) as calls, sum(greatest(a - b, 0)) as unmatched, sum(greatest(a - 1, 0)) as repeated from c group by all)
    select user_id, rec, calls::bigint as calls, 0::bigint as results, unmatched::bigint as unmatched_calls, repeated::bigint as duplicate_calls, 0::bigint as missing_calls from s""")
def rec_tool_edges(spark, sf_dir):
    names = ("calls", "results", "unmatched_calls", "duplicate_calls", "missing_calls")

    def rows(r):
        of = records.tool_edges(r)  # roles are raw here: ``tool_result`` is none that counts
        yield {k: of[k] for k in names}

    return of_each(spark, sf_dir, rows, ", ".join(f"{n} bigint" for n in names))


@query(f"""with {fixture.SQL} select user_id, rec, sha256('{{"identity":{{"session_id":"s' || user_id || '"}},"source_file_sha256":"f"}}') as session_key, 's' || user_id as unit_id from rec""")
def rec_session_keys(spark, sf_dir):
    return of_each(spark, sf_dir, lambda r: [{"session_key": records.session_key(r, "f"), "unit_id": records.unit_id(r)}], "session_key string, unit_id string")


#: What a session's records add up to: ids stay open that an odd number of records leaves unanswered on one side.
_SESSION = f"""
    per as (
      select user_id, rec, k, bool_or(event_type = 'click' and tool <> 'sequential_thinking') as asked, bool_or(event_type = 'purchase' and role is not null) as told
      from raw where event_type in ('click', 'purchase') group by all
    ), n as (
      select user_id, (select count(*) from rec r where r.user_id = msg.user_id) as records, count(*) as messages, count(*) filter (role = 'user') as users, count(*) filter (role = 'assistant') as assistants from msg group by all
    ), ends as (
      select user_id, count(*) filter (event_type = 'purchase' and role is not null) as observations,
             count(*) filter (event_type = 'purchase' and (i % 7 = 0 or i % 11 = 0)) as errors from raw group by all
    )"""


@query(f"""with {fixture.SQL}, {_SESSION} select user_id, records::bigint as records, messages::bigint as messages, users::bigint as users, assistants::bigint as assistants,
    observations::bigint as observations, errors::bigint as errors from n join ends using (user_id)""")
def rec_session_totals(spark, sf_dir):
    def rows(r):
        messages, _ = both(r)
        e = records.evidence(r)
        yield {
            "messages": len(messages), "users": sum(m["role"] == "user" for m in messages), "assistants": sum(m["role"] == "assistant" for m in messages),
            "observations": e["n_observations"], "errors": e["errors"],
        }

    names = ("messages", "users", "assistants", "observations", "errors")
    per = of_each(spark, sf_dir, rows, ", ".join(f"{n} bigint" for n in names))
    return per.groupBy("user_id").agg(F.count("*").alias("records"), *(F.sum(n).alias(n) for n in names))


@query(f"""with {fixture.SQL}, {_SESSION}, net as (select user_id, rec, k, (asked and not told)::int - (told and not asked)::int as d from per),
    run as (
      select user_id, k, list(d order by rec) filter (d <> 0) as ds from net group by all
    )
    select user_id, count(*) filter (list_sum(ds) > 0)::bigint as open_calls, count(*) filter (list_sum(ds) < 0)::bigint as open_results
    from (select user_id, k, list_reduce(list_prepend([0], list_transform(ds, lambda x: [x])), lambda s, x: [greatest(-1, least(1, s[1] + x[1]))]) as ds from run where ds is not null) group by user_id
    union all select distinct user_id, 0, 0 from ev where user_id not in (select user_id from net where d <> 0)""")
def rec_pending_ids(spark, sf_dir):
    """Ids left open when a session's records are taken in order; ids are bounded by what one session leaves open."""
    ids = of_each(spark, sf_dir, lambda r: [{k: records.evidence(r)[k] for k in ("actions", "observations")}], "actions array<string>, observations array<string>")
    entry = F.struct("rec", "actions", "observations")
    folded = ids.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("s"))
    empty = F.struct(F.array().cast("array<string>").alias("a"), F.array().cast("array<string>").alias("o"))

    def step(state, x):
        asked, told = F.array_except(x["actions"], x["observations"]), F.array_except(x["observations"], x["actions"])
        a = F.array_union(F.array_except(state["a"], told), F.array_except(asked, state["o"]))
        o = F.array_union(F.array_except(state["o"], asked), F.array_except(told, state["a"]))
        return F.struct(a.alias("a"), o.alias("o"))

    left = F.aggregate("s", empty, step)
    return folded.select("user_id", F.size(left["a"]).cast("long").alias("open_calls"), F.size(left["o"]).cast("long").alias("open_results"))
