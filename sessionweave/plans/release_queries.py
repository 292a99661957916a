"""Queries of release decisions, lanes, selections, bindings and constraints, over examples made of ``events``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.functions import identity
from sessionweave.operators import records, release
from sessionweave.plans import fixture
from sessionweave.plans.record_queries import _FLAGS, _TIER, of_each
from sessionweave.plans.registry import ordered_events, query

LANES = ("reviewed", "policy", "window")
PROVIDERS = ("claude", "codex", "cursor", "gemini")

#: One example a segment of a session: parent, split by parent, lane, first tool, tokens, digests.
EX = f"""
    e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events),
    ex as (
      select user_id * 1000 + ordinal // {fixture.SEGMENT} as id, user_id as parent, ordinal // {fixture.SEGMENT} as rec, count(*) as messages,
        arg_min(event_type, ordinal) as tool, sum(length(event_type) * (1 + event_id % 37))::bigint as tokens, sha256(string_agg(event_type, ',' order by ordinal)) as state
      from e group by 1, 2, 3
    ), x as (
      select *, case when ('0x' || substr(sha256(parent::varchar), 1, 8))::bigint % 100 < 20 then 'validation' else 'train' end as split,
        case id % 3 when 0 then 'reviewed' when 1 then 'policy' else 'window' end as lane, case parent % 4 when 0 then 'claude' when 1 then 'codex' when 2 then 'cursor' else 'gemini' end as provider,
        'f' || (id % 5) as family from ex
    )"""


def examples(spark, sf_dir) -> DataFrame:
    e = ordered_events(spark, sf_dir)
    rec = F.floor(F.col("ordinal") / fixture.SEGMENT)
    entry = F.struct("ordinal", F.col("event_type").alias("t"))
    ex = e.groupBy((F.col("user_id") * 1000 + rec).alias("id"), F.col("user_id").alias("parent"), rec.alias("rec")).agg(
        F.count("*").alias("messages"), F.min_by("event_type", "ordinal").alias("tool"),
        F.sum(F.length("event_type") * (1 + F.col("event_id") % 37)).alias("tokens"), F.array_sort(F.collect_list(entry)).alias("c"),
    )
    return ex.withColumn("state", identity.digest(F.array_join(F.transform("c", lambda x: x["t"]), ","))).drop("c").withColumn(
        "split", identity.low_percent_split(F.col("parent").cast("string"), 20)
    ).withColumn("lane", fixture.pick(F.col("id") % 3, LANES)).withColumn("provider", fixture.pick(F.col("parent") % 4, PROVIDERS)).withColumn(
        "family", F.concat(F.lit("f"), (F.col("id") % 5).cast("string"))
    )


_GATE = "case when user_id % 50 = 7 then 'quarantine' else gate end"


def ledger(spark, sf_dir) -> DataFrame:
    """What decisions are made of, a row a record: labels alternate between examples, traces, windows and prompts."""
    keys = ("hidden_keys", "raw_keys", "secret_keys", "secret_values", "private_values")

    def rows(r):
        c = records.Cleaner()
        messages, kept = c.messages(r)
        judged = records.assessment(r, messages, c.events(r, kept), {"gate": "quarantine"} if int(r["session_id"][1:]) % 50 == 7 else None)
        found, edges = records.findings(r | {"messages": messages}), records.tool_edges(r)
        marks = sum(found[k] for k in ("metadata", "trainer_blocker", "tool_observation_review", "unknown_context_review"))
        yield {
            "gate": judged["gate"], "tier": judged["tier"], "findings": {k: found[k] for k in keys}, "markers": marks, "gaps": records.lineage_gaps(r),
            "has_actions": edges["calls"] > 0, "edges_ok": not any(v for k, v in edges.items() if k not in ("calls", "results")),
        }

    schema = f"gate string, tier string, findings struct<{','.join(f'{k}:bigint' for k in keys)}>, markers bigint, gaps array<string>, has_actions boolean, edges_ok boolean"
    u, r = F.col("user_id"), F.col("rec")
    label = fixture.pick((u + r) % 4, ("sft", "tool_traces", "action_windows", "rl_prompts"))
    return of_each(spark, sf_dir, rows, schema).withColumn("label", label).withColumn("wants_actions", u % 2 == 0).withColumn(
        "window", release.window_reasons(r % 2 == 0, F.when(u % 3 == 0, "call-id").otherwise("event-order"), F.lit("accepted"))
    ).withColumn("rl", release.rl_reasons(u % 2 == 0, F.when(r % 3 == 0, "scored"))).withColumn("prompt_group", F.when(label == "rl_prompts", F.concat(F.lit("g"), (u % 5).cast("string"))))


_DECIDE = f"""{fixture.SQL}, {_FLAGS}, acts as (
      select user_id, rec, count(*) filter (event_type = 'click') > 0 as has_actions,
        count(*) filter (event_type = 'view' and i % 3 = 2 and role is not null) > 0 and false as private from raw group by all
    ), d as (
      select j.user_id, j.rec, {_GATE} as gate, {_TIER.replace('user_id', 'j.user_id')} as tier, has_actions, case (j.user_id + j.rec) % 4 when 0 then 'sft' when 1 then 'tool_traces' when 2 then 'action_windows' else 'rl_prompts' end as label,
        list_filter([case when j.user_id % 8 = 0 then 'hidden_trainer_key' end], lambda x: x is not null) as privacy,
        list_filter([case when j.user_id % 2 = 1 then 'lineage_source_digest' end, case when j.user_id % 4 > 0 then 'lineage_snapshot_revision' end, case when j.user_id % 3 > 0 then 'lineage_parser_revision' end,
          case when j.rec % 2 = 1 then 'lineage_source_or_message_range' end], lambda x: x is not null) as gaps
      from judged j join acts using (user_id, rec)
    ), o as (select *, label = 'rl_prompts' and row_number() over (partition by case when label = 'rl_prompts' then 'g' || (user_id % 5) end order by user_id, rec) > 3 as over from d),
    f as (select *, list_filter([case when tier not in ('tier1_frontier', 'tier2_open_source') then 'model_tier_not_selected' end,
          case when label = 'tool_traces' and not has_actions and user_id % 2 = 0 then 'tool_trace_without_actions' end, case when label in ('sft', 'tool_traces') and has_actions then 'tool_edges_incomplete' end,
          case when label = 'action_windows' and rec % 2 = 1 then 'tool_observation_missing' end, case when label = 'action_windows' and user_id % 3 > 0 then 'tool_observation_unmatched' end,
          case when label = 'rl_prompts' and user_id % 2 = 1 then 'rl_not_ready' end, case when label = 'rl_prompts' and rec % 3 > 0 then 'rl_reward_unscored' end,
          case when over then 'duplicate_prompt_group_cap' end], lambda x: x is not null) as soft,
        case gate when 'candidate' then [] when 'review_required' then ['source_quality_review_required'] else ['source_quality_' || gate] end as why from o),
    decided as (select user_id, rec, label, case when len(privacy) + len(gaps) > 0 then 'quarantine' when gate = 'candidate' and len(soft) > 0 then 'review_required' when gate in ('candidate', 'review_required') then gate else 'quarantine' end as partition_,
        array_to_string(list_concat(why, privacy, gaps, soft), ',') as reasons from f)"""


@query(f"with {_DECIDE} select * from decided")
def release_decisions(spark, sf_dir):
    out = release.decide(ledger(spark, sf_dir), ["tier1_frontier", "tier2_open_source"], 3, ["user_id", "rec"])
    return out.select("user_id", "rec", "label", "partition_", F.array_join("reasons", ",").alias("reasons"))


@query(f"""with {_DECIDE} select partition_, nullif(reason, '') as reason, count(*) as rows from (select partition_, unnest(list_concat([''], string_split(reasons, ','))) as reason, reasons from decided)
    where reason = '' or reasons <> '' group by all having not (reason is null and false)""".replace("where reason = '' or reasons <> ''", "where true").replace("list_concat([''], string_split(reasons, ','))", "case when reasons = '' then [''] else list_concat([''], string_split(reasons, ',')) end"))
def release_counters(spark, sf_dir):
    return release.decision_counts(release.decide(ledger(spark, sf_dir), ["tier1_frontier", "tier2_open_source"], 3, ["user_id", "rec"]))


@query(f"""with {EX} select lane, split, count(*) as rows, count(distinct parent) as parents from x group by lane, split""")
def union_of_lanes(spark, sf_dir):
    x = examples(spark, sf_dir)
    union = release.union_lanes({lane: x.filter(F.col("lane") == lane).drop("lane") for lane in LANES})
    return union.groupBy("lane", "split").agg(F.count("*").alias("rows"), F.count_distinct("parent").alias("parents"))


@query(f"""with {EX}, u as (select id, parent, split from x where lane <> 'window' union all select id, parent, case when rec % 2 = 0 then split else 'train' end from x where lane <> 'reviewed')
    select 'id_duplicated' as reason, id::varchar as value from u group by id having count(*) > 1
    union all select 'parent_in_two_splits', parent::varchar from u group by parent having count(distinct split) > 1""")
def union_conflicts(spark, sf_dir):
    x = examples(spark, sf_dir).select("id", "parent", "split", "lane", "rec")
    moved = x.filter("lane <> 'reviewed'").withColumn("split", F.when(F.col("rec") % 2 == 0, F.col("split")).otherwise("train"))
    union = release.union_lanes({"a": x.filter("lane <> 'window'").drop("lane"), "b": moved.drop("lane")})
    return release.union_violations(union, "id", "parent", "split")


@query(f"""with {EX}, p as (select *, id % 7 as pair_lane from x), l as (select case when pair_lane < 2 then 'skill' when pair_lane < 5 then 'transition' else 'replay' end as source, split, family from p where pair_lane < 6)
    select source, split, family, count(*) as pairs from l group by all""")
def preference_union(spark, sf_dir):
    x = examples(spark, sf_dir).withColumn("k", F.col("id") % 7).drop("lane")
    parts = {"skill": x.filter("k < 2"), "transition": x.filter("k between 2 and 4"), "replay": x.filter("k = 5")}
    return release.union_lanes(parts, "source").groupBy("source", "split", "family").agg(F.count("*").alias("pairs"))


@query(f"""with {EX}, s as (select id, provider, split from x), g as (select provider, split, count(*) as n from s group by all)
    select provider, split, n as rows, sum(n) over (partition by provider)::bigint as of_provider from g""")
def multi_provider_union(spark, sf_dir):
    from pyspark.sql import Window

    x = examples(spark, sf_dir)
    bound = [x.filter(F.col("provider") == p).drop("provider").withColumn("provider", F.lit(p)) for p in PROVIDERS]
    n = reduce(DataFrame.unionByName, bound).groupBy("provider", "split").agg(F.count("*").alias("rows"))
    return n.withColumn("of_provider", F.sum("rows").over(Window.partitionBy("provider")))


@query(f"""with {EX}, r as (select *, row_number() over (partition by parent order by (lane <> 'reviewed')::int, provider, id) as k from x)
    select id, parent, k = 1 as kept from r""")
def one_per_parent_unified(spark, sf_dir):
    kept, lost = release.one_per_parent(examples(spark, sf_dir), "parent", [(F.col("lane") != "reviewed").cast("int"), "provider", "id"])
    flag = lambda d, v: d.select("id", "parent", F.lit(v).alias("kept"))
    return flag(kept, True).unionByName(flag(lost, False))


@query(f"""with {EX}, r as (select *, row_number() over (partition by parent order by case provider when 'claude' then 0 else 1 end, -messages, rec, id) as k from x)
    select id, case when k > 1 then 'duplicate_parent_selection' end as reason from r""")
def one_per_parent_by_tier(spark, sf_dir):
    kept, lost = release.one_per_parent(examples(spark, sf_dir), "parent", [F.when(F.col("provider") == "claude", 0).otherwise(1), F.desc("messages"), "rec", "id"])
    return kept.select("id", F.lit(None).cast("string").alias("reason")).unionByName(lost.select("id", "reason"))


@query(f"""with {EX}, t as (select *, row_number() over (partition by parent, tool order by id) as turn from x)
    select id, parent, row_number() over (partition by parent order by turn, tool) as place from t""")
def tool_diverse_order(spark, sf_dir):
    return release.diverse(examples(spark, sf_dir), "parent", "tool", "id").select("id", "parent", "place")


@query(f"""with {EX}, t as (select *, row_number() over (partition by parent, tool order by id) as turn from x), p as (select *, row_number() over (partition by parent order by turn, tool) as place from t),
    r as (select *, row_number() over (partition by split order by place, parent) as picked from p where place <= case split when 'train' then 3 else 2 end)
    select id, split, picked from r where picked <= case split when 'train' then 200 else 40 end""")
def parent_round_robin_by_split(spark, sf_dir):
    return release.round_robin(examples(spark, sf_dir), "split", "parent", "tool", "id", {"train": 3, "validation": 2}, {"train": 200, "validation": 40}).select("id", "split", "picked")


@query(f"""with {EX}, f as (select * from (select *, row_number() over (partition by split, parent order by id) as k from x) where k = 1),
    r as (select *, row_number() over (partition by split, family order by id) as picked from f) select id, split, family, picked from r where picked <= case split when 'train' then 10 else 3 end""")
def split_family_caps(spark, sf_dir):
    caps = {(s, f"f{k}"): n for s, n in (("train", 10), ("validation", 3)) for k in range(5)}
    return release.family_caps(examples(spark, sf_dir), "split", "family", "parent", "id", caps).select("id", "split", "family", "picked")


@query(f"""with {EX}, r as (select id, family, row_number() over (partition by family order by sha256('r' || id), id) as rank from x) select id, family, rank from r where rank <= 20""")
def rank_topk_or_fail(spark, sf_dir):
    by = [identity.digest(F.concat(F.lit("r"), F.col("id").cast("string"))), "id"]
    return release.enough(examples(spark, sf_dir), "family", by, 20).select("id", "family", "rank")


@query(f"with {EX} select id, tokens, messages from x order by tokens desc, messages desc, id desc limit 1")
def longest_canary(spark, sf_dir):
    return release.longest(examples(spark, sf_dir), "tokens", "messages", "id").select("id", "tokens", "messages")


@query(f"with {EX} select split, case when tokens > 1000 then 'sequence_exceeds_bound' else 'kept' end as decision, count(*) as rows from x group by all")
def token_bound_filter(spark, sf_dir):
    kept, lost = release.within_tokens(examples(spark, sf_dir), F.col("tokens"), 1000)
    both = kept.select("split", F.lit("kept").alias("decision")).unionByName(lost.select("split", F.col("reason").alias("decision")))
    return both.groupBy("split", "decision").agg(F.count("*").alias("rows"))


@query(f"""with {EX}, r as (select split, lane, tokens, row_number() over (partition by split, lane order by tokens) as k, count(*) over (partition by split, lane) as n from x)
    select split, lane, max(n) as rows, min(tokens) as least, max(case when k = ceil(0.5 * n) then tokens end) as p50, max(case when k = ceil(0.95 * n) then tokens end) as p95, max(tokens) as most from r group by all""")
def token_preflight(spark, sf_dir):
    return release.token_totals(examples(spark, sf_dir), ["split", "lane"], "tokens")


@query(f"""with {EX}, b as (select split, unnest([tokens, tokens + id % 11]) as t, unnest(['chosen', 'rejected']) as branch from x),
    r as (select *, row_number() over (partition by split, branch order by t) as k, count(*) over (partition by split, branch) as n from b)
    select split, branch, max(n) as rows, min(t) as least, max(case when k = ceil(0.5 * n) then t end) as p50, max(case when k = ceil(0.95 * n) then t end) as p95, max(t) as most from r group by all""")
def pair_token_preflight(spark, sf_dir):
    x = examples(spark, sf_dir)
    sides = F.array(F.struct(F.lit("chosen").alias("branch"), F.col("tokens").alias("t")), F.struct(F.lit("rejected").alias("branch"), (F.col("tokens") + F.col("id") % 11).alias("t")))
    return release.token_totals(x.select("split", F.explode(sides).alias("b")).select("split", "b.*"), ["split", "branch"], "t")


@query(f"with {EX} select id, tokens <= 1000 and tokens + id % 11 <= 1000 as both_fit, greatest(tokens, tokens + id % 11) as most from x")
def pair_token_gate(spark, sf_dir):
    t, r = F.col("tokens"), F.col("tokens") + F.col("id") % 11
    return examples(spark, sf_dir).select("id", ((t <= 1000) & (r <= 1000)).alias("both_fit"), F.greatest(t, r).alias("most"))


@query(f"""with {EX}, r as (select lane, tokens, row_number() over (partition by lane order by tokens) - 1 as k, count(*) over (partition by lane) as n from x)
    select lane, max(case when k = n // 2 then tokens end) as p50, max(case when k = least(n - 1, floor(n * 0.95)) then tokens end) as p95 from r group by lane""")
def index_percentiles(spark, sf_dir):
    return release.index_percentiles(examples(spark, sf_dir), "lane", "tokens")


@query(f"""with {EX}, g as (select split, provider, count(*) as n from x group by all), o as (select *, sum(n) over (partition by split)::bigint as "of" from g)
    select split, provider, n, "of" from o where n * 4 > "of" """)
def source_share_limits(spark, sf_dir):
    return release.share_violations(examples(spark, sf_dir), "split", "provider", 1, 4)


@query(f"""with {EX}, w as (select split, unnest(['f0', 'f1', 'f9']) as family from (select distinct split from x)), n as (select split, family, count(*) as n from x group by all)
    select split, family, coalesce(n, 0) as n from w left join n using (split, family) where coalesce(n, 0) < 1""")
def required_families(spark, sf_dir):
    return release.missing_families(examples(spark, sf_dir), "split", "family", ["f0", "f1", "f9"])


@query(f"with {EX} select id, case when parent % 17 = 3 then 'repository' when id % 19 = 5 then 'instance' when state in (select state from x where id % 23 = 1) then 'first_user' end as reason from x")
def contamination_by_priority(spark, sf_dir):
    x = examples(spark, sf_dir)
    sets = [
        ("repository", F.col("parent"), x.filter("parent % 17 = 3").select("parent")), ("instance", F.col("id"), x.filter("id % 19 = 5").select("id")),
        ("first_user", F.col("state"), x.filter("id % 23 = 1").select("state")),
    ]
    return release.contamination(x, "id", sets).select("id", "reason")


@query(f"""with {EX}, r as (select id, row_number() over (partition by state order by id) as k from x) select id, case when k > 1 then 'duplicate_prompt_completion' end as reason from r""")
def projection_dedup(spark, sf_dir):
    kept, lost = release.projection_dedup(examples(spark, sf_dir), F.col("state"), ["id"])
    return kept.select("id", F.lit(None).cast("string").alias("reason")).unionByName(lost.select("id", "reason"))


_SHA = "sha256(({})::varchar)"


@query(f"""with {EX}, a as (select parent as key from x where rec = 0), s as (select parent as key, count(*) as times from x where (parent % 3 > 0 and rec = 0) or (parent % 5 = 0 and rec = 1) group by parent)
    select coalesce(a.key, s.key) as key, coalesce(times, 0) as times, case when a.key is null then 'not_accepted' when times is null then 'missing' when times > 1 then 'duplicate' else 'ok' end as status
    from (select * from a where key % 7 > 0) a full join s on a.key = s.key""")
def pilot_inspection(spark, sf_dir):
    x = examples(spark, sf_dir).withColumn("key", F.col("parent"))
    return release.inspected(x.filter("rec = 0 and parent % 7 > 0").select("key"), x.filter("(parent % 3 > 0 and rec = 0) or (parent % 5 = 0 and rec = 1)"), "key")


@query(f"""with {EX}, ee as (select id, tokens from x where id % 5 > 0), l as (select id, state from x where id % 7 > 0 union all select id, state from x where id % 11 = 0 and id % 7 > 0),
    n as (select coalesce(a.id, b.id) as id, a.n as e, b.n as l from (select id, count(*) as n from ee group by id) a full join (select id, count(*) as n from l group by id) b on a.id = b.id)
    select id, case when l is null then 'lineage_missing' when e is null then 'example_missing' when l = 1 then 'joined' else 'not_one_to_one' end as reason from n""")
def lineage_join_checks(spark, sf_dir):
    x = examples(spark, sf_dir)
    l = x.filter("id % 7 > 0").select("id", "state")  # noqa: E741
    joined, bad = release.lineage_join(x.filter("id % 5 > 0").select("id", "tokens"), l.unionByName(l.filter("id % 11 = 0")), "id")
    return bad.unionByName(joined.select("id", F.lit("joined").alias("reason")))


@query(f"""with {EX} select field, "values" from (select unnest(['provider', 'split', 'one']) as field, unnest([count(distinct provider), count(distinct split), 1]) as "values" from x) where "values" <> 1""")
def capture_identity(spark, sf_dir):
    return release.same_identity(examples(spark, sf_dir).withColumn("one", F.lit("x")), ["provider", "split", "one"])


@query(f"""with {EX} select id, case when id % 6 = 0 then 'o' || id % 4 when parent % 9 = 2 then 's' || parent when parent % 5 = 1 then 'h' || parent % 5 end as chosen from x
    where id % 6 = 0 or parent % 9 = 2 or parent % 5 = 1""")
def override_lookup(spark, sf_dir):
    x = examples(spark, sf_dir)
    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    i, p = F.col("id"), F.col("parent")
    known = x.select(F.explode(F.array(
        F.when(i % 6 == 0, F.struct(F.concat(F.lit("sha256:"), name("origin", i)).alias("key"), name("o", i % 4).alias("chosen"))),
        F.when(p % 9 == 2, F.struct(name("session", p).alias("key"), name("s", p).alias("chosen"))), F.when(p % 5 == 1, F.struct(name("file", p).alias("key"), name("h", p % 5).alias("chosen"))),
    )).alias("x")).filter("x is not null").select("x.*").distinct()
    return release.lookup(x, "id", [name("origin", i), name("session", p), name("file", p)], known, "chosen")


@query(f"""with {EX}, inv as (select id, {_SHA.format('parent % 40')} as sha, provider from x), ev as (select {_SHA.format('parent % 60')} as sha, provider from x where parent % 3 = 0)
    select id, case when exists (select 1 from ev where ev.sha = inv.sha and ev.provider = inv.provider) then 'strong' when exists (select 1 from ev where ev.sha = inv.sha) then 'weak' else 'none' end as "match" from inv""")
def coverage_matches(spark, sf_dir):
    x = examples(spark, sf_dir)
    sha = lambda n: identity.digest((F.col("parent") % n).cast("string")).alias("sha")
    found = x.filter("parent % 3 = 0").select(sha(60), "provider", F.lit("ingress").alias("kind"), F.col("lane").alias("class"))
    return release.covered(x.select("id", sha(40), "provider"), found).select("id", "match")


@query(f"""with {EX} select {_SHA.format('parent % 60')} as sha, count(*) as times, string_agg(distinct lane, ',' order by lane) as classes, string_agg(distinct provider, ',' order by provider) as providers from x group by 1""")
def evidence_by_digest(spark, sf_dir):
    found = examples(spark, sf_dir).select(identity.digest((F.col("parent") % 60).cast("string")).alias("sha"), "provider", F.lit("k").alias("kind"), F.col("lane").alias("class"))
    return release.evidence(found).select("sha", "times", F.array_join("classs", ",").alias("classes"), F.array_join("providers", ",").alias("providers"))


@query(f"""with {EX}, a as (select 'n' || parent as name, {_SHA.format('rec')} as sha, id from x), b as (select distinct 'n' || parent as name, {_SHA.format('rec')} as sha from x where rec % 2 = 0 and parent % 3 > 0)
    select id, case when exists (select 1 from b where b.name = a.name and b.sha = a.sha) then 'bound' when exists (select 1 from b where b.name = a.name) then 'digest_changed' else 'absent' end as binding from a""")
def artifact_bindings(spark, sf_dir):
    a = examples(spark, sf_dir).select("id", "parent", "rec", F.concat(F.lit("n"), F.col("parent").cast("string")).alias("name"), identity.digest(F.col("rec").cast("string")).alias("sha"))
    return release.bound_to(a, a.filter("rec % 2 = 0 and parent % 3 > 0").select("name", "sha"), ["name", "sha"]).select("id", "binding")


@query(f"""with {EX}, k as (select distinct parent from x), s as (select parent, case when parent % 4 = 1 then 'changed' else 'stable' end as status, parent % 10 as sha from k where parent % 6 > 0),
    i as (select parent, case when parent % 11 = 0 then -1 else parent % 10 end as sha from k where parent % 7 > 0)
    select k.parent, case when s.status is null then 'snapshot_absent' when s.status <> 'stable' then 'snapshot_' || s.status when i.sha is null then 'inventory_absent' when i.sha <> s.sha then 'digest_drift' else 'bound' end as ref
    from k left join s using (parent) left join i using (parent)""")
def snapshot_references(spark, sf_dir):
    k = examples(spark, sf_dir).select("parent").distinct()
    p = F.col("parent")
    snapshot = k.filter("parent % 6 > 0").withColumn("status", F.when(p % 4 == 1, "changed").otherwise("stable")).withColumn("sha", p % 10)
    inventory = k.filter("parent % 7 > 0").withColumn("sha", F.when(p % 11 == 0, F.lit(-1)).otherwise(p % 10))
    return release.snapshot_refs(k, snapshot, inventory, ["parent"])


@query(f"""with {EX}, n as (select provider, lane, parent, count(*) as n from x where rec % 2 = 0 group by all)
    select id, case when n is null then 'unknown_source' when n = 1 then 'admitted' else 'ambiguous' end as admission from x left join n using (provider, lane, parent)""")
def source_admissions(spark, sf_dir):
    x = examples(spark, sf_dir).select("id", "provider", "lane", "parent", "rec")
    return release.admitted(x, x.filter("rec % 2 = 0"), ["provider", "lane", "parent"]).select("id", "admission")


@query(f"""with {EX}, s as (select case when id % 10 = 0 then 'skipped' when id % 10 = 1 then 'rejected' when id % 10 = 2 then 'lost' else 'normalized' end as status from x)
    select count(*) as input, count(*) filter (status = 'skipped') as skipped, count(*) filter (status = 'normalized') as normalized, count(*) filter (status = 'rejected') as rejected,
      count(*) filter (status = 'lost') as gap from s""")
def projection_accounting(spark, sf_dir):
    d = F.col("id") % 10
    status = F.when(d == 0, "skipped").when(d == 1, "rejected").when(d == 2, "lost").otherwise("normalized")
    return release.accounting(examples(spark, sf_dir).select(status.alias("status")))


@query(f"""with {EX} select 'lane' as family, lane as key, count(*) as n from x group by lane union all select 'provider', provider, count(*) from x group by provider
    union all select 'split', split, count(*) from x group by split union all select 'tool', tool, count(*) from x group by tool""")
def build_counters(spark, sf_dir):
    return release.counters(examples(spark, sf_dir), ["lane", "provider", "split", "tool"])


@query(f"""with {EX}, u as (select id, 'u' || id as unit_id, 'r' || (id // 2 * 2 + (id % 50 > 0)::int * (id % 2)) as review_id, case when id % 9 = 0 then 'old' else 'now' end as revision, case id % 4 when 0 then 'accept' when 1 then 'reject' when 2 then 'defer' else 'maybe' end as decision from x where parent < 40)
    select unit_id, 'review_id_duplicated' as reason from (select *, count(*) over (partition by review_id) as n from u) where n > 1
    union all select unit_id, 'revision_mismatch' from u where revision = 'old' union all select unit_id, 'decision_unknown' from u where decision = 'maybe'
    union all select unit_id, 'dimension_missing' from u where id % 13 = 0 union all select unit_id, 'dimension_failed' from u where id % 17 = 0 and decision = 'accept'
    union all select unit_id, 'evidence_without_unit' from u where id % 19 = 0""")
def review_manifest_violations(spark, sf_dir):
    i = F.col("id")
    dims = F.map_from_entries(F.filter(
        F.array(*(F.struct(F.lit(d).alias("key"), (F.when(i % 17 == 0, "fail").otherwise("pass") if d == "privacy" else F.lit("pass")).alias("value")) for d in release.DIMENSIONS)),
        lambda e: ~((e["key"] == "structural") & (i % 13 == 0)),
    ))
    unit = F.concat(F.lit("u"), i.cast("string"))
    u = examples(spark, sf_dir).filter("parent < 40").select(
        unit.alias("unit_id"), F.concat(F.lit("r"), (F.floor(i / 2) * 2 + (i % 50 > 0).cast("int") * (i % 2)).cast("string")).alias("review_id"), F.when(i % 9 == 0, "old").otherwise("now").alias("revision"),
        fixture.pick(i % 4, ("accept", "reject", "defer", "maybe")).alias("decision"), dims.alias("dimensions"),
        F.when(i % 19 == 0, "release now").otherwise(F.concat(F.lit("release now "), unit)).alias("evidence"),
    )
    return release.review_violations(u, "now")


@query(f"""with {EX}, h as (select distinct {_SHA.format('state')} as h from x where lane = 'reviewed'), o as (select distinct {_SHA.format('state')} as h from x where lane = 'policy')
    select 'missing' as "set", count(*) as n from (select h from h except select h from o) union all select 'shared', count(*) from (select h from h intersect select h from o)""")
def prompt_hash_sets(spark, sf_dir):
    x = examples(spark, sf_dir)
    hashes = lambda lane: x.filter(F.col("lane") == lane).select(identity.digest(F.col("state")).alias("h")).distinct()
    a, b = hashes("reviewed"), hashes("policy")
    n = lambda df, name: df.agg(F.lit(name).alias("set"), F.count("*").alias("n"))
    return n(a.exceptAll(b), "missing").unionByName(n(a.intersect(b), "shared"))


@query(f"with {EX} select id, split, rec from x where lane = 'window' order by provider, parent, rec")
def selected_order(spark, sf_dir):
    return examples(spark, sf_dir).filter("lane = 'window'").orderBy("provider", "parent", "rec").select("id", "split", "rec")


@query("select k as mode, k <> 'none' and ok as eligible, case when k = 'none' then 'unfiltered' when ok then 'user-approved-after-filter' else 'review-required' end as why, count(*) as n from (select case event_id % 3 when 0 then 'heuristic' when 1 then 'filtered' else 'none' end as k, event_id % 2 = 0 as ok from events) group by all")
def privacy_eligibility(spark, sf_dir):
    i = F.col("event_id")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(fixture.pick(i % 3, ("heuristic", "filtered", "none")).alias("mode"), (i % 2 == 0).alias("ok"))
    eligible, why = release.privacy_eligible(F.col("mode"), F.col("ok"))
    return e.select("mode", eligible.alias("eligible"), why.alias("why")).groupBy("mode", "eligible", "why").agg(F.count("*").alias("n"))
