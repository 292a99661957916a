"""Queries over turns, trajectories and scored runs, made of the ``events`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionweave.functions.identity import digest
from sessionweave.operators import transitions
from sessionweave.plans import fixture
from sessionweave.plans.registry import ordered_events, query

#: Events as actions (click, view), artifacts (purchase) and others; two neighbours share a message, some have none.
SQL = """
    e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events),
    a as (select *, case when event_id % 13 = 0 then null else ordinal // 3 end as message, event_type || ':' || floor(value / 50)::bigint as sig from e),
    g as (select user_id, message, case when message is null then ordinal end as own, min(ordinal) as first, max(ordinal) as last, count(*) as calls,
            sha256(string_agg(sig, chr(0) order by ordinal)) as signature from a where event_type in ('click', 'view') group by 1, 2, 3),
    t as (select *, row_number() over (partition by user_id order by first) - 1 as turn_ordinal, lead(first) over (partition by user_id order by first) as next_first from g)
"""


def actions(spark, sf_dir):
    e = ordered_events(spark, sf_dir)
    return e.withColumn("message", F.when(F.col("event_id") % 13 != 0, F.floor(F.col("ordinal") / 3))).withColumn(
        "sig", F.concat_ws(":", "event_type", F.floor(F.col("value") / 50).cast("string"))
    )


def made_turns(spark, sf_dir):
    kind = F.col("event_type")
    return transitions.turns(actions(spark, sf_dir), "user_id", kind.isin("click", "view"), "message", "sig", kind == "purchase")


@query(f"""with {SQL} select t.user_id, turn_ordinal, first, last, calls, signature,
    coalesce((select array_to_string(list_sort(list_distinct(list(sha256(sig)))), ',') from a where a.user_id = t.user_id and a.event_type = 'purchase' and a.ordinal > t.last
      and (t.next_first is null or a.ordinal < t.next_first)), '') as artifacts from t""")
def turn_grouping(spark, sf_dir):
    return made_turns(spark, sf_dir).select("user_id", "turn_ordinal", "first", "last", "calls", "signature", F.array_join("artifacts", ",").alias("artifacts"))


@query(f"""with {SQL}, l as (select *, row_number() over s - 1 as prior, turn_ordinal - lag(turn_ordinal) over s as distance, lag(signature, 1) over w as b, lag(signature, 2) over w as c,
      lag(signature, 3) over w as d, lag(signature, 4) over w as f, lag(signature, 5) over w as h from t
      window s as (partition by user_id, signature order by turn_ordinal), w as (partition by user_id order by turn_ordinal))
    select user_id, turn_ordinal, prior, distance, coalesce(distance = 1, false) as immediate,
      concat_ws(',', case when signature = c and b = d then '2' end, case when signature = d and b = f and c = h then '3' end) as periods from l""")
def turn_sequence_evidence(spark, sf_dir):
    made = transitions.sequence_evidence(made_turns(spark, sf_dir), "user_id")
    return made.select("user_id", "turn_ordinal", "prior", "distance", "immediate", F.array_join(F.transform("periods", lambda p: p.cast("string")), ",").alias("periods"))


@query("""with recursive e as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events),
    s(user_id, ordinal, state) as (select distinct user_id, 0::bigint, sha256('prefix') from e
      union all select s.user_id, s.ordinal + 1, sha256(s.state || chr(0) || e.event_id) from s join e on e.user_id = s.user_id and e.ordinal = s.ordinal)
    select s.user_id, s.ordinal, state from s join e using (user_id, ordinal)""")
def prefix_state_hash(spark, sf_dir):
    return transitions.prefix_states(ordered_events(spark, sf_dir), "user_id", "event_id")


_OUT = """case event_id % 6 when 0 then '{"returncode": 1, "output": "x"}' when 1 then '{"returncode": 0, "output": "Traceback (most recent"}' when 2 then 'plain ok' when 3 then 'bash: command not found'
    when 4 then '{"returncode": 0, "output": "fine"}' else '[1, 2]' end"""


@query(f"select event_id, event_id % 6 in (0, 1, 3) as failed from (select *, {_OUT} as o from events)")
def tool_failures(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", transitions.tool_failed(F.expr(_OUT)).alias("failed"))


@query(f"""with {SQL}, k as (select user_id, turn_ordinal, calls > 1 as failed, first % 5 = 0 as mutates, first % 7 = 0 as verifies from t),
    x as (select *, coalesce(lag(failed) over (partition by user_id order by turn_ordinal), false) as after, max(turn_ordinal) filter (mutates) over (partition by user_id) as lastm from k),
    y as (select *, min(turn_ordinal) filter (after) over p as r, min(turn_ordinal) filter (mutates) over p as m, min(turn_ordinal) filter (verifies and turn_ordinal > lastm) over p as v from x window p as (partition by user_id))
    select user_id, turn_ordinal, concat_ws(',', case when turn_ordinal = 0 then 'first_grounded_action' end, case when turn_ordinal = r then 'post_failure_recovery' end,
      case when turn_ordinal = m then 'first_mutation' end, case when turn_ordinal = v then 'post_mutation_verification' end) as categories from y
    where turn_ordinal = 0 or turn_ordinal = r or turn_ordinal = m or turn_ordinal = v""")
def action_categories(spark, sf_dir):
    made = made_turns(spark, sf_dir).withColumn("failed", F.col("calls") > 1).withColumn("mutates", F.col("first") % 5 == 0).withColumn("verifies", F.col("first") % 7 == 0)
    return transitions.categories(made, "user_id", "failed", "mutates", "verifies").withColumn("categories", F.array_join("categories", ","))


@query(f"""with {SQL}, c as (select user_id, message as turn, row_number() over (partition by user_id, message order by ordinal) as place, event_id as call from a where event_type = 'click' and message is not null),
    r as (select user_id, message as turn, row_number() over (partition by user_id, message order by ordinal) as place, event_id as result from a where event_type = 'purchase' and message is not null),
    n as (select user_id, turn, (select count(*) from r where r.user_id = c.user_id and r.turn = c.turn) = count(*) as ok from c group by user_id, turn)
    select c.user_id, c.turn, c.place, call, result from c join r using (user_id, turn, place) join n using (user_id, turn) where ok""")
def positional_observations(spark, sf_dir):
    from pyspark.sql import Window

    a = actions(spark, sf_dir).filter("message is not null")
    w = Window.partitionBy("user_id", "message").orderBy("ordinal")
    side = lambda kind, name: a.filter(F.col("event_type") == kind).select("user_id", F.col("message").alias("turn"), F.row_number().over(w).alias("place"), F.col("event_id").alias(name))
    return transitions.positional_join(side("click", "call"), side("purchase", "result"), "user_id", "turn", "place")[0]


#: Trajectories: segments of ten events, of twenty instances, two teachers and two outcomes; states are chains of event types.
_TRANS = f"""e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events),
    tr as (select user_id * 1000 + ordinal // {fixture.SEGMENT} as episode, ordinal % {fixture.SEGMENT} as turn_ordinal, user_id % 20 as instance_id, 'r' || (user_id % 3) as repository,
             case when user_id % 2 = 0 then 'm1' else 'm2' end as teacher, (ordinal // {fixture.SEGMENT}) % 2 as outcome, event_type, event_type || floor(value / 100)::bigint as target from e)"""
_CHAIN = f"""{_TRANS}, st(episode, turn_ordinal, state_hash) as (
      select distinct episode, 0::bigint, sha256('state' || chr(0) || instance_id) from tr
      union all select st.episode, st.turn_ordinal + 1, sha256('state' || chr(0) || state_hash || sha256(event_type)) from st join tr on tr.episode = st.episode and tr.turn_ordinal = st.turn_ordinal),
    tx as (select tr.*, state_hash, sha256(target) as target_hash from tr join st using (episode, turn_ordinal))"""


def trajectories(spark, sf_dir):
    e = ordered_events(spark, sf_dir)
    seg = F.floor(F.col("ordinal") / fixture.SEGMENT)
    u = F.col("user_id")
    return e.select(
        (u * 1000 + seg).alias("episode"), (F.col("ordinal") % fixture.SEGMENT).alias("turn_ordinal"), (u % 20).alias("instance_id"),
        F.concat(F.lit("r"), (u % 3).cast("string")).alias("repository"), F.when(u % 2 == 0, "m1").otherwise("m2").alias("teacher"), (seg % 2).alias("outcome"),
        "event_type", F.concat("event_type", F.floor(F.col("value") / 100).cast("string")).alias("target"),
    )


@query(f"with recursive {_CHAIN} select episode, turn_ordinal, state_hash, target_hash from tx")
def transition_index(spark, sf_dir):
    return transitions.state_transitions(trajectories(spark, sf_dir), "episode", F.col("instance_id").cast("string"), F.col("target"), F.col("event_type"))


@query(f"""with recursive {_CHAIN} select c.instance_id, c.state_hash, c.turn_ordinal as c_turn, r.turn_ordinal as r_turn, c.episode as c_episode, r.episode as r_episode
    from tx c join tx r on c.instance_id = r.instance_id and c.state_hash = r.state_hash and c.repository = r.repository and c.target_hash <> r.target_hash
    where c.teacher = 'm1' and c.outcome = 1 and r.teacher = 'm1' and r.outcome = 0 order by c.instance_id, c.state_hash, c.turn_ordinal, c.episode, r.turn_ordinal, r.episode limit 256""")
def same_state_preference_join(spark, sf_dir):
    of = trajectories(spark, sf_dir)
    chain = transitions.state_transitions(of, "episode", F.col("instance_id").cast("string"), F.col("target"), F.col("event_type"))
    rows = chain.join(of.select("episode", "turn_ordinal", "instance_id", "repository", "teacher", "outcome"), ["episode", "turn_ordinal"])
    good, bad = (F.col("teacher") == "m1") & (F.col("outcome") == 1), (F.col("teacher") == "m1") & (F.col("outcome") == 0)
    pairs = transitions.same_state_preferences(rows, good, bad, ["turn_ordinal", "episode"], 256)
    return pairs.select("instance_id", "state_hash", F.col("c_turn_ordinal").alias("c_turn"), F.col("r_turn_ordinal").alias("r_turn"), "c_episode", "r_episode")


@query(f"""with {SQL}, k as (select user_id, turn_ordinal, signature, case when first % 4 = 0 then 'told' || (calls) end as told, sha256('["' || calls || '"]') as seen from t)
    select user_id, turn_ordinal, sha256('{{"action_signatures":["' || signature || '"],"observation_sha256":"' || seen || '","state_after":"' || coalesce(told, seen) || '"}}') as cycle_key,
      case when told is null then 'observation_digest' else 'explicit' end as state_source from k""")
def turn_cycle_keys(spark, sf_dir):
    told = F.when(F.col("first") % 4 == 0, F.concat(F.lit("told"), F.col("calls").cast("string")))
    made = transitions.cycle_keys(made_turns(spark, sf_dir), F.array("signature"), F.array(F.col("calls").cast("string")), told)
    return made.select("user_id", "turn_ordinal", "cycle_key", "state_source")


_CASES = """e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events),
    c as (select user_id as case_, list(event_type order by ordinal) as names, list_distinct(list(lower('Skill' || (event_id % 9))) filter (event_type = 'signup')) as read from e where ordinal < 12 group by user_id),
    f as (select case_, names, list_concat(
        list_transform(list_filter(['view', 'click'], lambda x: not list_contains(names, x)), lambda x: 'missing_required:' || x),
        case when not list_has_any(names, ['purchase', 'error']) then ['missing_required_any:purchase,error'] else [] end,
        case when case_ % 3 = 0 and list_contains(names, 'error') then ['forbidden_call:error'] else [] end,
        case when list_contains(names, 'purchase') and len(list_filter(names[1:list_position(names, 'purchase') - 1], lambda x: x = 'view')) < 1 then ['order:view<purchase:need1'] else [] end,
        case when not list_contains(coalesce(read, []), 'skill' || (case_ % 9)) then ['missing_skill:skill' || (case_ % 9)] else [] end,
        case when case_ % 10 = 0 then ['cycle_period_2'] else [] end) as failures from c)"""


def scored(spark, sf_dir):
    # A case has the first twelve events of a user: what the run of a case is, not a cut of the table.
    e = ordered_events(spark, sf_dir).filter("ordinal < 12")
    u = F.col("user_id")
    calls = e.select(u.alias("case"), F.col("ordinal").alias("at"), F.col("event_type").alias("name"), F.when(F.col("event_type") == "signup", F.concat(F.lit("Skill"), (F.col("event_id") % 9).cast("string"))).alias("skill"))
    words = lambda *w: F.array(*(F.lit(x) for x in w)) if w else F.array().cast("array<string>")
    cases = e.select(u.alias("case")).distinct().select(
        "case", words("view", "click").alias("required"), words("purchase", "error").alias("required_any"),
        F.when(F.col("case") % 3 == 0, words("error")).otherwise(words()).alias("forbidden"),
        F.array(F.concat(F.lit("SKILL"), (F.col("case") % 9).cast("string"))).alias("skills"),
        F.array(F.struct(F.lit("view").alias("first"), F.lit("purchase").alias("then"), F.lit(1).alias("need"))).alias("before"),
    )
    return transitions.score(cases, calls, cases.filter("case % 10 = 0").select("case", F.lit(2).alias("period")))


@query(f"with {_CASES} select case_ as user_id, array_to_string(failures, ';') as failures, len(failures) = 0 as passed, len(names)::bigint as calls from f")
def behavior_scores(spark, sf_dir):
    return scored(spark, sf_dir).select(F.col("case").alias("user_id"), F.array_join("failures", ";").alias("failures"), "passed", "calls")


@query(f"""with {_CASES}, s as (select case_ % 2 as run, failures, names from f),
    k as (select run, split_part(x, ':', 1) as kind, count(*) as n from (select run, unnest(failures) as x from s) group by 1, 2)
    select run, count(*) as attempted, count(*) filter (len(failures) = 0) as passed, count(*) filter (len(failures) > 0) as failed, sum(len(names))::bigint as calls,
      (select string_agg(kind || '=' || n, ',' order by kind) from k where k.run = s.run) as by_kind from s group by run""")
def behavior_run_totals(spark, sf_dir):
    totals = transitions.run_totals(scored(spark, sf_dir).withColumn("run", F.col("case") % 2), "run")
    return totals.withColumn("by_kind", F.array_join(F.transform("by_kind", lambda x: F.concat_ws("=", x["kind"], x["n"].cast("string"))), ","))
