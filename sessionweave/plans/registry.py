"""Queries by name: each applies an operator to whole tables, with SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.functions import identity, text
from sessionweave.operators import audit, gates, selection, sequence, sessions
from sessionweave.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.gather(table(spark, sf_dir, "conversations"))


def ordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.ordinals(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def _families(column: str) -> str:
    cases = " ".join(
        f"when {' or '.join(f'contains(lower({column}), {k!r})' for k in keys)} then '{name}'" for name, keys in text.TASK_FAMILIES.items()
    )
    return f"case {cases} else 'unknown' end"


def _bucket(hex_: str, n: int) -> str:
    return f"(('0x' || substr({hex_}, 1, 8))::bigint % {n})"


MSGS = """
    m as (
      select conv_id, turn, case when lower(trim(role)) in ('user', 'human') then 'user' when lower(trim(role)) in ('assistant', 'agent', 'model', 'gemini', 'bot') then 'assistant'
             when lower(trim(role)) = 'tool' then 'tool' when lower(trim(role)) in ('system', 'developer') then 'system' end as role, text
      from conversations
    ), k as (select * from m where role is not null),
    s as (
      select conv_id, count(*)::bigint as n, string_agg(role || ':' || text, chr(10) order by turn) as body,
             coalesce(string_agg(text, chr(10) order by turn) filter (role = 'user'), '') as said,
             coalesce(max(turn) filter (role = 'user'), -1) as last_user,
             bool_or(role = 'user' and length(text) > 0) as has_user, bool_or(role = 'assistant' and length(text) > 0) as has_assistant,
             max(turn) as last_turn, arg_max(role, turn) as last_role, arg_max(text, turn) as last_text
      from k group by conv_id
    )
"""
REASONS = """trim(concat(case when not has_user then 'user_turn_missing,' else '' end, case when not has_assistant then 'assistant_turn_missing' else '' end), ',')"""


@query(f"""
    with {MSGS}, d as (select *, sha256(body) as h, row_number() over (partition by body order by conv_id) as r from s)
    select conv_id, n as n_messages, {_families('said')} as task_family,
           case when {_bucket('h', 100)} < 90 then 'train' when {_bucket('h', 100)} < 95 then 'validation' else 'test' end as split,
           {REASONS} as reasons
    from d where r = 1
""")
def conv_sft_slice(spark, sf_dir):
    return sessions.training_examples(conversations(spark, sf_dir))


@query(f"""
    with {MSGS} select conv_id, n as n_messages, has_user, has_assistant,
           case when not has_user or not has_assistant then 'review_required' else 'candidate' end as gate from s
""")
def conv_session_quality(spark, sf_dir):
    m = F.col("messages")
    user, assistant = sessions.has(m, "user"), sessions.has(m, "assistant")
    return conversations(spark, sf_dir).select(
        "conv_id", F.size(m).cast("long").alias("n_messages"), user.alias("has_user"), assistant.alias("has_assistant"),
        F.when(user & assistant, "candidate").otherwise("review_required").alias("gate"),
    )


@query(f"with {MSGS} select conv_id, unnest(string_split({REASONS}, ',')) as reason from s where {REASONS} <> ''")
def conv_rejections(spark, sf_dir):
    return conversations(spark, sf_dir).select("conv_id", F.explode(sessions.rejection_reasons(F.col("messages"))).alias("reason"))


_PROMPTS = f"""{MSGS}, p as (
      select k.conv_id, count(*)::bigint as n_prompt, sha256(string_agg(text, chr(10) order by turn)) as prompt_digest
      from k join s using (conv_id) where turn <= last_user group by k.conv_id)"""


@query(f"with {_PROMPTS} select * from p")
def conv_latest_user_prompt(spark, sf_dir):
    return sessions.latest_prompt(conversations(spark, sf_dir))


@query(f"""with {_PROMPTS} select *, count(*) over (partition by prompt_digest) as group_size,
           row_number() over (partition by prompt_digest order by conv_id) > 1 as duplicate from p""")
def conv_rl_prompt_groups(spark, sf_dir):
    return sessions.prompt_groups(sessions.latest_prompt(conversations(spark, sf_dir)))


@query("""
    with b as (
      select conv_id, turn, role, count(*) over w as n, count(*) filter (role = 'user') over w as nu, min(turn) over w as low,
             max(case when role = 'user' then turn end) over (partition by conv_id order by turn rows between unbounded preceding and current row) as carried
      from conversations window w as (partition by conv_id order by turn rows between 7 preceding and current row)
    )
    select conv_id, turn, case when nu = 0 and carried is not null then least(n, 7) + 1 else n end as n_context,
           case when nu = 0 and carried is not null then carried else low end as first_turn, nu = 0 and carried is not null as carried_user
    from b where role = 'assistant'
""")
def conv_bounded_context(spark, sf_dir):
    return sessions.bounded_context(table(spark, sf_dir, "conversations"))


@query(f"""with {MSGS} select conv_id, length(last_text) as answer_chars, sha256(last_text) as answer_digest from s
    where last_role = 'assistant' and last_user >= 0 and length(last_text) between 200 and 32768""")
def conv_final_answer(spark, sf_dir):
    return sessions.final_answers(conversations(spark, sf_dir), 200, 32_768)


@query("select conv_id, turn, array_to_string(list_sort(list_filter(["
       + ", ".join(f"case when regexp_matches(said, '{p}') then '{n}' end" for n, p in text.MENTIONS.items())
       + "], lambda x: x is not null)), ',') as mentions from (select *, text || case when conv_id % 3 = 0 then ' Claude or Oh My Pi' when turn = 1 then ' chatgpt, Cursor' else '' end as said from conversations)")
def conv_provider_mentions(spark, sf_dir):
    named = F.when(F.col("conv_id") % 3 == 0, " Claude or Oh My Pi").when(F.col("turn") == 1, " chatgpt, Cursor").otherwise("")
    said = F.concat("text", named)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(text.mentions(said, text.MENTIONS), ",").alias("mentions"))


@query()
def conv_chunks(spark, sf_dir):
    return sessions.segments(conversations(spark, sf_dir), 400)


@query("""with c as (select conv_id, turn // 2 as chunk from conversations group by 1, 2)
    select conv_id, chunk, case when chunk - lag(chunk) over w = 1 then lag(chunk) over w end as previous,
           case when lead(chunk) over w - chunk = 1 then lead(chunk) over w end as next from c window w as (partition by conv_id order by chunk)""")
def conv_chunk_links(spark, sf_dir):
    chunks = table(spark, sf_dir, "conversations").select("conv_id", F.floor(F.col("turn") / 2).alias("chunk")).distinct()
    return sessions.neighbours(chunks, "conv_id", "chunk")


@query(f"select doc_id, case when {_bucket('sha256(text)', 100)} < 90 then 'train' when {_bucket('sha256(text)', 100)} < 95 then 'validation' else 'test' end as split from documents")
def doc_split_buckets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", identity.three_way_split(identity.digest(F.col("text"))).alias("split"))


_SRC = "sha256(source)"


@query(f"""select doc_id, case when {_bucket(_SRC, 100)} < 10 then 'validation' else 'train' end as low_percent,
           case when {_bucket(_SRC, 100)} >= 90 then 'validation' else 'train' end as high_hundred,
           case when {_bucket(_SRC, 10)} >= 8 then 'validation' else 'train' end as high_ten from documents""")
def doc_parent_splits(spark, sf_dir):
    s = F.col("source")
    return table(spark, sf_dir, "documents").select(
        "doc_id", identity.low_percent_split(s, 10).alias("low_percent"), identity.high_bucket_split(s, 100, 90).alias("high_hundred"),
        identity.high_bucket_split(s, 10, 8).alias("high_ten"),
    )


@query("""with p as (select source, row_number() over (order by source) - 1 as k, count(*) over () as n from (select distinct source from documents))
    select doc_id, case when n > 1 and k % 5 = 0 then 'validation' else 'train' end as split from documents join p using (source)""")
def doc_every_fifth_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.join(selection.every_fifth(docs, "source"), "source").select("doc_id", "split")


@query("select doc_id, lang, source from (select *, row_number() over (partition by text order by doc_id) as r from documents) where r = 1")
def doc_keep_first_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", identity.digest(F.col("text")).alias("key"))
    return selection.keep_first(docs, F.col("key"), ["doc_id"]).select("doc_id", "lang", "source")


#: DuckDB's patterns have no lookbehind: the character before a path is matched, and written again.
EDGE = ("(?<![A-Za-z0-9])", "(^|[^A-Za-z0-9])")


def redacted_sql(body: str) -> tuple[str, str]:
    """Redacted text of an expression, and the number of replacements."""
    count = "0"
    for p, r in text.REDACTIONS:
        to = (chr(92) + "1" if EDGE[0] in p else "") + r.replace("$1", chr(92) + "1")
        p = p.replace(*EDGE).replace("'", "''")
        count += f" + len(regexp_extract_all({body}, '{p}'))"
        body = f"regexp_replace({body}, '{p}', '{to}', 'g')"
    return body, count


_SAID = "text || case when doc_id % 5 = 0 then ' /home/ann/x and C:\\Users\\bob.' when doc_id % 5 = 1 then ' Bearer abcdefghij0123456789 sk-' || repeat('a', 20) else '' end"


@query("select doc_id, sha256({}) as redacted, ({})::bigint as redactions from (select doc_id, {} as text from documents)".format(*redacted_sql("text"), _SAID))
def doc_redaction(spark, sf_dir):
    i = F.col("doc_id") % 5
    more = F.when(i == 0, " /home/ann/x and C:\\Users\\bob.").when(i == 1, " Bearer abcdefghij0123456789 sk-" + "a" * 20).otherwise("")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", more).alias("text"))
    return text.redacted(docs, "text", "clean", "redactions").select("doc_id", identity.digest(F.col("clean")).alias("redacted"), "redactions")


@query("""select doc_id, sha256(case when length(text) > 1000 then substr(text, 1, 690) || chr(10) || '<TRUNCATED>' || chr(10) || right(text, 297) else text end) as body,
    length(text) > 1000 as truncated from documents""")
def doc_payload_bounding(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", identity.digest(text.bounded(t, 1_000)).alias("body"), (F.length(t) > 1_000).alias("truncated"))


@query("select doc_id from documents d where not exists (select 1 from benchmark b where sha256(b.text) = sha256(d.text))")
def doc_contamination_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("h", identity.digest(F.col("text")))
    bench = table(spark, sf_dir, "benchmark").select(identity.digest(F.col("text")).alias("h"))
    return docs.join(bench, "h", "left_anti").select("doc_id")


@query("""select d.doc_id, l.quality, l.toxic from documents d join labels l using (doc_id) where l.quality = 1
    and l.doc_id in (select doc_id from labels group by doc_id having count(*) = 1)""")
def doc_review_semi_join(spark, sf_dir):
    accepted = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    ).filter("n = 1 and quality = 1").drop("n")
    return table(spark, sf_dir, "documents").select("doc_id").join(accepted, "doc_id")


@query("select source, doc_id, n_chars from (select *, row_number() over (partition by source order by n_chars desc, doc_id) as r from documents) where r = 1")
def doc_one_per_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return selection.keep_first(docs, F.col("source"), [-F.col("n_chars"), F.col("doc_id")])


@query("select lang, doc_id, r as rank from (select *, row_number() over (partition by lang order by sha256(doc_id::varchar), doc_id desc) as r from documents) where r <= 20")
def doc_topk_hash_rank(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return selection.top_k(docs, ["lang"], [identity.digest(F.col("doc_id")), F.desc("doc_id")], 20)


@query("""select source, doc_id, r as rank from (select *, row_number() over (partition by source order by doc_id) as r from documents)
    where r <= 3 order by r, source limit 40""")
def doc_round_robin_caps(spark, sf_dir):
    return selection.round_robin(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], 3, 40)


@query("""with l as (select lang, row_number() over (order by lang) as k, count(*) over () as n from (select distinct lang from documents)),
    r as (select lang, doc_id, row_number() over (partition by lang order by doc_id) as rank from documents)
    select lang, doc_id, rank from r join l using (lang) where rank <= 50 // n + (case when k <= 50 % n then 1 else 0 end)""")
def doc_balanced_quota(spark, sf_dir):
    return selection.balanced(table(spark, sf_dir, "documents").select("lang", "doc_id"), "lang", ["doc_id"], 50).select("lang", "doc_id", "rank")


@query("""select lang, count(*) filter (quality = 1) as part, count(*) filter (quality = 0) as rest,
    greatest(0, floor((count(*) filter (quality = 1) * 5 - 4 * count(*) filter (quality = 1)) / 4))::bigint as cap
    from documents join labels using (doc_id) group by lang""")
def doc_target_balance(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    sums = both.groupBy("lang").agg(F.count_if(F.col("quality") == 1).alias("part"), F.count_if(F.col("quality") == 0).alias("rest"))
    return sums.withColumn("cap", selection.effective_cap(F.col("part"), F.col("rest"), 4, 5))


@query(f"with {_PROMPTS} select conv_id, row_number() over (partition by prompt_digest order by conv_id) > 2 as over from p")
def prompt_duplicate_cap(spark, sf_dir):
    prompts = sessions.latest_prompt(conversations(spark, sf_dir))
    return selection.over_cap(prompts, ["prompt_digest"], ["conv_id"], 2).select("conv_id", "over")


@query("""select doc_id, case when toxic = 1 then 'quarantine' when quality = 0 or n_chars < 200 then 'review_required' when quality is null then 'unassessed' else 'candidate' end as partition_,
    trim(concat(case when toxic = 1 then 'toxic,' else '' end, case when quality = 0 then 'low_quality,' else '' end, case when n_chars < 200 then 'short' else '' end), ',') as reasons
    from documents left join labels using (doc_id)""")
def doc_decision_ledger(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    toxic, low, short = F.col("toxic") == 1, F.col("quality") == 0, F.col("n_chars") < 200
    reasons = F.array(F.when(toxic, F.lit("toxic")), F.when(low, F.lit("low_quality")), F.when(short, F.lit("short")))
    return both.select(
        "doc_id",
        F.when(toxic, "quarantine").when(low | short, "review_required").when(F.col("quality").isNull(), "unassessed").otherwise("candidate").alias("partition_"),
        F.array_join(F.filter(reasons, lambda r: r.isNotNull()), ",").alias("reasons"),
    )


@query("""with r as (select lang, n_chars, row_number() over (partition by lang order by n_chars) as k, count(*) over (partition by lang) as n from documents)
    select lang, max(n) as n, min(n_chars) as least, max(case when k = ceil(0.5 * n) then n_chars end) as p50,
           max(case when k = ceil(0.95 * n) then n_chars end) as p95, max(n_chars) as most from r group by lang""")
def doc_length_percentiles(spark, sf_dir):
    n = F.expr("n_chars")
    exact = lambda p: F.expr(f"percentile_disc({p}) within group (order by n_chars)").cast("long")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").alias("n"), F.min(n).alias("least"), exact(0.5).alias("p50"), exact(0.95).alias("p95"), F.max(n).alias("most")
    )


EV = "e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events)"


@query(f"""with {EV} select event_id, ordinal, row_number() over w - 1 as prior, ordinal - lag(ordinal) over w as distance,
    coalesce(ordinal - lag(ordinal) over w = 1, false) as immediate from e window w as (partition by user_id, event_type order by ordinal)""")
def evt_turn_recurrence(spark, sf_dir):
    return sequence.recurrence(ordered_events(spark, sf_dir), "user_id", "event_type").select("event_id", "ordinal", "prior", "distance", "immediate")


@query(f"""with {EV}, l as (select event_id, event_type as a, lag(event_type, 1) over w as b, lag(event_type, 2) over w as c, lag(event_type, 3) over w as d,
      lag(event_type, 4) over w as f, lag(event_type, 5) over w as g from e window w as (partition by user_id order by ordinal)),
    p as (select event_id, coalesce(a = b, false) as p1, coalesce(a = c and b = d, false) as p2, coalesce(a = d and b = f and c = g, false) as p3 from l)
    select event_id, p2 as period_2, p3 as period_3, case when p1 then 1 when p2 then 2 when p3 then 3 end as smallest from p""")
def evt_cycle_periods(spark, sf_dir):
    return sequence.cycles(ordered_events(spark, sf_dir), "user_id", "event_type").select("event_id", "period_2", "period_3", "smallest")


@query(f"""with {EV} select event_id, value <> last_value(value ignore nulls) over (partition by user_id, event_type order by ordinal
    rows between unbounded preceding and 1 preceding) as novel from e""")
def evt_novelty(spark, sf_dir):
    return sequence.novelty(ordered_events(spark, sf_dir), "user_id", "event_type", "value").select("event_id", "novel")


@query(f"""with {EV}, v as (select user_id as ep, ordinal as ix, event_type as kind, json_extract_string(props, '$.k') as cid from e where event_type in ('click', 'purchase')),
    c as (select *, count(*) filter (kind = 'click') over (partition by ep) as na, count(*) filter (kind = 'purchase') over (partition by ep) as no_,
      last_value(case when kind = 'click' then ix end ignore nulls) over (partition by ep order by ix rows between unbounded preceding and 1 preceding) as act,
      count(cid) over (partition by ep, kind, cid) as n from v),
    p1 as (select a.ep, a.ix ai, o.ix oi from c a join c o on a.ep = o.ep and a.kind = 'click' and o.kind = 'purchase' and a.cid = o.cid and a.n = 1 and o.n = 1),
    c2 as (select o.ep, o.act ai, o.ix oi from c o join c a on a.ep = o.ep and a.ix = o.act where o.kind = 'purchase' and not coalesce(a.cid <> o.cid, false)
      and not exists (select 1 from p1 where p1.ep = o.ep and p1.oi = o.ix) and not exists (select 1 from p1 where p1.ep = o.ep and p1.ai = o.act)),
    p2 as (select ep, ai, min(oi) oi from c2 group by ep, ai having count(*) = 1),
    p3 as (select a.ep, a.ix ai, o.ix oi from c a join c o on a.ep = o.ep where a.kind = 'click' and o.kind = 'purchase' and a.na = 1 and a.no_ = 1 and not coalesce(a.cid <> o.cid, false))
    select a.ep as user_id, a.ix as ordinal, coalesce(p1.oi, p2.oi, p3.oi) as observation,
      case when p1.oi is not null then 'call-id' when p2.oi is not null then 'event-order' when p3.oi is not null then 'singleton-fallback' else 'unmatched' end as match
    from c a left join p1 on p1.ep = a.ep and p1.ai = a.ix left join p2 on p2.ep = a.ep and p2.ai = a.ix left join p3 on p3.ep = a.ep and p3.ai = a.ix where a.kind = 'click'""")
def evt_interval_match(spark, sf_dir):
    e = ordered_events(spark, sf_dir).withColumn("cid", F.get_json_object("props", "$.k"))
    return sequence.interval_match(e, "user_id", "event_type", "cid", "click", "purchase")


@query(f"""with {EV}, r as (select user_id, event_type, ordinal, row_number() over (partition by user_id, event_type order by ordinal) as k from e)
    select a.user_id, a.k, a.ordinal as left_at, b.ordinal as right_at from r a left join r b on a.user_id = b.user_id and a.k = b.k and b.event_type = 'purchase'
    where a.event_type = 'click'""")
def evt_fifo_pairing(spark, sf_dir):
    return sequence.fifo_pairs(ordered_events(spark, sf_dir), ["user_id"], "event_type", "click", "purchase")


@query(f"""with {EV}, l as (select *, max(case when event_type = 'error' then ordinal end) over (partition by user_id) as mark_at from e)
    select user_id, max(mark_at) as mark_at, min(case when event_type = 'purchase' and ordinal > mark_at then ordinal end) as after_at from l group by user_id""")
def evt_first_after_error(spark, sf_dir):
    return sequence.first_after(ordered_events(spark, sf_dir), "user_id", F.col("event_type") == "error", F.col("event_type") == "purchase")


@query(f"""with recursive {EV}, h(user_id, ordinal, state) as (
      select user_id, -1::bigint, sha256('state') from e where ordinal = 0
      union all select h.user_id, e.ordinal, sha256('state' || h.state || sha256(e.event_type || '|' || e.props)) from h join e on e.user_id = h.user_id and e.ordinal = h.ordinal + 1)
    select user_id, max(ordinal) + 1 as n_events, arg_max(state, ordinal) as state from h group by user_id""")
def evt_state_chain(spark, sf_dir):
    return sequence.state_chain(ordered_events(spark, sf_dir), "user_id", F.concat_ws("|", "event_type", "props"))


@query(f"""with {EV}, t as (select user_id, ordinal, row_number() over (partition by user_id, event_type order by ordinal) as times from e)
    select user_id, max(times) as most, min(case when times > 10 then ordinal end) as stopped_at from t group by user_id""")
def evt_loop_guard(spark, sf_dir):
    return sequence.loop_guard(ordered_events(spark, sf_dir), "user_id", "event_type", 10)


@query("""select user_id, json_extract_string(props, '$.k') as cid, count(*) filter (event_type = 'click') as opened, count(*) filter (event_type = 'purchase') as closed
    from events group by 1, 2 having count(*) filter (event_type = 'click') > count(*) filter (event_type = 'purchase')""")
def evt_open_ids(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("cid", F.get_json_object("props", "$.k"))
    return sequence.open_ids(e, ["user_id", "cid"], "event_type", "click", "purchase")


@query("""with s as (select user_id, sum(case when event_id % 2 = 0 then (value * 100)::bigint end) as baseline, sum(case when event_id % 2 <> 0 then (value * 100)::bigint end) as candidate from events group by user_id)
    select user_id, baseline::bigint as baseline, candidate::bigint as candidate, case when candidate > baseline then 'win' when candidate < baseline then 'loss' else 'tie' end as result from s
    where baseline is not null and candidate is not null""")
def evt_paired_compare(spark, sf_dir):
    return sequence.paired_runs(table(spark, sf_dir, "events"), "user_id", F.col("event_id") % 2 == 0, F.round(F.col("value") * 100).cast("long"))


@query("""with a as (select o_orderkey as k, o_orderstatus as v from orders), b as (select l_orderkey as k, max(l_linestatus) as v from lineitem group by 1)
    select k, a.v as before, b.v as after, case when b.v is null then 'missing_from_snapshot' when a.v is null then 'new_in_snapshot' when a.v = b.v then 'stable' else 'changed' end as status
    from a full outer join b using (k)""")
def src_full_outer_manifest(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("v"))
    return audit.manifest(a, b, ["k"], "v")


@query("""with l as (select l_orderkey, bool_or(l_returnflag = 'R') as returned from lineitem group by 1), j as (select o.*, l.l_orderkey is not null as hit, coalesce(returned, false) as returned from orders o left join l on l_orderkey = o_orderkey)
    select count(*) as rows, sum(case when hit and returned then 1 else 0 end) / count(*)::double as strong_rows,
           sum(case when hit and returned then o_custkey else 0 end) / sum(o_custkey)::double as strong_size, sum(case when not (hit and returned) and hit then 1 else 0 end) / count(*)::double as weak_rows from j""")
def src_coverage(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"))
    j = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    hit = F.col("l_orderkey").isNotNull()
    return audit.coverage(j, hit & F.coalesce("returned", F.lit(False)), hit, F.col("o_custkey"))


@query("""with s as (select s_nationkey, count(*) as n from supplier group by 1)
    select p_partkey, case when p_partkey % 7 = 0 then 'exact_ref' when n = 1 then 'unique_digest' when n > 1 then 'ambiguous_digest' when p_size < 10 then 'blocked' else 'unparsed' end as status
    from part left join s on p_size = s_nationkey""")
def src_adapter_priority(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    j = table(spark, sf_dir, "part").join(s, F.col("p_size") == F.col("s_nationkey"), "left")
    return j.select("p_partkey", audit.match_status(F.col("p_partkey") % 7 == 0, F.col("n"), F.col("p_size") < 10).alias("status"))


@query("select c_mktsegment, c_nationkey, count(*) as files, sum(c_custkey)::bigint as size from customer group by grouping sets ((c_mktsegment), (c_mktsegment, c_nationkey))")
def src_two_level_rollup(spark, sf_dir):
    return audit.two_level_counts(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey", "c_custkey")


@query("""with r as (select *, row_number() over (partition by o_custkey order by o_orderstatus, o_orderkey) as a, row_number() over (partition by o_custkey order by o_orderstatus desc, o_orderkey) as z from orders)
    select x.o_custkey, x.o_orderkey as chosen, y.o_orderkey as rejected from r x join r y on x.o_custkey = y.o_custkey and x.a = 1 and y.z = 1 and x.o_orderstatus <> y.o_orderstatus""")
def pair_same_state(spark, sf_dir):
    return audit.same_state_pairs(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderkey")


@query("select o_custkey, count(*) as n from orders group by o_custkey having count(distinct o_orderstatus) > 2")
def pair_constraints(spark, sf_dir):
    return audit.violations(table(spark, sf_dir, "orders"), ["o_custkey"], F.countDistinct("o_orderstatus") > 2)


@query("""select event_type, key, count(*) as present, 'number' as types from (select event_type, unnest(json_keys(props)) as key from events) group by 1, 2""")
def schema_infer_props(spark, sf_dir):
    return audit.key_schema(table(spark, sf_dir, "events"), "props", "event_type")


@query("""select o_custkey, arg_min(o_orderstatus, case o_orderstatus when 'F' then 0 when 'P' then 1 else 2 end) as lane, count(distinct o_orderstatus) as lanes from orders group by o_custkey""")
def resolve_split_conflict(spark, sf_dir):
    return selection.resolve_lanes(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", {"F": 0, "P": 1, "O": 2})


@query()
def replay_greedy_cover(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.concat_ws(":", "event_type", F.get_json_object("props", "$.k")).alias("item"))
    picked = selection.greedy_cover(e, "user_id", "item", 5)
    return spark.createDataFrame(picked, "user_id bigint, gain bigint")


@query("""with r as (select doc_id, n_chars, sum(greatest(n_chars, 1)) over (order by sha256('seed:' || doc_id::varchar), doc_id rows unbounded preceding) as running from documents)
    select doc_id, running::bigint as running from r where running <= 200000""")
def seeded_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", identity.digest(F.concat(F.lit("seed:"), F.col("doc_id").cast("string"))).alias("h"))
    return selection.within_budget(docs, ["h", "doc_id"], F.greatest("n_chars", F.lit(1)), 200_000, F.substring("h", 1, 3)).select("doc_id", "running")


def _firewall_sql() -> str:
    private = text.PRIVATE_VALUE.replace("'", "''")
    return f"""select doc_id, trim(concat(case when regexp_matches(text, '{text.TRAINER_MARKER}') then 'marker,' else '' end,
      case when regexp_matches(text, '{private}') then 'private_value,' else '' end, case when regexp_matches(text, '{text.SECRET_VALUE}') then 'secret_value' else '' end), ',') as findings
      from documents"""


@query(_firewall_sql())
def doc_firewall(spark, sf_dir):
    return gates.firewall(table(spark, sf_dir, "documents"), "text").select("doc_id", F.array_join("findings", ",").alias("findings"))


@query(f"""with f as ({_firewall_sql()}), g as (select doc_id, findings, source, case when quality = 0 then 'review_required' when quality = 1 then 'candidate' else 'unassessed' end as gate
      from f join documents using (doc_id) left join labels using (doc_id))
    select doc_id, case when contains(findings, 'secret_value') or contains(findings, 'private_value') or source = 'src3' then 'quarantine'
      when contains(findings, 'marker') and gate = 'candidate' then 'review_required' else gate end as partition_ from g""")
def doc_gate_lattice(spark, sf_dir):
    docs = gates.firewall(table(spark, sf_dir, "documents"), "text").select("doc_id", "source", "findings")
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    gate = F.when(F.col("quality") == 0, "review_required").when(F.col("quality") == 1, "candidate").otherwise("unassessed")
    lineage = F.coalesce(F.col("source") != "src3", F.lit(False))
    return rows.select("doc_id", gates.decide(gate, F.col("findings"), lineage, F.array().cast("array<string>")).alias("partition_"))


@query("""with g as (select o_custkey as p, count(distinct o_orderstatus) as n, min(o_orderkey) as k from orders group by 1)
    select o_custkey, o_orderstatus, o_orderkey from orders join g on p = o_custkey and k = o_orderkey where n = 1""")
def pair_conflicting_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    return gates.conflicting_labels(rows, "o_custkey", "o_orderstatus", ["o_orderkey"])


@query("select l_partkey from lineitem group by 1 having count(distinct l_returnflag) > 1")
def pair_split_conflicts(spark, sf_dir):
    return gates.split_conflicts(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag")


@query("""with r as (select conv_id, turn, sum(length(text)) over (partition by conv_id order by turn desc rows unbounded preceding) as newest from conversations)
    select conv_id, turn, newest::bigint as newest from r where newest <= 600""")
def conv_retained_suffix(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ordinal"), F.length("text").alias("tokens"))
    return gates.retained_suffix(turns, "conv_id", "tokens", 600).select("conv_id", F.col("ordinal").alias("turn"), "newest")


@query("""with a as (select doc_id, quality = 1 as accepted from labels), c as (select doc_id, count(*) as n from documents group by 1)
    select doc_id, coalesce(n, 0) as matches from a left join c using (doc_id) where accepted and coalesce(n, 0) <> 1""")
def doc_review_mismatches(spark, sf_dir):
    units = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("accepted"))
    return gates.reviewed(table(spark, sf_dir, "documents").select("doc_id"), units, "doc_id")[1]


@query("select event_type, count(*) as n from events group by event_type")
def stream_checkpoint_ingest(spark, sf_dir):
    return ingest.count_by(spark, f"{sf_dir}/events.parquet", "event_type")


@query()
def stream_episode_state(spark, sf_dir):
    return ingest.episode_states(spark, f"{sf_dir}/events.parquet")
