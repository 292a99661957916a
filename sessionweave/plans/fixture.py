"""Session-shaped inputs made of the tables: raw records of assistant sessions as JSON text.

Every user of ``events`` is a session, every ten of its events are one record (a
segment of the session), and every event is a message: views are user turns,
clicks are tool calls, purchases are what tools answered, errors are final
answers, sign-ups are system messages.  Aliases, secrets, hidden keys, conflicts
and gaps are dealt by the ids, so that SQL over ``events`` alone can state what
any rule must make of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Events a record.
SEGMENT = 10
#: What a tool call names, by event id modulo five.
TOOLS = ("exec_command", "read_file", "web_search", "sequential_thinking", "git_commit")
SOURCES = ("claude-code", "Codex", "cursor_chat", "pi", "made_up", None)
MODELS = ("claude-sonnet-4", "qwen3-32b", "ollama/llama3", "gpt-5", None)
TIERS = ("frontier", "Local", None, None, None, None, None)
LANES = ("optional_alt", "weird", None, None, None)
OUTCOMES = ("success", "partial", None, "odd")


def pick(index, values):
    """The value at an index; null entries stay null."""
    return F.get(F.array(*(F.lit(v).cast("string") for v in values)), index.cast("int"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, rec, mi, event_id, message)`` with the message as a struct."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.withColumn("ordinal", F.row_number().over(w) - 1).withColumn("k", F.get_json_object("props", "$.k"))
    i, t = F.col("event_id"), F.col("event_type")
    kind = lambda n: t == n
    role = (
        F.when(i % 29 == 0, "narrator").when(kind("view"), "human").when(kind("signup"), "Developer").when(kind("click"), "agent")
        .when(kind("purchase"), "tool_result").otherwise("gemini")
    )
    said = F.when(i % 3 == 0, F.format_string("Please fix the failing test %d", i)).when(
        i % 3 == 1, F.format_string("What is the price of %d? mail ann%d@mail.example.com", i, i)
    ).otherwise(F.format_string("implement /home/ann%d/x and password=abc%d using Claude", i, i))
    done = F.when(i % 4 == 0, F.format_string("done <thinking>secret %d</thinking> ok", i)).otherwise(F.format_string("done %d", i))
    content = F.when(kind("view"), said).when(kind("signup"), F.format_string("session %d", "user_id")).when(kind("purchase"), F.format_string("out %d", i)).when(
        kind("error"), done
    ).otherwise("")
    arguments = F.format_string('{"cmd":"ls %d","thought":"x"}', i)
    call = F.struct(
        F.concat(F.lit("c"), "k").alias("id"), F.lit("function").alias("type"),
        F.struct(pick(i % 5, TOOLS).alias("name"), arguments.alias("arguments")).alias("function"),
    )
    bought = lambda c: F.when(kind("purchase"), c)
    message = F.struct(
        role.alias("role"), content.alias("content"), F.when(kind("click"), F.array(call)).alias("tool_calls"),
        bought(F.concat(F.lit("c"), "k")).alias("tool_call_id"), bought((F.col("value") > 50).cast("int")).alias("returncode"),
        bought(F.when(i % 7 == 0, "failed")).alias("status"), bought(F.when(i % 11 == 0, "boom")).alias("error"),
    )
    return e.select("user_id", F.floor(F.col("ordinal") / SEGMENT).alias("rec"), (F.col("ordinal") % SEGMENT).alias("mi"), "event_id", message.alias("message"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, rec, record)``: one raw record a segment, as JSON text without null fields."""
    of = messages(spark, sf_dir).groupBy("user_id", "rec").agg(F.array_sort(F.collect_list(F.struct("mi", "message"))).alias("m"))
    u, r = F.col("user_id"), F.col("rec")
    record = F.struct(
        F.format_string("s%d", u).alias("session_id"), pick(u % 6, SOURCES).alias("source"), pick(u % 5, MODELS).alias("model"),
        pick(u % 7, TIERS).alias("model_tier"), pick(u % 5, LANES).alias("training_lane"), pick(r % 4, OUTCOMES).alias("outcome"),
        F.when(r % 4 == 2, F.lit(True)).alias("success"), F.when(r % 3 == 0, F.lit(1.5)).alias("reward"),
        F.when(u % 10 == 3, F.struct(F.lit("review_required").alias("gate"), F.array(F.lit("seen"), F.lit("by_hand")).alias("flags"))).alias("quality_assessment"),
        F.when(r % 9 == 5, F.array(F.struct(F.lit("x").alias("kind")))).alias("observation_truncations"),
        F.format_string("/srv/u%d", u).alias("cwd"), F.when(u % 4 == 1, F.lit("plan Mode!")).alias("mode"),
        F.when(r > 0, F.sha2(F.format_string("s%d", u), 256)).alias("_chunk_parent_record_sha256"), r.alias("_chunk_index"), F.lit(5).alias("_chunk_count"),
        F.when(u % 3 == 0, F.array(*(F.struct(F.lit("function").alias("type"), F.struct(F.lit(n).alias("name")).alias("function")) for n in ("exec_command", "scratch_pad")))).alias("tools"),
        F.when(u % 8 == 0, F.lit("high")).alias("reasoning_effort"), F.when(u % 2 == 0, F.sha2(F.format_string("f%d", u), 256)).alias("source_sha256"),
        F.when(u % 3 == 0, F.lit("p1")).alias("parser_revision"), F.when(u % 4 == 0, F.lit("snap")).alias("snapshot_id"),
        F.when(r % 2 == 0, F.array(r * SEGMENT, r * SEGMENT + SEGMENT - 1)).alias("message_index_range"),
        F.transform("m", lambda x: x["message"]).alias("messages"),
    )
    return of.select("user_id", "rec", F.to_json(record).alias("record"))


def _choose(index: str, values) -> str:
    return f"case {index} " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(values) if v is not None) + " end"


#: The same in SQL: ``msg`` holds what each message becomes, ``rec`` what the fields of each record are.
SQL = f"""
    ev as (
      select *, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal, json_extract_string(props, '$.k') as k, event_id as i from events
    ), raw as (
      select *, ordinal // {SEGMENT} as rec, ordinal % {SEGMENT} as mi,
        case when i % 29 = 0 then null when event_type = 'view' then 'user' when event_type = 'signup' then 'system' when event_type = 'purchase' then 'tool' else 'assistant' end as role,
        {_choose('i % 5', TOOLS)} as tool,
        case event_type when 'view' then case i % 3 when 0 then 'Please fix the failing test ' || i when 1 then 'What is the price of ' || i || '? mail <PRIVATE_EMAIL>'
               else 'implement <PRIVATE_PATH>/x and password=<SECRET> using Claude' end
          when 'signup' then 'session ' || user_id when 'purchase' then 'out ' || i
          when 'error' then case when i % 4 = 0 then 'done  ok' else 'done ' || i end else '' end as content
      from ev
    ), seen as (
      select *, event_type = 'click' and tool <> 'sequential_thinking' as calls from raw where role is not null
    ), msg as (
      select *, row_number() over (partition by user_id, rec order by mi) - 1 as position from seen where content <> '' or calls or role = 'tool'
    ), rec as (
      select distinct user_id, rec, 's' || user_id as session_id, {_choose('user_id % 6', SOURCES)} as source, {_choose('user_id % 5', MODELS)} as model,
        {_choose('user_id % 7', TIERS)} as model_tier, {_choose('user_id % 5', LANES)} as training_lane, {_choose('rec % 4', OUTCOMES)} as outcome from raw
    )
"""
