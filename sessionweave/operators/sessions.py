"""Operators over conversations: one row a message in, one row a session or message out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.identity import canonical_role, digest, three_way_split
from sessionweave.functions.text import task_family


def gather(messages: DataFrame, session: str = "conv_id", ordinal: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(session, messages)``: each session's messages in order, roles by their aliases, unknown roles dropped."""
    known = messages.withColumn("__role", canonical_role(F.col(role))).filter("__role is not null")
    entry = F.struct(F.col(ordinal).alias("ordinal"), F.col("__role").alias("role"), F.col(text).alias("text"))
    return known.groupBy(session).agg(F.array_sort(F.collect_list(entry)).alias("messages"))


def has(messages: Column, role: str) -> Column:
    return F.exists(messages, lambda m: (m["role"] == role) & (F.length(F.coalesce(m["text"], F.lit(""))) > 0))


def rejection_reasons(messages: Column) -> Column:
    """Why a session is no training example; empty if it is one."""
    reasons = F.array(
        F.when(F.size(messages) == 0, F.lit("messages_missing_or_not_list")),
        F.when(~has(messages, "user"), F.lit("user_turn_missing")),
        F.when(~has(messages, "assistant"), F.lit("assistant_turn_missing")),
    )
    return F.filter(reasons, lambda r: r.isNotNull())


def joined(messages: Column, role: str | None = None) -> Column:
    """Texts of a role, or of all, joined by line ends."""
    some = messages if role is None else F.filter(messages, lambda m: m["role"] == role)
    return F.array_join(F.transform(some, lambda m: m["text"]), "\n")


def content_key(messages: Column) -> Column:
    """Digest of roles and texts in order."""
    return digest(F.array_join(F.transform(messages, lambda m: F.concat_ws(":", m["role"], m["text"])), "\n"))


def training_examples(sessions: DataFrame, session: str = "conv_id") -> DataFrame:
    """First session of each content with its family, split and reasons for rejection."""
    m = F.col("messages")
    keyed = sessions.withColumn("content", content_key(m))
    first = Window.partitionBy("content").orderBy(session)
    return keyed.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select(
        session, F.size(m).cast("long").alias("n_messages"), task_family(joined(m, "user")).alias("task_family"),
        three_way_split(F.col("content")).alias("split"), F.array_join(rejection_reasons(m), ",").alias("reasons"),
    )


def last_user(messages: Column) -> Column:
    """Position (from 1) of the last user message, 0 without one."""
    at = F.transform(messages, lambda m, i: F.when(m["role"] == "user", i + 1).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(at), F.lit(0))


def latest_prompt(sessions: DataFrame, session: str = "conv_id") -> DataFrame:
    """Messages up to the last user turn; sessions without one have no prompt."""
    at = last_user(F.col("messages"))
    return sessions.filter(at > 0).select(
        session, at.cast("long").alias("n_prompt"), digest(joined(F.slice("messages", 1, at))).alias("prompt_digest")
    )


def prompt_groups(prompts: DataFrame) -> DataFrame:
    """Size of each row's group of equal prompts, and whether it repeats an earlier row."""
    return prompts.withColumn("group_size", F.count("*").over(Window.partitionBy("prompt_digest"))).withColumn(
        "duplicate", F.row_number().over(Window.partitionBy("prompt_digest").orderBy("conv_id")) > 1
    )


def bounded_context(messages: DataFrame, frame: int = 8, session: str = "conv_id", ordinal: str = "turn") -> DataFrame:
    """For each assistant message, the frame of the last messages up to and with it.

    If no user message is among them, the latest user message before takes the
    place of the oldest.
    """
    w = Window.partitionBy(session).orderBy(ordinal)
    before = w.rowsBetween(1 - frame, 0)
    seen = messages.withColumn("n", F.count("*").over(before)).withColumn(
        "n_user", F.count_if(F.col("role") == "user").over(before)
    ).withColumn("low", F.min(ordinal).over(before)).withColumn(
        "carried", F.max(F.when(F.col("role") == "user", F.col(ordinal))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    carry = (F.col("n_user") == 0) & F.col("carried").isNotNull()
    return seen.filter("role = 'assistant'").select(
        session, ordinal, F.when(carry, F.least("n", F.lit(frame - 1)) + 1).otherwise(F.col("n")).alias("n_context"),
        F.when(carry, F.col("carried")).otherwise(F.col("low")).alias("first_turn"), carry.alias("carried_user"),
    )


def final_answers(sessions: DataFrame, least: int, most: int, session: str = "conv_id") -> DataFrame:
    """Sessions that end with an assistant message of a length within bounds, after a user message."""
    last = F.element_at("messages", -1)
    return sessions.filter(F.size("messages") > 0).filter(
        (last["role"] == "assistant") & F.length(last["text"]).between(least, most) & (last_user(F.col("messages")) > 0)
    ).select(session, F.length(last["text"]).cast("long").alias("answer_chars"), digest(last["text"]).alias("answer_digest"))


def segments(sessions: DataFrame, target: int, session: str = "conv_id") -> DataFrame:
    """Greedy cuts of long sessions at safe places, as a fold over each session's messages.

    A cut falls before a user message, or before an assistant message that
    follows a complete assistant one, once the segment holds both roles and the
    message would exceed the target size.
    """
    state = "struct<size:bigint,user:boolean,assistant:boolean,last:string,starts:array<int>,at:int>"
    start = F.lit(None).cast(state)
    start = F.struct(
        F.lit(0).cast("long").alias("size"), F.lit(False).alias("user"), F.lit(False).alias("assistant"),
        F.lit("").alias("last"), F.array().cast("array<int>").alias("starts"), F.lit(0).alias("at"),
    )

    def step(s: Column, m: Column) -> Column:
        n = F.length(F.coalesce(m["text"], F.lit(""))).cast("long")
        full = s["user"] & s["assistant"] & (s["size"] + n > target)
        safe = (m["role"] == "user") | ((m["role"] != "tool") & (s["last"] == "assistant"))
        cut = (s["at"] == 0) | (full & safe)
        return F.struct(
            F.when(cut, n).otherwise(s["size"] + n).alias("size"),
            ((m["role"] == "user") | (~cut & s["user"])).alias("user"),
            ((m["role"] == "assistant") | (~cut & s["assistant"])).alias("assistant"),
            m["role"].alias("last"),
            F.when(cut, F.concat(s["starts"], F.array(s["at"] + 1))).otherwise(s["starts"]).alias("starts"),
            (s["at"] + 1).alias("at"),
        )

    starts = F.aggregate("messages", start, step, lambda s: s["starts"])
    cut = sessions.select(session, F.size("messages").alias("n"), starts.alias("starts"))
    each = cut.select(session, "n", "starts", F.posexplode("starts").alias("k", "start"))
    return each.select(
        session, F.col("k").cast("long").alias("segment"), F.size("starts").cast("long").alias("segments"), F.col("start").cast("long").alias("first"),
        (F.coalesce(F.get("starts", F.col("k") + 1), F.col("n") + 1) - 1).cast("long").alias("last"),
    )


def neighbours(rows: DataFrame, parent: str, index: str) -> DataFrame:
    """Previous and next row of a parent where their indexes differ by one."""
    w = Window.partitionBy(parent).orderBy(index)
    step = lambda c, d: F.when((c - F.col(index)) * d == 1, c)
    return rows.withColumn("previous", step(F.lag(index).over(w), -1)).withColumn("next", step(F.lead(index).over(w), 1))
