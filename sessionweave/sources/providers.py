"""Session logs of known providers as unified messages: ``session_id, position, role, text, calls, answers``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.operators.normalize import field, first_field, text_of, tool_call

CALLS = "array<struct<call_id:string,name:string,arguments:string>>"


def _ordered(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("session_id").orderBy("at", "sha256")
    return rows.select("session_id", (F.row_number().over(w) - 1).alias("position"), "role", "text", "calls", "answers")


def rollout(lines: DataFrame, session: str = "file") -> DataFrame:
    """Event lines ``{type, timestamp, payload}``: messages, function calls and their outputs."""
    p = F.try_variant_get("record", "$.payload", "variant")
    kind = field(p, "type")
    role = (
        F.when(kind == "user_message", "user").when(kind == "agent_message", "assistant").when(kind == "message", field(p, "role"))
        .when(kind.isin("function_call", "tool_use"), "assistant").when(kind.isin("function_call_output", "tool_result"), "tool")
    )
    body = text_of(F.coalesce(*(F.try_variant_get(p, f"$.{k}", "variant") for k in ("content", "message", "output"))))
    rows = lines.select(
        F.col(session).alias("session_id"), field(F.col("record"), "timestamp").alias("at"), "sha256", role.alias("role"), F.coalesce(body, F.lit("")).alias("text"),
        F.when(kind.isin("function_call", "tool_use"), F.array(tool_call(p))).otherwise(F.array().cast(CALLS)).alias("calls"),
        F.when(kind.isin("function_call_output", "tool_result"), first_field(p, ("call_id", "id"))).alias("answers"),
    )
    return _ordered(rows.filter("role is not null"))


def turns(lines: DataFrame) -> DataFrame:
    """Lines ``{type, sessionId, timestamp, message}`` with content blocks; calls stand in ``tool_use`` blocks."""
    r = F.col("record")
    blocks = F.coalesce(F.try_variant_get(r, "$.message.content", "array<variant>"), F.array().cast("array<variant>"))
    used = F.filter(blocks, lambda b: field(b, "type") == "tool_use")
    answered = F.filter(blocks, lambda b: field(b, "type") == "tool_result")
    result = F.get(F.transform(answered, lambda b: field(b, "tool_use_id")), F.lit(0))
    role = F.when(result.isNotNull() | (field(r, "type") == "tool_result"), "tool").when(field(r, "type").isin("user", "assistant"), field(r, "type"))
    rows = lines.select(
        field(r, "sessionId").alias("session_id"), field(r, "timestamp").alias("at"), "sha256", role.alias("role"),
        F.coalesce(text_of(F.try_variant_get(r, "$.message.content", "variant")), F.lit("")).alias("text"),
        F.transform(used, tool_call).alias("calls"), result.alias("answers"),
    )
    return _ordered(rows.filter("role is not null and session_id is not null"))
