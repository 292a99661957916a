"""Raw provider records (VARIANT) to messages, tool calls and events."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionweave.functions.identity import canonical_role

#: Keys of text content in order of preference, and aliases of a tool call's fields.
TEXT_KEYS = ("text", "content", "rawText", "message", "value")
CALL_ID = ("id", "call_id", "tool_call_id", "toolCallId")
CALL_NAME = ("name", "tool", "tool_name", "toolName")
CALL_ARGUMENTS = ("arguments", "input", "args", "parameters")
#: Keys whose values are hidden reasoning.
HIDDEN = re.compile(r"(?i)^(?:reasoning|thinking|reasoning_content|chain_of_thought|scratchpad)$")


def field(v: Column, path: str, kind: str = "string") -> Column:
    """Value at a path, null where it is absent or of another type."""
    return F.try_variant_get(v, f"$.{path}", kind)


def first_field(v: Column, paths: tuple[str, ...], kind: str = "string") -> Column:
    return F.coalesce(*(field(v, p, kind) for p in paths))


def text_of(content: Column) -> Column:
    """Text of a string, of an object's first text key, or of a list of either, joined by line ends."""
    one = lambda c: F.coalesce(F.when(F.schema_of_variant(c) == "STRING", c.cast("string")), first_field(c, TEXT_KEYS))
    parts = F.try_variant_get(content, "$", "array<variant>")
    shown = F.filter(parts, lambda p: ~F.coalesce(field(p, "type").isin("thinking", "reasoning", "image"), F.lit(False)))
    joined = F.array_join(F.filter(F.transform(shown, one), lambda t: F.length(t) > 0), "\n")
    return F.when(parts.isNotNull(), joined).otherwise(one(content))


def tool_call(v: Column) -> Column:
    """``(call_id, name, arguments)`` with defaults ``unknown`` and ``{}``; arguments are JSON text."""
    name = F.coalesce(field(v, "function.name"), first_field(v, CALL_NAME), F.lit("unknown"))
    arguments = F.coalesce(field(v, "function.arguments"), *(F.coalesce(field(v, p), F.to_json(F.try_variant_get(v, f"$.{p}", "variant"))) for p in CALL_ARGUMENTS), F.lit("{}"))
    return F.struct(first_field(v, CALL_ID).alias("call_id"), name.alias("name"), arguments.alias("arguments"))


def messages(records: DataFrame, record: str = "record") -> DataFrame:
    """A row a message: ``position, role, text, calls``, roles by alias; kept with text, calls or as a tool's answer."""
    r = F.col(record)
    listed = F.coalesce(*(F.try_variant_get(r, f"$.{k}", "array<variant>") for k in ("messages", "history", "conversation")))
    each = records.select(*records.columns, F.posexplode(listed).alias("position", "m"))
    m = F.col("m")
    calls = F.coalesce(F.transform(F.try_variant_get(m, "$.tool_calls", "array<variant>"), tool_call), F.array().cast("array<struct<call_id:string,name:string,arguments:string>>"))
    out = each.withColumn("role", canonical_role(first_field(m, ("role", "type", "author.role")))).withColumn(
        "text", F.coalesce(text_of(F.coalesce(F.try_variant_get(m, "$.content", "variant"), m)), F.lit(""))
    ).withColumn("calls", calls).withColumn("answers", first_field(m, ("tool_call_id", "call_id")))
    keep = F.col("role").isNotNull() & ((F.length("text") > 0) | (F.size("calls") > 0) | (F.col("role") == "tool"))
    return out.filter(keep).drop("m", record)


def status(error: Column, code: Column, told: Column) -> tuple[Column, Column]:
    """Status of an event, and where it comes from: errors first, then agreement of return code and status."""
    by_code = F.when(code.isNull(), None).when(code == 0, "success").otherwise("failure")
    value = F.when(error.isNotNull(), "failure").when(by_code.isNull(), F.coalesce(told, F.lit("unknown"))).when(
        told.isNull() | (told == by_code), by_code
    ).otherwise("unknown")
    source = F.when(error.isNotNull(), "error").when(by_code.isNotNull() & told.isNotNull() & (told != by_code), "conflicting_structured_evidence").when(
        by_code.isNotNull(), "return_code"
    ).when(told.isNotNull(), "status").otherwise("absent")
    return value, source


def clean_json(rows: DataFrame, column: str) -> DataFrame:
    """JSON text without hidden keys at any depth, and how many were dropped; text that does not parse becomes null.

    No built-in maps a nested value recursively, so batches go through Python.
    """

    def clean(value, count: list[int]):
        if isinstance(value, dict):
            count[0] += sum(bool(HIDDEN.match(k)) for k in value)
            return {k: clean(v, count) for k, v in value.items() if not HIDDEN.match(k)}
        return [clean(v, count) for v in value] if isinstance(value, list) else value

    @F.pandas_udf("clean string, hidden bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            out = []
            for t in s:
                count = [0]
                try:
                    out.append((json.dumps(clean(json.loads(t), count), ensure_ascii=False, sort_keys=True, separators=(",", ":")), count[0]))
                except (TypeError, ValueError):
                    out.append((None, 0))
            yield pd.DataFrame(out, columns=["clean", "hidden"])

    done = rows.withColumn("__c", run(F.col(column)))
    return done.select(*rows.columns, F.col("__c.clean").alias("clean"), F.col("__c.hidden").alias("hidden"))
