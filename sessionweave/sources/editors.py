"""Stores of editors and command-line agents to conversations.

Input is always a table: key-value rows of an SQLite file, blobs, JSON files or
event lines, as the readers of this package give them.  Which rows matter is a
filter, how stores fit together is a join; the JSON document of one row goes
through a function in Arrow batches.  A conversation is ``conversation`` (JSON
text with ``messages, source`` and what the store tells of it).
"""

from __future__ import annotations

import json
import struct
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.operators.records import canonical, each, first, objects, sub, token

#: Keys of editor stores, in order of preference.
CHAT_KEY = "workbench.panel.aichat.view.aichat.chatdata"
WINDSURF_KEYS = (CHAT_KEY, "aiChat.chatdata", "chat.data", "cascade.chatdata")
MODEL_ALIASES = ("modelId", "model", "modelName")
COPIED = {"codeBlocks": "code_blocks", "suggestedCodeBlocks": "suggested_code_blocks", "diffHistories": "diff_histories", "toolResults": "tool_results"}
GEMINI_FIELDS = ("sessionId", "projectHash", "startTime", "lastUpdated")


def selections(holder: dict) -> list[dict]:
    """Code that a user pointed at."""
    found = objects(holder.get("selections") or [])
    return [{"file": s["uri"]["fsPath"], "code": s.get("text", s.get("rawText", "")), "range": s.get("range")} for s in found if "fsPath" in sub(s, "uri")]


def told(**fields) -> dict:
    return {k: v for k, v in fields.items() if v not in (None, [], "")}


def bubble(b: dict, user, context: dict | None = None) -> dict:
    """A bubble as a message; ``user`` is the type of user bubbles."""
    mine = b.get("type") == user
    out = {"role": "user" if mine else "assistant", "content": b.get("rawText", b.get("text", "")) if isinstance(user, str) else b.get("text", "")}
    out |= told(code_context=selections(b if context is None else context))
    if not mine and not isinstance(user, str):
        out |= told(model=first(b, MODEL_ALIASES)) | {to: b[k] for k, to in COPIED.items() if b.get(k)}
    if b.get("suggestedDiffs"):
        out["suggested_diffs"] = b["suggestedDiffs"]
    return out


def conversation(messages: list[dict], source: str, **fields) -> Iterator[dict]:
    if messages:
        yield {"conversation": canonical({"messages": messages, "source": source} | told(**fields))}


def flags(messages: list[dict]) -> dict:
    diffs = ("suggested_code_blocks", "diff_histories", "suggested_diffs")
    return {"has_code_context": any("code_context" in m for m in messages), "has_diffs": any(k in m for m in messages for k in diffs)}


def tabs(source: str) -> Callable[[dict], Iterator[dict]]:
    """Chat tabs: a conversation a tab, a message a bubble."""

    def rows(data: dict) -> Iterator[dict]:
        for tab in objects(data.get("tabs") or []):
            messages = [bubble(b, "user") for b in objects(tab.get("bubbles") or [])]
            yield from conversation(messages, source, chat_title=tab.get("chatTitle"), tab_id=tab.get("tabId"), **flags(messages))

    return rows


def composed(data: dict, source: str, messages: list[dict], **fields) -> Iterator[dict]:
    """A composer's conversation; its configured model, where there is one, is that of all answers."""
    model = sub(data, "modelConfig").get("modelName")
    messages = [m | {"model": model} if model and m["role"] == "assistant" else m for m in messages]
    yield from conversation(messages, source, model=model, name=data.get("name", "Untitled"), **flags(messages), **fields)


def inline(data: dict) -> list[dict]:
    return [bubble(b, 1, sub(b, "context")) for b in objects(data.get("conversation") or []) if b.get("type") in (1, 2)]


def chat_tabs(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Editor chat of a workspace store ``(keys..., key, value)``."""
    return each(kv.filter(F.col("key") == CHAT_KEY), keys, "value", tabs("cursor-chat"), "conversation string")


def first_chat(kv: DataFrame, keys: list[str], names: tuple[str, ...] = WINDSURF_KEYS) -> DataFrame:
    """Chat under the first of several keys that a store holds."""
    rank = F.array_position(F.array(*(F.lit(n) for n in names)), F.col("key"))
    best = kv.filter(F.col("key").isin(*names)).groupBy(*keys).agg(F.min_by("value", rank).alias("value"))
    return each(best, keys, "value", tabs("windsurf-chat"), "conversation string")


def agent_chats(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Agent and flow conversations of a global store, by what their keys begin with or contain."""
    k = F.col("key")
    mine = k.rlike("^(?:composerData|agentData|flowData):") | k.rlike("(?i)agent|flow|cascade")

    def rows(data: dict) -> Iterator[dict]:
        listed = data.get("conversation") if isinstance(data.get("conversation"), list) else data.get("messages")
        made = [
            {"role": m["role"], "content": m.get("content", "")} if "role" in m else bubble(m, 1, sub(m, "context")) for m in objects(listed if isinstance(listed, list) else [])
        ]
        yield from conversation(made, "windsurf-agent", composer_id=data.get("composerId"), name=data.get("name"))

    return each(kv.filter(mine), keys, "value", rows, "conversation string")


def workspace_composers(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Composers of one workspace document."""

    def rows(data: dict) -> Iterator[dict]:
        for c in objects(data.get("allComposers") if isinstance(data.get("allComposers"), list) else []):
            yield from composed(c, "cursor-workspace-composer", inline(c), composer_id=c.get("composerId"))

    return each(kv.filter("key = 'composer.composerData'"), keys, "value", rows, "conversation string")


def service_prompts(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Prompts and generations of the old service, the i-th with the i-th; either may be missing."""
    side = lambda n: F.max(F.when(F.col("key") == f"aiService.{n}", F.from_json("value", "array<string>")))
    both = kv.groupBy(*keys).agg(side("prompts").alias("p"), side("generations").alias("g")).filter("p is not null or g is not null")
    none = F.array().cast("array<string>")
    zipped = both.select(*keys, F.posexplode(F.arrays_zip(F.coalesce("p", none).alias("p"), F.coalesce("g", none).alias("g"))).alias("place", "x"))
    one = zipped.select(*keys, "place", F.to_json(F.col("x")).alias("value"))

    def rows(data: dict) -> Iterator[dict]:
        p, g = (json.loads(data[k]) if data.get(k) else None for k in "pg")
        messages = [] if p is None else [{"role": "user", "content": p.get("text", "")} | told(command_type=p.get("commandType"))]
        model = None if g is None else first(g, MODEL_ALIASES)
        messages += [] if g is None else [{"role": "assistant", "content": g.get("text", g.get("message", ""))} | told(model=model)]
        yield from conversation(messages, "cursor-aiservice", model=model)

    return each(one, [*keys, "place"], "value", rows, "conversation string")


def composer_bubbles(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Bubbles stored apart, by the composer that their key names: ``(keys..., composer, bubbles)``."""
    part = F.split("key", ":")
    apart = kv.filter("key like 'bubbleId:%' and value is not null and value <> ''").select(*keys, part[1].alias("composer"), part[2].alias("bubble"), "value")
    entry = F.struct("bubble", "value")
    return apart.groupBy(*keys, "composer").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["value"]).alias("bubbles"))


def global_composers(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Composers of a global store: the conversation inside, or else the bubbles apart."""
    whole = kv.filter("key like 'composerData:%' and value is not null and value <> ''")
    named = F.coalesce(F.get_json_object("value", "$.composerId"), F.split("key", ":")[1])
    joined = whole.withColumn("composer", named).join(composer_bubbles(kv, keys), [*keys, "composer"], "left")
    both = joined.withColumn("value", F.to_json(F.struct(F.col("value").alias("data"), "bubbles")))

    def rows(x: dict) -> Iterator[dict]:
        data = json.loads(x["data"])
        messages = inline(data) or [bubble(json.loads(b), 1) for b in x.get("bubbles") or []]
        yield from composed(data, "cursor-global-composer", messages)

    return each(both, [*keys, "composer"], "value", rows, "conversation string")


# Trees of content-addressed blobs.


def tree_refs(data: bytes) -> list[str]:
    """Ids of a tree node's children: 32 bytes behind each length-delimited field one."""
    out, k = [], 0
    while k + 34 <= len(data):
        if data[k] == 0x0A and data[k + 1] == 0x20:
            out.append(data[k + 2 : k + 34].hex())
            k += 34
        else:
            k += 1
    return out


def hex_json(value: Column) -> Column:
    """Text of a JSON document that is stored in hexadecimal."""
    return F.decode(F.unhex(value), "UTF-8")


def blob_messages(blobs: DataFrame, roots: DataFrame, store: str = "store") -> DataFrame:
    """``(store, place, message)``: leaves that are messages, depth first from each store's root, every blob once.

    ``blobs`` holds ``store, id, data``, ``roots`` holds ``store, root``.  A store
    is one file of one session; its blobs meet in one group.
    """
    import pandas as pd

    def walk(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        data, out, seen = dict(zip(frame["id"], frame["data"], strict=True)), [], set()
        stack = [frame["root"].iloc[0]]
        while stack:
            at = stack.pop()
            if at in seen or at not in data:
                continue
            seen.add(at)
            raw = bytes(data[at])
            try:
                leaf = json.loads(raw)
            except ValueError:
                leaf = None
            if isinstance(leaf, dict) and "role" in leaf:
                out.append(canonical(leaf))
            else:
                stack += reversed(tree_refs(raw))
        return pd.DataFrame({store: [key[0]] * len(out), "place": range(len(out)), "message": out})

    kind = dict(blobs.dtypes)[store]
    return blobs.join(roots, store).groupBy(store).applyInPandas(walk, f"{store} {kind}, place bigint, message string")


# Session files.


def continue_session(data: dict) -> Iterator[dict]:
    """History items: text parts joined, calls, context, and the outputs of calls that are done."""
    messages = []
    for item in objects(data.get("history") or []):
        m = sub(item, "message")
        if not m:
            continue
        content = m.get("content", [])
        text = content if isinstance(content, str) else "\n".join(p.get("text", "") for p in objects(content if isinstance(content, list) else []) if p.get("type") == "text")
        done = [s for s in objects(item.get("toolCallStates") or []) if s.get("status") == "done" and "output" in s]
        results = [{"tool": sub(sub(s, "tool"), "function").get("name"), "output": s["output"]} for s in done]
        messages.append({"role": m.get("role"), "content": text} | told(tool_calls=m.get("toolCalls"), context_items=item.get("contextItems"), tool_results=results))
    yield from conversation(messages, "continue", session_id=data.get("sessionId"), title=data.get("title"), workspace=data.get("workspaceDirectory"))


def gemini_load(lines: Iterable[dict]) -> dict:
    """Event lines to a session: the last snapshot wins; calls that a later snapshot forgot are put back by message id."""
    meta, calls, snapshot, loose = {}, {}, None, []
    for e in objects(lines):
        given = sub(e, "$set")
        for holder in (e, given):
            meta |= {k: holder[k] for k in GEMINI_FIELDS if holder.get(k) is not None}
        if isinstance(given.get("messages"), list):
            snapshot = given["messages"]
            calls |= {m["id"]: m["toolCalls"] for m in objects(snapshot) if m.get("id") and m.get("toolCalls")}
        elif not given and e.get("type") in ("user", "gemini"):
            loose.append(e)
    messages = loose if snapshot is None else snapshot
    back = lambda m: m | {"toolCalls": calls[m["id"]]} if isinstance(m, dict) and not m.get("toolCalls") and m.get("id") in calls else m
    return meta | {"messages": [back(m) for m in messages]}


def gemini_sessions(lines: DataFrame, file: str, place: str, value: str) -> DataFrame:
    """``(file, record)``: sessions of event lines; a file is one session."""
    entry = F.struct(F.col(place), F.col(value).alias("v"))
    whole = lines.filter(F.try_parse_json(F.col(value)).isNotNull()).groupBy(file).agg(F.array_sort(F.collect_list(entry)).alias("l"))
    text = whole.select(file, F.concat(F.lit('{"lines":['), F.array_join(F.transform("l", lambda x: x["v"]), ","), F.lit("]}")).alias("value"))
    return each(text, [file], "value", lambda x: [{"record": canonical(gemini_load(x["lines"]))}], "record string")


def gemini_messages(data: dict) -> list[dict]:
    """Turns, calls and their outputs: function responses once a call id; a result kept on a call counts only without a response."""
    blocks = lambda m: m["content"] if isinstance(m.get("content"), list) else [m.get("content", "")]
    text = lambda m: "\n".join(t for b in blocks(m) if (t := b if isinstance(b, str) else b.get("text") if isinstance(b, dict) else None))
    answers = lambda m: [r for b in objects(blocks(m)) if (r := sub(b, "functionResponse")) and r.get("id")]
    raw = objects(data.get("messages") or [])
    answered = {r["id"] for m in raw if m.get("type") == "user" for r in answers(m)}
    out, done = [], set()
    tool = lambda i, n, v: {"role": "tool", "tool_call_id": i, "name": n or "unknown_tool", "content": v if isinstance(v, str) else canonical(v)}
    for m in raw:
        if m.get("type") == "user":
            out += [{"role": "user", "content": text(m)}] if text(m) else []
            for r in answers(m):
                if r["id"] not in done:
                    done.add(r["id"])
                    out.append(tool(r["id"], r.get("name"), r.get("response")))
        elif m.get("type") == "gemini":
            calls = [c for c in objects(m.get("toolCalls") or []) if c.get("id")]
            made = [{"id": c["id"], "name": c.get("name") or "unknown_tool", "arguments": c.get("args", {})} for c in calls]
            out.append({"role": "assistant", "content": text(m)} | told(tool_calls=made, model=m.get("model")))
            out += [tool(c["id"], c.get("name") or c.get("displayName"), c["result"]) for c in calls if "result" in c and c["id"] not in answered]
    return out


#: Line types of a session log that are messages.
LINE_ROLES = {"user": "user", "user_message": "user", "assistant": "assistant", "agent": "assistant", "agent_message": "assistant"}


def trae_lines(lines: list[dict], source: str = "trae") -> Iterator[dict]:
    """Message lines of a log, with what belongs to them; metadata lines tell of the whole."""
    messages, meta = [], {}
    for e in objects(lines):
        kind = e.get("type", e.get("role"))
        if kind == "metadata":
            meta |= sub(e, "data")
        elif kind in LINE_ROLES:
            more = ("context", "files") if LINE_ROLES[kind] == "user" else ("tool_use", "diffs", "edits")
            messages.append({"role": LINE_ROLES[kind], "content": e.get("message", e.get("content", ""))} | told(timestamp=e.get("timestamp"), **{k: e.get(k) for k in more}))
    yield from conversation(messages, source, **meta)


def trae_store(kv: DataFrame, keys: list[str]) -> DataFrame:
    """Conversations of a store whose keys speak of chats, conversations or agents."""

    def rows(data: dict) -> Iterator[dict]:
        listed = data.get("messages") or [m for m in objects(data.get("conversation") or []) if "role" in m]
        yield from conversation(objects(listed), "trae", **{k: v for k, v in data.items() if k not in ("messages", "conversation", "source")})

    return each(kv.filter(F.col("key").rlike("(?i)chat|conversation|agent")), keys, "value", rows, "conversation string")


# Message stores of parts.


def fold_parts(messages: DataFrame, parts: DataFrame, outputs: DataFrame | None = None) -> DataFrame:
    """Messages with texts, calls, results, diffs and counts of what was left out, from their parts in order.

    ``messages``: session, message, at, role; ``parts``: message, at, part, data
    (JSON); ``outputs``: call, output - of calls whose output lies in a file.
    """
    get = lambda p: F.get_json_object("data", f"$.{p}")
    kind = get("type")
    p = parts.select(
        "message", F.struct("at", "part").alias("o"), kind.alias("kind"), get("text").alias("text"), F.coalesce(get("callID"), get("toolCallID"), get("id")).alias("call"),
        F.coalesce(get("tool"), get("name")).alias("tool"), F.coalesce(get("state.input"), get("input")).alias("input"), F.coalesce(get("state.output"), get("output"), get("state.error"), F.when(kind == "tool-result", get("text"))).alias("output"),
        F.when(get("state.error").isNotNull(), "error").otherwise(F.coalesce(get("state.status"), get("status"), F.lit("unknown"))).alias("status"), get("hash").alias("hash"),
    )
    p = p.join(outputs.withColumnRenamed("output", "__file"), "call", "left") if outputs is not None else p.withColumn("__file", F.lit(None).cast("string"))
    said, tool = F.coalesce("__file", "output"), F.col("kind").isin("tool", "tool-call")
    some = lambda c, what: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("o", what.alias("v"))))), lambda x: x["v"])
    folded = p.groupBy("message").agg(
        F.array_join(some((F.col("kind") == "text") & (F.length("text") > 0), F.col("text")), "\n").alias("content"),
        some(tool, F.struct(F.col("call").alias("id"), F.col("tool").alias("name"), F.col("input").alias("arguments"))).alias("tool_calls"),
        some((tool & said.isNotNull()) | (F.col("kind") == "tool-result"), F.struct("call", "status", said.alias("output"), F.when(F.col("__file").isNotNull(), "external_tool_output").otherwise("message_part_state").alias("output_source"))).alias("tool_results"),
        some(F.col("kind") == "patch", F.col("hash")).alias("diffs"), F.count_if(F.col("kind") == "reasoning").alias("omitted_reasoning"),
    )
    return messages.join(folded, "message", "left")


def store_sessions(folded: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions in order of time, each with its number of messages, and their messages by place."""
    w = Window.partitionBy("session")
    placed = folded.withColumn("place", F.row_number().over(w.orderBy("at", "message")) - 1).withColumn("messages", F.count("*").over(w))
    return placed.join(sessions, "session")


def json_store(sessions: DataFrame, messages: DataFrame, parts: DataFrame) -> DataFrame:
    """A store of JSON files (one document a row, column ``value``): three readers joined on their ids."""
    get = lambda p: F.get_json_object("value", f"$.{p}")
    s = sessions.select(get("id").alias("session"), get("title").alias("title"), get("time.created").cast("long").alias("created"))
    m = messages.select(get("sessionID").alias("session"), get("id").alias("message"), get("time.created").cast("long").alias("at"), get("role").alias("role"))
    p = parts.select(get("messageID").alias("message"), F.coalesce(get("time.start").cast("long"), F.lit(0)).alias("at"), get("id").alias("part"), F.col("value").alias("data"))
    return store_sessions(fold_parts(m, p), s)


def sidecars(files: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sidecar files of sessions by the id that their base name is; each file once, unclaimed ones with a null session."""
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1)
    return files.withColumn("name", name).join(sessions.select(F.col("session").alias("name"), F.lit(True).alias("claimed")), "name", "left").withColumn(
        "session", F.when(F.col("claimed"), F.col("name"))
    ).drop("claimed")


def referenced_outputs(parts: DataFrame, files: DataFrame) -> DataFrame:
    """Output files that some part's data names, with the call that does: ``(call, path, output)``."""
    path = F.get_json_object("data", "$.state.metadata.outputPath")
    asked = parts.select(F.get_json_object("data", "$.callID").alias("call"), F.regexp_extract(path, r"([^/]+)$", 1).alias("name")).filter("name is not null and name <> ''")
    return files.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1)).join(asked.distinct(), "name").select("call", "path", "output")


def names_in(parts: DataFrame, names: DataFrame) -> DataFrame:
    """Names that occur anywhere in some part's text.

    Words of file names are looked up, not scanned for one by one: the texts are
    cut into runs of name characters once and joined.
    """
    words = parts.select(F.explode(F.array_distinct(F.regexp_extract_all("data", F.lit(r"([A-Za-z0-9_.-]+)"), F.lit(1)))).alias("name"))
    return names.join(words.distinct(), "name", "left_semi")


def desktop_store(data: bytes) -> dict[str, str]:
    """Keys and JSON texts of a store of length-prefixed pairs; what does not hold together ends it."""
    out, at = {}, 0

    def block(most: int) -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        (n,) = struct.unpack_from("<I", data, at)
        if n > most or at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    while (key := block(10_000)) is not None and (value := block(1_000_000)) is not None:
        try:
            out[key.decode("utf-8", "ignore")] = canonical(json.loads(value))
        except ValueError:
            continue
    return out


def emission_ledger(files: DataFrame, emitted: DataFrame) -> DataFrame:
    """Candidate files with their class and whether a session was emitted from them."""
    kind = (
        F.when(F.col("path").rlike(r"/storage/(?:message|part)/|opencode\.db$"), "conversation_store").when(F.col("path").rlike("/storage/session(?:_diff)?/"), "conversation_sidecar")
        .when(F.col("path").contains("/tool-output/"), "tool_output").otherwise("unknown")
    )
    return files.withColumn("class", kind).join(emitted.select("path", F.lit("emitted").alias("__e")).distinct(), "path", "left").withColumn(
        "status", F.coalesce("__e", F.lit("not_emitted"))
    ).drop("__e")


# Event logs.


#: Line types that tell an end, and blocks that are calls or hidden.
ENDS = ("session_exit", "session_end", "turn_end", "task_complete")
CALL_BLOCKS = {"toolcall", "tool_call", "tool_use", "function_call"}
HIDDEN_BLOCKS = {"thinking", "analysis", "reasoning", "thought"}
LOG_ROLES = {"user": "user", "developer": "system", "system": "system", "assistant": "assistant", "toolResult": "tool", "tool": "tool"}


def log_message(payload: dict) -> dict | None:
    """A log's message: role by alias, texts, calls; None where nothing of it is seen."""
    role, content = LOG_ROLES.get(payload.get("role")), payload.get("content")
    blocks = objects(content if isinstance(content, list) else [])
    kind = lambda b: str(b.get("type", "")).lower().replace("-", "_")
    text = content if isinstance(content, str) else "\n".join(b["text"] for b in blocks if kind(b) == "text" and b.get("text"))
    calls = [{"id": token(first(b, ("id", "toolCallId", "call_id"))), "name": first(b, ("name", "toolName")) or "unknown", "arguments": first(b, ("arguments", "input")) or {}} for b in blocks if kind(b) in CALL_BLOCKS]
    if role is None or not (text or calls or role == "tool"):
        return None
    answers = token(first(payload, ("toolCallId", "tool_call_id"))) if role == "tool" else None
    return {"role": role, "content": text} | told(tool_calls=calls, tool_call_id=answers, status="error" if payload.get("isError") else None)


def inspect_log(lines: Iterable[str]) -> dict:
    """One pass over a session log: what it holds, what stays open, how it ends."""
    n: Counter[str] = Counter()
    out, open_ids, models = {"session_id": None}, set(), set()
    for line in lines:
        try:
            e = json.loads(line)
        except ValueError:
            n["parse_errors"] += 1
            continue
        if not isinstance(e, dict):
            continue
        kind = e.get("type")
        out["session_id"] = str(e["id"]) if kind == "session" and e.get("id") is not None else out["session_id"]
        n["terminal_signals"] += kind in ENDS or (kind == "custom" and e.get("customType") in ENDS)
        payload = sub(e, "message") if kind == "message" else {}
        models |= {str(m) for m in (first(e, MODEL_ALIASES) if kind in ("model", "model_change", "session_init") else None, first(payload, ("model", "responseModel"))) if m}
        n["omitted_reasoning"] += sum(str(b.get("type", "")).lower() in HIDDEN_BLOCKS for b in objects(payload.get("content") if isinstance(payload.get("content"), list) else []))
        m = log_message(payload) if payload else None
        if m is None:
            continue
        n["messages"] += 1
        n[f"{m['role']}_messages"] += 1
        n["errors"] += m.get("status") == "error"
        ids = {c["id"] for c in m.get("tool_calls", ()) if c["id"]}
        n["calls"] += len(ids)
        if (i := m.get("tool_call_id")) is not None:
            n["observations"] += 1
            n["unmatched_observations"] += i not in open_ids
            open_ids.discard(i)
        open_ids |= ids
    return out | {k: n[k] for k in ("parse_errors", "terminal_signals", "omitted_reasoning", "messages", "user_messages", "assistant_messages", "tool_messages", "errors", "calls", "observations", "unmatched_observations")} | {
        "unmatched_calls": len(open_ids), "models": sorted(models)
    }


def log_gate(seen: dict) -> tuple[str, list[str]]:
    """Gate of an inspected session log and the flags behind it."""
    checks = {
        "source_parse_errors": seen["parse_errors"], "no_normalized_messages": not seen["messages"], "missing_user_objective": not seen["user_messages"],
        "missing_visible_assistant_response": not seen["assistant_messages"], "unmatched_tool_calls": seen["unmatched_calls"],
        "unmatched_tool_observations": seen["unmatched_observations"], "tool_error_observed": seen["errors"], "model_provenance_unknown": not seen["models"],
    }
    flags_ = [f for f, hit in checks.items() if hit]
    bad = {"source_parse_errors", "no_normalized_messages"} & set(flags_)
    soft = {"missing_user_objective", "missing_visible_assistant_response", "unmatched_tool_calls", "unmatched_tool_observations"} & set(flags_)
    return ("quarantine" if bad else "review_required" if soft else "candidate"), flags_


def log_mode(lines: Iterable[dict]) -> str:
    """Whether a log of two generations holds native items or legacy events."""
    kinds = {sub(e, "payload").get("type") for e in lines if e.get("type") in ("response_item", "event_msg")}
    return "native" if kinds & {"message", "function_call", "function_call_output"} else "legacy"


def turn_islands(lines: DataFrame, session: str, place: str, role: Column, body: Column, calls: Column) -> DataFrame:
    """Neighbouring assistant lines are one turn: a running sum of starts numbers the islands.

    Calls join the assistant turn they follow; outputs and user lines stand alone.
    """
    w = Window.partitionBy(session).orderBy(place)
    r = lines.withColumn("role", role).withColumn("body", body).withColumn("calls", calls).filter("role is not null")
    starts = (F.col("role") != "assistant") | F.lag("role").over(w).isNull() | (F.lag("role").over(w) != "assistant")
    numbered = r.withColumn("turn", F.sum(starts.cast("int")).over(w))
    entry = F.struct(F.col(place), "body", "calls")
    got = numbered.groupBy(session, "turn").agg(F.first("role").alias("role"), F.array_sort(F.collect_list(entry)).alias("c"))
    texts = F.filter(F.transform("c", lambda x: x["body"]), lambda t: F.length(t) > 0)
    return got.select(session, "turn", "role", F.array_join(texts, "\n").alias("text"), F.flatten(F.transform("c", lambda x: F.coalesce(x["calls"], F.array().cast("array<string>")))).alias("calls"))
