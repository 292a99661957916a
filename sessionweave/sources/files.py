"""Files as tables: discovery, positional re-reads, scans bound to manifests, ledgers of what lies where."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionweave.functions.text import prefix_fields

#: A file's class and treatment by provider, and by words of its path; the first rule that fits decides.
SUPPORT = ("support_state", "excluded")
CLASSES = {
    "codex": (
        (r"(?:^|/)rollout-[^/]*\.jsonl\.backup$", "session_backup", "candidate"), (r"(?:^|/)rollout-[^/]*\.jsonl$", "session_active", "candidate"),
        (r"/\.backups/|\.backup$", "backup_state", "review"), (r"^sessions/", "session_auxiliary", "review"), (r"(?:^|/)attachments/", "attachment", "review"),
        (r"(?:^|/)packages/", "binary_or_package", "excluded"),
        (r"(?:^|/)(?:cache|tmp|plugins|memories|skills|rules|shell_snapshots|log|policy|mcp-oauth-locks|thread-writer-locks)/", *SUPPORT),
    ),
    "claude": (
        (r"(?:^|/)(?:projects|sessions)/(?:.*/)?agent-[^/]*\.jsonl$", "subagent_session", "candidate"), (r"(?:^|/)(?:projects|sessions)/.*\.jsonl$", "session_active", "candidate"),
        (r"/(?:backups|cache|logs|debug)/", *SUPPORT),
    ),
    "gemini": ((r"(?:^|/)tmp/(?:.*/)?chats/.*\.jsonl?$", "session_active", "candidate"), (r"(?:^|/)history/", "support_state", "review")),
    "continue": ((r"(?:^|/)sessions/.*\.jsonl?$", "session_active", "candidate"), (r"/(?:cache|logs)/", *SUPPORT)),
    "opencode": (
        (r"^opencode\.db$|(?:^|/)storage/(?:message|part)/", "conversation_store", "candidate"), (r"(?:^|/)storage/session(?:_diff)?/", "conversation_sidecar", "candidate"),
        (r"(?:^|/)tool-output/", "tool_output", "candidate"), (r"(?:^|/)snapshot/", "workspace_snapshot", "review"),
        (r"(?:^|/)(?:bin|node_modules)/", "binary_or_package", "excluded"), (r"(?:^|/)log/", *SUPPORT),
    ),
    "prime-agent": (
        (r"^agent/sessions/.*\.jsonl$", "session_active", "candidate"), (r"^agent/session-artifacts/.*\.jsonl$", "subagent_session", "candidate"),
        (r"(?:^|/)agent/(?:logs|command-journal|recovery|harness|extensions)/", "harness_state", "review"), (r"\.(?:dill|db|sqlite3?)$", "agent_state", "review"),
    ),
    "oh-my-pi": (
        (r"(?:^|/)agent/sessions/(?:.*/)?__advisor\.jsonl$", "advisor_overlay", "candidate"), (r"\.omp-backups/.*(?:^|/)agent/sessions/.*\.jsonl$", "session_backup", "candidate"),
        (r"(?:^|/)agent/sessions/.*\.jsonl$", "session_active", "candidate"), (r"(?:^|/)agent/.*\.(?:db|sqlite3?)$", "agent_database", "review"),
        (r"(?:^|/)(?:logs|natives|webcache|node_modules|extensions)/", *SUPPORT),
    ),
    "cursor": ((r"\.(?:db|vscdb)$|cursordiskkv[^/]*$", "conversation_store", "candidate"),),
    "trae": ((r"\.(?:db|vscdb|jsonl?)$", "conversation_store", "candidate"),),
    "windsurf": ((r"\.(?:db|vscdb|jsonl?)$", "conversation_store", "candidate"),),
}
ANY_PROVIDER = ((r"\.jsonl$", "jsonl_candidate", "review"), (r"\.(?:json|db|sqlite3?)$", "structured_candidate", "review"), (r"\.(?:log|lock|tmp)$", *SUPPORT))


def classify(provider: Column, relative: Column) -> Column:
    """``(class, treatment)`` of a file by provider and relative path alone."""
    low, out = F.lower(relative), None
    told = lambda c, t: F.struct(F.lit(c).alias("class"), F.lit(t).alias("treatment"))
    for name, rules in (*CLASSES.items(), (None, ANY_PROVIDER)):
        for pattern, kind, treatment in rules:
            hit = low.rlike(pattern) if name is None else (provider == name) & low.rlike(pattern)
            out = F.when(hit, told(kind, treatment)) if out is None else out.when(hit, told(kind, treatment))
    return out.otherwise(told("unknown", "review"))


def discover(spark: SparkSession, paths: list[str], glob: str = "*.jsonl", excluded: str | None = None) -> list[str]:
    """Files below the paths whose names fit, sorted, each once; an error if there are none.

    Names come through Spark's own listing, so any store will do; ``excluded`` is a folder.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths).select("path")
    if excluded is not None:
        listed = listed.filter(~F.contains("path", F.lit(excluded.rstrip("/") + "/")))
    out = sorted(r.path for r in listed.distinct().collect())  # names alone
    if not out:
        raise FileNotFoundError(f"no file {glob} below {', '.join(paths)}")
    return out


def discover_with_backups(spark: SparkSession, paths: list[str], excluded: str | None = None) -> list[str]:
    """Line files and their backups."""
    return discover(spark, paths, "*.{jsonl,jsonl.backup}", excluded)


def inventory(spark: SparkSession, root: str, provider: str, label: str, digests: bool = True) -> DataFrame:
    """A row a file below a root: relative path and its digest, size, class, treatment; content digests of candidates alone."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    cut = F.regexp_replace(F.col("path"), "^[a-z]+:/+", "/")
    base = F.lit("/" + root.split(":", 1)[-1].strip("/") + "/")
    rows = found.select(
        F.lit(provider).alias("provider"), F.lit(label).alias("root_label"), F.replace(cut, base, F.lit("")).alias("relative"),
        "length", "modificationTime", "content",
    ).withColumn("c", classify(F.lit(provider), F.col("relative")))
    sha = F.when(F.lit(digests) & (F.col("c.treatment") == "candidate"), F.sha2("content", 256))
    return rows.select("provider", "root_label", "relative", F.sha2("relative", 256).alias("path_sha"), "length", "modificationTime", "c.class", "c.treatment", sha.alias("sha"))


def snapshot(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Whether files were stable between two inventories: same size, time and digest."""
    a = before.select(*keys, F.struct("length", "modificationTime", "sha").alias("a"))
    b = after.select(*keys, F.struct("length", "modificationTime", "sha").alias("b"))
    status = F.when(F.col("a").isNull(), "appeared").when(F.col("b").isNull(), "vanished").when(F.col("a").eqNullSafe(F.col("b")), "stable").otherwise("changed_during_scan")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"), F.coalesce("b.sha", "a.sha").alias("sha"))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, value)`` of text files, lines from 1; a file is read whole by one task, as only so its lines have numbers."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    each = whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("k", "value"))
    return each.select("file", (F.col("k") + 1).alias("line"), "value").filter("trim(value) <> ''")


def strict(spark: SparkSession, path: str) -> DataFrame:
    """Every line of JSON line files parsed; the first bad one fails the read and is named by file and line."""
    rows = numbered(spark, path).withColumn("record", F.try_parse_json("value"))
    where = F.concat(F.lit("malformed JSON line at "), "file", F.lit(":"), F.col("line").cast("string"))
    return rows.withColumn("record", F.when(F.col("record").isNull(), F.raise_error(where).cast("variant")).otherwise(F.col("record")))


def first_records(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of each file (a smoke run)."""
    return lines.withColumn("__r", F.row_number().over(Window.partitionBy("file").orderBy("line"))).filter(F.col("__r") <= n).drop("__r")


def parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of Parquet files with ``file`` and ``row``, their place in it."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def by_place(rows: DataFrame, refs: DataFrame, place: list[str]) -> DataFrame:
    """Rows at chosen places; fails if any place is not there.

    The check is part of the plan: places without a row raise where they would
    have been dropped.
    """
    chosen = refs.select(*place).distinct()
    found = chosen.join(rows.withColumn("__found", F.lit(True)), place, "left")
    gone = F.raise_error(F.concat(F.lit("chosen row is gone: "), F.to_json(F.struct(*place)))).cast("boolean")
    return found.withColumn("__found", F.when(F.col("__found").isNull(), gone).otherwise(F.col("__found"))).filter("__found").drop("__found")


def by_id(rows: DataFrame, refs: DataFrame, id: str, line: str) -> DataFrame:
    """Rows of chosen ids, which must still stand on the lines where they were chosen."""
    chosen = refs.select(id, F.col(line).alias("__at"))
    joined = rows.join(chosen, id)
    moved = F.raise_error(F.concat(F.lit("line drift of "), F.col(id).cast("string"))).cast("boolean")
    return joined.withColumn("__ok", F.when(F.col(line) == F.col("__at"), F.lit(True)).otherwise(moved)).filter("__ok").drop("__at", "__ok")


def describe(spark: SparkSession, path: str) -> dict:
    """``records``, ``bytes`` and ``sha256`` of text files: the digest is over the sorted digests of their lines, so it needs no single reader."""
    lines = spark.read.text(path).filter("value <> ''").select(F.sha2("value", 256).alias("h"), F.octet_length("value").alias("n"))
    out = lines.agg(F.count("*").alias("records"), F.coalesce(F.sum(F.col("n") + 1), F.lit(0)).alias("bytes"), F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).alias("sum")).first()
    mixed = spark.range(1).select(F.sha2(F.lit(f"{out.records}:{out.bytes}:{out['sum']}"), 256)).first()[0]
    return {"records": out.records, "bytes": out.bytes, "sha256": mixed}


def bound(spark: SparkSession, folder: str, manifest: dict, name: str) -> DataFrame:
    """Records of a file of a release, after its description is found as the manifest tells."""
    told, real = manifest["outputs"][name], describe(spark, f"{folder}/{name}")
    for k in ("records", "bytes", "sha256"):
        if told[k] != real[k]:
            raise ValueError(f"{name}: {k} is {real[k]}, the manifest tells {told[k]}")
    return spark.read.text(f"{folder}/{name}").filter("value <> ''").select(F.parse_json("value").alias("record"))


def release(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "validation")) -> DataFrame:
    """``(split, record)`` of a release, every split file bound to the manifest beside it."""
    manifest = json.loads(spark.read.text(f"{folder}/manifest.json", wholetext=True).first()[0])
    out = None
    for s in splits:
        part = bound(spark, folder, manifest, f"{s}.jsonl").select(F.lit(s).alias("split"), "record")
        out = part if out is None else out.unionByName(part)
    return out


def bound_sources(specs: list[dict], spark: SparkSession) -> DataFrame:
    """Sources of an input spec ``{id, path, records, bytes, sha256}``: each checked, then read together."""
    out = None
    for s in specs:
        folder, _, name = s["path"].rpartition("/")
        part = bound(spark, folder, {"outputs": {name: s}}, name).select(F.lit(s["id"]).alias("source"), "record")
        out = part if out is None else out.unionByName(part)
    return out


def evidence(lines: DataFrame, limit: int) -> DataFrame:
    """Source digests that lines tell of; of lines over the limit only their first characters are read."""
    small, fields = F.length("value") <= limit, prefix_fields(F.left("value", F.lit(limit)))
    get = lambda k: F.when(small, F.get_json_object("value", f"$.{k}")).otherwise(F.try_element_at(fields, F.lit(k)))
    nested = lambda k: F.when(small, F.get_json_object("value", f"$.source_origin.{k}"))
    sha = F.coalesce(*(f(k) for k in ("source_file_sha256", "source_sha256") for f in (nested, get)))
    return lines.select("*", F.regexp_replace(F.lower(sha), "^sha256:", "").alias("sha"), get("source").alias("provider"), (~small).alias("oversize"))


def overrides(rows: DataFrame, order: str, allowed: Column, value: str) -> DataFrame:
    """Decisions by key (file digest, with or without its prefix, or session id); the last one of a key counts, others than allowed fail."""
    bad = F.raise_error(F.concat(F.lit("override is not allowed: "), F.coalesce(F.col(value), F.lit("null")))).cast("string")
    checked = rows.withColumn(value, F.when(allowed, F.col(value)).otherwise(bad))
    bare = lambda c: F.regexp_replace(c, "^sha256:", "")
    keys = F.filter(F.array(F.col("source_file_sha256"), bare(F.col("source_file_sha256")), F.col("source_sha256"), bare(F.col("source_sha256")), F.col("session_id")), lambda k: k.isNotNull() & (k != ""))
    lost = F.raise_error(F.lit("override without a source digest or a session")).cast("array<string>")
    each = checked.select(order, value, F.explode(F.array_distinct(F.when(F.size(keys) > 0, keys).otherwise(lost))).alias("key"))
    return each.groupBy("key").agg(F.max_by(value, order).alias(value))


def exclusions(benchmark: DataFrame, cases: DataFrame) -> dict[str, DataFrame]:
    """Repositories, instances and prompt digests that training must not see."""
    return {
        "repository": benchmark.select(F.lower(F.trim("repository")).alias("key")).filter("key <> ''").distinct(), "instance": benchmark.select(F.col("instance_id").alias("key")).filter("key is not null").distinct(),
        "first_user": cases.select(F.sha2(F.trim("prompt"), 256).alias("key")).filter("key is not null").distinct(),
    }


def evaluation_prompts(cases: DataFrame) -> DataFrame:
    """Distinct trimmed prompts; one that is missing or empty fails."""
    fail = F.raise_error(F.lit("evaluation case without a prompt")).cast("string")
    return cases.select(F.when(F.length(F.trim("prompt")) > 0, F.trim("prompt")).otherwise(fail).alias("prompt")).distinct()
