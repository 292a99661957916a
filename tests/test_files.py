"""Files, releases, ledgers, sinks and segments."""

import json

import pytest
from pyspark.sql import functions as F

from sessionweave.operators import segments
from sessionweave.sources import files, sinks


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return f"file://{path}"


def test_discovery_and_places(spark, tmp_path):
    put(tmp_path / "in/b.jsonl", {"a": 1}, "", {"a": 2}), put(tmp_path / "in/x/a.jsonl", {"a": 3}), put(tmp_path / "in/c.jsonl.backup", "{}"), put(tmp_path / "in/out/z.jsonl", "{}")
    root = f"file://{tmp_path}/in"
    names = [p.rsplit("/", 1)[1] for p in files.discover(spark, [root], excluded=f"{tmp_path}/in/out")]
    assert names == ["b.jsonl", "a.jsonl"] and len(files.discover_with_backups(spark, [root])) == 4
    with pytest.raises(FileNotFoundError):
        files.discover(spark, [root], "*.none")
    lines = files.numbered(spark, f"{root}/b.jsonl")
    assert [(r.line, r.value) for r in lines.orderBy("line").collect()] == [(1, '{"a": 1}'), (3, '{"a": 2}')]
    assert files.first_records(lines, 1).count() == 1 and files.strict(spark, f"{root}/b.jsonl").count() == 2
    bad = put(tmp_path / "bad.jsonl", "{}", "{oops")
    with pytest.raises(Exception, match="bad.jsonl:2"):
        files.strict(spark, bad).collect()
    spark.range(10).coalesce(1).write.parquet(f"file://{tmp_path}/p")
    rows = files.parquet_rows(spark, f"file://{tmp_path}/p")
    refs = rows.filter("row in (2, 5)").select("file", "row")
    assert sorted(r.id for r in files.by_place(rows, refs, ["file", "row"]).collect()) == [2, 5]
    with pytest.raises(Exception, match="chosen row is gone"):
        files.by_place(rows.filter("row < 5"), refs, ["file", "row"]).collect()
    at = spark.createDataFrame([("x", 3), ("y", 4)], "id string, line int")
    assert files.by_id(at, at.limit(1), "id", "line").count() == 1
    with pytest.raises(Exception, match="line drift"):
        files.by_id(at, at.withColumn("line", F.col("line") + 1), "id", "line").collect()


def test_classes(spark):
    cases = {
        ("codex", "sessions/2024/rollout-1.jsonl"): ("session_active", "candidate"), ("codex", "rollout-1.jsonl.backup"): ("session_backup", "candidate"),
        ("codex", "x/packages/a"): ("binary_or_package", "excluded"), ("codex", "cache/a"): ("support_state", "excluded"), ("claude", "projects/p/agent-1.jsonl"): ("subagent_session", "candidate"),
        ("claude", "projects/p/1.jsonl"): ("session_active", "candidate"), ("gemini", "tmp/h/chats/a.json"): ("session_active", "candidate"), ("opencode", "opencode.db"): ("conversation_store", "candidate"),
        ("opencode", "storage/session_diff/a.json"): ("conversation_sidecar", "candidate"), ("prime-agent", "agent/sessions/a.jsonl"): ("session_active", "candidate"),
        ("oh-my-pi", "agent/sessions/__advisor.jsonl"): ("advisor_overlay", "candidate"), ("cursor", "State.VSCDB"): ("conversation_store", "candidate"), ("windsurf", "a.json"): ("conversation_store", "candidate"),
        ("none", "a.jsonl"): ("jsonl_candidate", "review"), ("none", "a.lock"): ("support_state", "excluded"), ("none", "a.bin"): ("unknown", "review"),
    }
    df = spark.createDataFrame(list(cases), "p string, f string")
    got = df.select("p", "f", files.classify(F.col("p"), F.col("f")).alias("c")).collect()
    assert {(r.p, r.f): tuple(r.c) for r in got} == cases


def test_inventories(spark, tmp_path):
    put(tmp_path / "r/sessions/rollout-1.jsonl", "{}"), put(tmp_path / "r/cache/x", "y")
    one = files.inventory(spark, f"file://{tmp_path}/r", "codex", "home")
    got = {r.relative: r for r in one.collect()}
    assert set(got) == {"sessions/rollout-1.jsonl", "cache/x"} and got["cache/x"].sha is None and len(got["sessions/rollout-1.jsonl"].sha) == 64
    before = spark.createDataFrame(one.collect(), one.schema)
    put(tmp_path / "r/sessions/rollout-1.jsonl", "{}", "{}"), put(tmp_path / "r/cache/new", "y")
    status = {r.relative: r.status for r in files.snapshot(before, files.inventory(spark, f"file://{tmp_path}/r", "codex", "home"), ["relative"]).collect()}
    assert status == {"sessions/rollout-1.jsonl": "changed_during_scan", "cache/x": "stable", "cache/new": "appeared"}


def test_releases_are_bound(spark, tmp_path):
    folder = f"file://{tmp_path}/rel"
    rows = spark.createDataFrame([(k, "train" if k % 5 else "validation", "é") for k in range(20)], "id int, split string, z string").repartition(3)
    parts = {s: rows.filter(F.col("split") == s) for s in ("train", "validation")}
    content = sinks.release(parts, folder, ["split", "id"], policy="v1")
    assert content["outputs"]["train.jsonl"]["records"] == 16
    got = files.release(spark, folder)
    assert got.groupBy("split").count().count() == 2 and got.count() == 20
    ids = [json.loads(r.value)["id"] for r in spark.read.text(f"{folder}/train.jsonl").collect()]
    assert sorted(ids) == [k for k in range(20) if k % 5]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.json_lines(rows, f"{folder}/train.jsonl")
    with pytest.raises(FileExistsError):
        sinks.manifest(spark, f"{folder}/manifest.json", {})
    sinks.json_lines(rows.limit(3), f"{folder}/train.jsonl", overwrite=True)
    with pytest.raises(ValueError, match="the manifest tells"):
        files.release(spark, folder)
    spec = [{"id": "s1", "path": f"{folder}/validation.jsonl"} | content["outputs"]["validation.jsonl"]]
    assert {r.source for r in files.bound_sources(spec, spark).collect()} == {"s1"}


def test_line_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("u1", "candidate", '{"b": 1,  "a": "x@y.org"}'), ("u2", "quarantine", '{"c": [{"thinking": 1}]}')], "unit string, part string, value string")
    sinks.raw_lines(lines, f"file://{tmp_path}/by", ["part"])
    assert spark.read.text(f"file://{tmp_path}/by/part=candidate").first()[0] == '{"b": 1,  "a": "x@y.org"}'
    assert sinks.reviewed_lines(lines, lines.filter("unit = 'u2'"), "unit", f"file://{tmp_path}/rev")["records"] == 1
    told = sinks.redacted_lines(lines, f"file://{tmp_path}/red")
    assert told["redactions"] == 1 and told["changed"] == 1
    assert {r.value for r in spark.read.text(f"file://{tmp_path}/red/lines").collect()} == {'{"a":"<PRIVATE_EMAIL>","b":1}', '{"c":[{}]}'}
    states = spark.createDataFrame([("e1", "success"), ("e2", None)], "episode string, ended string")
    events = spark.createDataFrame([("e1", 0)], "episode string, ordinal int")
    with pytest.raises(ValueError, match="e2"):
        sinks.ended_traces(events, states, f"file://{tmp_path}/t")
    assert sinks.ended_traces(events, states.filter("episode = 'e1'"), f"file://{tmp_path}/t")["records"] == 1
    made = sinks.markdown(spark, [{"name": "read-first", "description": "d", "body": "Text"}], f"file://{tmp_path}/skills")
    assert (tmp_path / "skills/read-first/SKILL.md").read_text().startswith("---\nname: read-first") and len(made) == 1
    assert sinks.bundle({"b": b"2", "a": b"1"}) == sinks.bundle({"a": b"1", "b": b"2"})


def test_sources_are_appended_once(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1), ("s2", 2)], "source string, v int")
    root, outputs = f"file://{tmp_path}/m", {"values": ["v"], "doubles": ["d"]}
    rows = df.withColumn("d", F.col("v") * 2)
    sinks.append_sources(rows.filter("source = 's1'"), "source", root, outputs)
    # A run that broke after its first output: no entry in the ledger.
    rows.filter("source = 's2'").select("v", "source").write.mode("append").partitionBy("source").parquet(f"{root}/values")
    for _ in range(2):
        ledger = sinks.append_sources(rows, "source", root, outputs)
    assert sorted(r.source for r in ledger.collect()) == ["s1", "s2"]
    assert sorted(r.v for r in spark.read.parquet(f"{root}/values").collect()) == [1, 2] and spark.read.parquet(f"{root}/doubles").count() == 2


def test_evidence_and_overrides(spark):
    lines = spark.createDataFrame([('{"source": "a", "source_origin": {"source_sha256": "sha256:AB"}}',), ('{"source": "b", "source_sha256": "cd", "x": "' + "y" * 200 + '"}',), ("{bad",)], "value string")
    assert [tuple(r)[1:] for r in files.evidence(lines, 100).collect()] == [("ab", "a", False), ("cd", "b", True), (None, None, False)]
    rows = spark.createDataFrame([(1, "sha256:k", None, None, "candidate"), (2, None, None, "s", "quarantine"), (3, "k", None, None, "review_required")], "n int, source_file_sha256 string, source_sha256 string, session_id string, gate string")
    ok = F.col("gate").isin("candidate", "quarantine", "review_required")
    assert {r.key: r.gate for r in files.overrides(rows, "n", ok, "gate").collect()} == {"sha256:k": "candidate", "k": "review_required", "s": "quarantine"}
    with pytest.raises(Exception, match="not allowed: candidate"):
        files.overrides(rows, "n", F.col("gate") != "candidate", "gate").collect()
    with pytest.raises(Exception, match="without a source digest"):
        files.overrides(rows.withColumn("source_file_sha256", F.lit(None).cast("string")), "n", ok, "gate").collect()
    cases = spark.createDataFrame([(" p ",), ("p",)], "prompt string")
    assert files.evaluation_prompts(cases).count() == 1
    sets = files.exclusions(spark.createDataFrame([("Org/R ", "i1")], "repository string, instance_id string"), cases)
    assert sets["repository"].first().key == "org/r" and sets["first_user"].count() == 1
    with pytest.raises(Exception, match="without a prompt"):
        files.evaluation_prompts(cases.union(spark.createDataFrame([("",)], "prompt string"))).collect()


def say(role, n, **more):
    return {"role": role, "content": "x" * n, **more}


def test_segments():
    pairs = [m for k in range(6) for m in (say("user", 80), say("assistant", 80))]
    record = {"messages": [say("system", 20), *pairs], "diffs": ["d"], "session_id": "s"}
    made = segments.variants(record, 900)
    assert len(made) > 1 and all(v["messages"][0]["role"] == "system" for v in made) and ["diffs" in v for v in made] == [True] + [False] * (len(made) - 1)
    assert all(v["messages"][1]["role"] == "user" for v in made) and {v["_chunk_count"] for v in made} == {len(made)}
    spans = [(v["_chunk_message_start"], v["_chunk_message_end"]) for v in made]
    assert spans[0][0] == 1 and spans[-1][1] == 12 and all(b[0] == a[1] + 1 for a, b in zip(spans, spans[1:]))
    assert segments.variants(record, 10**6) == [record] and segments.variants({"messages": [say("user", 5000)]}, 100)[0]["messages"][0]["role"] == "user"
    calls = [say("user", 50), say("assistant", 10, tool_calls=[{"id": "a"}]), say("assistant", 10, tool_calls=[{"id": "b"}]), say("tool", 200, tool_call_id="b"), say("tool", 200, tool_call_id="a"), say("assistant", 300), say("assistant", 300)]
    cuts = [v["_chunk_message_start"] for v in segments.variants({"messages": calls}, 500)]
    assert cuts[0] == 0 and not {2, 3, 4} & set(cuts)  # never while a call is open
    loop = segments.variants({"messages": calls}, 500)
    assert loop[1]["_chunk_anchor_message_index"] == 0 and loop[1]["messages"][0]["role"] == "user"
    never = [say("user", 50), say("assistant", 10, tool_calls=[{"id": "gone"}]), *pairs]
    assert len(segments.variants({"messages": never}, 900)) == 1 < len(segments.rollout_variants({"messages": never}, 900))
    assert len(segments.store_variants(record, 900)) >= len(made) and len(segments.log_variants(record, 900)) > len(made)


def test_payloads():
    assert [(a, b) for _, a, b in segments.groups(["x" * 10] * 5, 30)] == [(0, 1), (2, 3), (4, 4)]
    text, how = segments.bounded_value("a" * 500 + "z" * 500, 300, segments.WINDOW_MARK)
    assert how == "truncated" and len(text) == 300 and segments.WINDOW_MARK in text and text.endswith("z")
    assert segments.bounded_value({"a": "b" * 500}, 300, "")[1] == "digest_only" and segments.bounded_value([1], 300, "") == ([1], "full")
    assert "sha256=" in segments.bounded_value("q" * 900, 300, segments.OBSERVATION_MARK)[0]
