"""Release: decisions, reviews, lanes and splits, selections under caps, bindings, constraints and totals.

Everything is declared over flat ledgers; a constraint is a table of violations
that is empty where it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.identity import digest

#: What a review has to look at, and what it may find.
DIMENSIONS = (
    "structural", "tool_integrity", "tool_correctness", "observation_grounding", "privacy", "reasoning_exclusion", "provenance", "task_quality", "human_review",
    "contamination", "deduplication",
)
PARTITIONS = ("candidate", "review_required", "quarantine")


def present(*items: Column) -> Column:
    """Array of the items that are not null, in order."""
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def base_partition(label: Column, gate: Column) -> tuple[Column, Column]:
    """Partition of a row by its gate alone, and the reason for it."""
    rejected, open_ = label == "rejected", gate.isin("unassessed", "unspecified", "quarantine")
    part = F.when(rejected, "quarantine").when(gate.isin("candidate", "review_required"), gate).otherwise("quarantine")
    why = F.when(rejected, "source_rejected").when(gate == "candidate", None).when(gate == "review_required", "source_quality_review_required").when(
        open_, F.concat(F.lit("source_quality_"), gate)
    ).otherwise("source_quality_unknown")
    return part, why


def privacy_reasons(f: Column) -> Column:
    """Reason codes of a struct of finding counts."""
    return present(
        F.when(f["hidden_keys"] > 0, F.lit("hidden_trainer_key")), F.when(f["raw_keys"] > 0, F.lit("raw_or_debug_field")),
        F.when((f["secret_keys"] > 0) | (f["secret_values"] > 0), F.lit("secret_indicator")), F.when(f["private_values"] > 0, F.lit("private_value_indicator")),
    )


def window_reasons(there: Column, match: Column, episode: Column) -> Column:
    """Why an action window is no candidate."""
    return present(
        F.when(~F.coalesce(there, F.lit(False)), F.lit("tool_observation_missing")), F.when(~F.coalesce(match == "call-id", F.lit(False)), F.lit("tool_observation_unmatched")),
        F.when(~F.coalesce(episode == "accepted", F.lit(False)), F.lit("source_episode_not_accepted")),
    )


def rl_reasons(ready: Column, status: Column) -> Column:
    """Why a prompt is not ready for rewards."""
    return present(F.when(~F.coalesce(ready, F.lit(False)), F.lit("rl_not_ready")), F.when(~F.coalesce(status == "scored", F.lit(False)), F.lit("rl_reward_unscored")))


def privacy_eligible(mode: Column, approved: Column) -> tuple[Column, Column]:
    """Whether rows of a privacy mode may train, and why."""
    known = mode.isin("heuristic", "filtered", "none")
    fail = F.raise_error(F.concat(F.lit("unsupported privacy mode: "), F.coalesce(mode, F.lit("null"))))
    ok = F.when(known, (mode != "none") & approved).otherwise(fail.cast("boolean"))
    return ok, F.when(mode == "none", "unfiltered").when(approved, "user-approved-after-filter").otherwise("review-required")


def decide(rows: DataFrame, tiers: list[str], cap: int, order: list[str]) -> DataFrame:
    """``partition_`` and ordered ``reasons`` of each row.

    Takes ``label, gate, findings`` (counts), ``markers, gaps`` (array), ``tier,
    edges_ok, has_actions, wants_actions, window`` and ``rl`` (reason arrays),
    ``prompt_group``.  Privacy and lineage force quarantine; markers, tiers, tool
    edges, windows, rewards and the cap on a prompt group demote candidates.
    """
    first, why = base_partition(F.col("label"), F.col("gate"))
    nth = F.row_number().over(Window.partitionBy("prompt_group").orderBy(*order))
    over = F.col("prompt_group").isNotNull() & (nth > cap)
    private = privacy_reasons(F.col("findings"))
    lineage = F.transform("gaps", lambda g: F.concat(F.lit("lineage_"), F.regexp_replace(g, "_missing$", "")))
    with_edges = F.col("label").isin("sft", "trajectories", "tool_traces")
    edges = present(
        F.when(with_edges & ~F.col("has_actions") & (F.col("label") == "tool_traces") & F.col("wants_actions"), F.lit("tool_trace_without_actions")),
        F.when(with_edges & F.col("has_actions") & ~F.col("edges_ok"), F.lit("tool_edges_incomplete")),
    )
    soft = F.concat(
        present(F.when(~F.col("tier").isin(*tiers), F.lit("model_tier_not_selected"))) if tiers else F.array().cast("array<string>"), edges,
        F.when(F.col("label") == "action_windows", F.col("window")).otherwise(F.array().cast("array<string>")),
        F.when(F.col("label") == "rl_prompts", F.col("rl")).otherwise(F.array().cast("array<string>")),
        present(F.when(over & (F.col("label") == "rl_prompts"), F.lit("duplicate_prompt_group_cap"))),
    )
    marked = present(F.when(F.col("markers") > 0, F.lit("visible_reasoning_marker")))
    made = rows.withColumn("__hard", F.concat(private, lineage)).withColumn("__soft", F.concat(marked, soft)).withColumn("__marked", marked)
    part = F.when(F.size("__hard") > 0, "quarantine").when((first == "candidate") & (F.size("__soft") > 0), "review_required").otherwise(first)
    reasons = F.array_distinct(F.concat(present(why), private, marked, lineage, soft))
    return made.withColumn("partition_", part).withColumn("reasons", reasons).drop("__hard", "__soft", "__marked")


def decision_counts(decisions: DataFrame) -> DataFrame:
    """Rows by partition, and by partition and reason (reason null: all)."""
    each = decisions.select("partition_", F.explode(F.concat(F.array(F.lit(None).cast("string")), "reasons")).alias("reason"))
    return each.groupBy("partition_", "reason").agg(F.count("*").alias("rows"))


def session_gate(flags: Column, messages: Column, broken: Column, explicit: Column) -> Column:
    """Gate of a session by its flags; explicit gates can only worsen it."""
    from sessionweave.operators.gates import GATES, gate_rank
    from sessionweave.operators.records import BLOCKING

    blocking = F.arrays_overlap(flags, F.array(*(F.lit(b) for b in sorted(BLOCKING))))
    auto = F.when((messages == 0) | broken, "quarantine").when(blocking, "review_required").otherwise("candidate")
    told = F.when(F.size(explicit) > 1, F.lit(1)).when(F.size(explicit) == 1, gate_rank(F.get(explicit, F.lit(0)))).otherwise(F.lit(0))
    return F.get(F.array(*(F.lit(g) for g in GATES)), F.greatest(gate_rank(auto), told))


def lookup(rows: DataFrame, id: str, keys: list[Column], overrides: DataFrame, value: str) -> DataFrame:
    """``(id, value)``: the override of the first of a row's keys that has one; ``overrides`` holds ``key`` and the value."""
    asked = rows.select(id, F.posexplode(F.array(*(k.cast("string") for k in keys))).alias("__p", "__k")).filter("__k is not null and __k <> ''")
    bare = F.regexp_replace("key", "^sha256:", "")
    known = overrides.select(F.explode(F.array_distinct(F.array("key", bare))).alias("__k"), value).dropDuplicates(["__k"])
    return asked.join(known, "__k").groupBy(id).agg(F.min_by(value, "__p").alias(value))


# Reviews.


def review_violations(units: DataFrame, revision: str) -> DataFrame:
    """``(unit_id, reason)`` of a review manifest: ids unique, one revision, known decisions, all dimensions passed, evidence that cites the unit."""
    same = Window.partitionBy
    n = lambda c: F.count("*").over(same(c))
    found = F.map_keys("dimensions")
    bad_value = F.exists(F.map_values("dimensions"), lambda v: ~v.isin("pass", "not_applicable"))
    lacking = F.size(F.array_except(F.array(*(F.lit(d) for d in DIMENSIONS)), found)) > 0
    checks = {
        "unit_id_duplicated": n("unit_id") > 1, "review_id_duplicated": n("review_id") > 1, "revision_mismatch": ~F.col("revision").eqNullSafe(F.lit(revision)),
        "decision_unknown": ~F.coalesce(F.col("decision").isin("accept", "reject", "defer"), F.lit(False)), "dimension_missing": lacking,
        "dimension_failed": (F.col("decision") == "accept") & bad_value, "evidence_without_unit": ~F.coalesce(F.contains("evidence", F.col("unit_id")), F.lit(False)),
    }
    marked = units.withColumn("__r", present(*(F.when(c, F.lit(name)) for name, c in checks.items())))
    return marked.select("unit_id", F.explode("__r").alias("reason"))


def inspected(accepted: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Accepted units by how often a pilot holds them: ``missing``, ``duplicate`` or ``ok``; and units nobody accepted."""
    n = seen.groupBy(key).agg(F.count("*").alias("times"))
    both = accepted.select(key, F.lit(True).alias("accepted")).join(n, key, "full_outer")
    status = F.when(F.col("accepted").isNull(), "not_accepted").when(F.col("times").isNull(), "missing").when(F.col("times") > 1, "duplicate").otherwise("ok")
    return both.select(key, F.coalesce("times", F.lit(0)).alias("times"), status.alias("status"))


def lineage_join(examples: DataFrame, lineage: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Examples with their lineage, one to one, and the ids for which it is not."""
    e, s = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((examples, "e"), (lineage, "l")))
    both = e.join(s, key, "full_outer")
    bad = both.filter("not (e <=> 1 and l <=> 1)").select(
        key, F.when(F.col("l").isNull(), "lineage_missing").when(F.col("e").isNull(), "example_missing").otherwise("not_one_to_one").alias("reason")
    )
    return examples.join(lineage, key).join(bad, key, "left_anti"), bad


def same_identity(captures: DataFrame, fields: list[str]) -> DataFrame:
    """Identity fields on which captures of one batch do not agree."""
    sums = captures.agg(*(F.count_distinct(F.col(f)).alias(f) for f in fields))
    each = sums.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("values")) for f in fields))).alias("x"))
    return each.select("x.*").filter("values <> 1")


# Unions.


def union_lanes(parts: dict[str, DataFrame], lane: str = "lane") -> DataFrame:
    """Rows of all parts by column name, each with the name of its part."""
    return reduce(DataFrame.unionByName, (df.withColumn(lane, F.lit(name)) for name, df in parts.items()))


def union_violations(union: DataFrame, id: str, parent: str, split: str, unique: tuple[str, ...] = ()) -> DataFrame:
    """``(reason, value)``: ids (and other unique columns) that repeat, parents in several splits."""
    out = [
        union.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(f"{c}_duplicated").alias("reason"), "value")
        for c in (id, *unique)
    ]
    apart = union.groupBy(F.col(parent).cast("string").alias("value")).agg(F.min(split).alias("a"), F.max(split).alias("b")).filter("a <> b")
    return reduce(DataFrame.unionByName, [*out, apart.select(F.lit("parent_in_two_splits").alias("reason"), "value")])


def contamination(rows: DataFrame, id: str, sources: list[tuple[str, Column, DataFrame]]) -> DataFrame:
    """Rows with the first of several exclusion sets that holds their key (``reason`` null: none does).

    Each set is a one-column table; it is joined on that column, and Spark
    broadcasts it below its threshold.
    """
    out = rows
    for k, (_, key, keys) in enumerate(sources):
        known = keys.select(F.col(keys.columns[0]).alias(f"__e{k}")).distinct().withColumn(f"__h{k}", F.lit(True))
        out = out.join(known, key == F.col(f"__e{k}"), "left").drop(f"__e{k}")
    reason = F.coalesce(*(F.when(F.col(f"__h{k}"), F.lit(name)) for k, (name, _, _) in enumerate(sources)))
    return out.withColumn("reason", reason).drop(*(f"__h{k}" for k in range(len(sources))))


# Selections.


def ranked(rows: DataFrame, by: list[str], order: list, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def one_per_parent(rows: DataFrame, parent: str, order: list) -> tuple[DataFrame, DataFrame]:
    """The first row of each parent, and the ledger of the others."""
    r = ranked(rows, [parent], order, "__r")
    return r.filter("__r = 1").drop("__r"), r.filter("__r > 1").drop("__r").withColumn("reason", F.lit("duplicate_parent_selection"))


def diverse(rows: DataFrame, parent: str, tool: str, id: str) -> DataFrame:
    """Place of each row in its parent when tools take turns: by round, then by tool."""
    turn = ranked(rows, [parent, tool], [id], "__turn")
    return ranked(turn, [parent], ["__turn", tool], "place").drop("__turn")


def round_robin(rows: DataFrame, split: str, parent: str, tool: str, id: str, parent_caps: dict[str, int], total_caps: dict[str, int]) -> DataFrame:
    """Rows picked by split: parents in turn, each in tool-diverse order, under both caps."""
    cap = lambda caps: F.coalesce(*(F.when(F.col(split) == k, F.lit(v)) for k, v in caps.items()), F.lit(0))
    few = diverse(rows, parent, tool, id).filter(F.col("place") <= cap(parent_caps))
    return ranked(few, [split], ["place", parent], "picked").filter(F.col("picked") <= cap(total_caps))


def family_caps(rows: DataFrame, split: str, family: str, parent: str, id: str, caps: dict[tuple[str, str], int]) -> DataFrame:
    """One row a parent and split, then the first of each split and family up to its cap."""
    cap = F.coalesce(*(F.when((F.col(split) == s) & (F.col(family) == f), F.lit(n)) for (s, f), n in caps.items()), F.lit(0))
    first = ranked(rows, [split, parent], [id], "__p").filter("__p = 1").drop("__p")
    return ranked(first, [split, family], [id], "picked").filter(F.col("picked") <= cap)


def enough(rows: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first ``k`` rows of every category; fails where a category has fewer."""
    n = F.count("*").over(Window.partitionBy(by))
    checked = rows.withColumn("__n", F.when(n < k, F.raise_error(F.concat(F.lit("too few rows of "), F.col(by).cast("string"))).cast("long")).otherwise(n))
    return ranked(checked, [by], order).filter((F.col("rank") <= k) & (F.col("__n") >= k)).drop("__n")


def longest(rows: DataFrame, *order: str) -> DataFrame:
    """The row that is the largest in every column of the order."""
    return rows.agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")


def cycle_picks(candidates: list[tuple], caps: dict[tuple[str, int], int], used: set) -> list[tuple]:
    """Greedy choice over compact refs ``(split, distance, pair, parent, state)``: longest distance first, parents and states once; at most the sum of caps are picked."""
    picks, parents = [], set()
    left = dict(caps)
    for split, distance, pair, parent, state in sorted(candidates, key=lambda c: (c[0] != "train", -c[1], c[2])):
        if left.get((split, distance), 0) > 0 and (split, parent) not in parents and state not in used:
            left[(split, distance)] -= 1
            parents.add((split, parent)), used.add(state)
            picks.append((split, distance, pair))
    return picks


def within_tokens(rows: DataFrame, tokens: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to a token bound, whole, and the ledger of those beyond it."""
    counted = rows.withColumn("tokens", tokens)
    return counted.filter(F.col("tokens") <= most), counted.filter(F.col("tokens") > most).withColumn("reason", F.lit("sequence_exceeds_bound"))


def token_totals(rows: DataFrame, by: list[str], tokens: str) -> DataFrame:
    """Rows, least, nearest-rank median and 95th percentile, and most tokens."""
    exact = lambda p: F.expr(f"percentile_disc({p}) within group (order by {tokens})").cast("long")
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.min(tokens).alias("least"), exact(0.5).alias("p50"), exact(0.95).alias("p95"), F.max(tokens).alias("most"))


def index_percentiles(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Values at the places ``n // 2`` and ``0.95 n`` of each group in order (from 0)."""
    w = Window.partitionBy(by)
    placed = rows.select(by, value).withColumn("__k", F.row_number().over(w.orderBy(value)) - 1).withColumn("__n", F.count("*").over(w))
    at = lambda k: F.max(F.when(F.col("__k") == k, F.col(value)))
    return placed.groupBy(by).agg(at(F.floor(F.col("__n") / 2)).alias("p50"), at(F.least(F.col("__n") - 1, F.floor(F.col("__n") * 0.95))).alias("p95"))


# Constraints.


def share_violations(rows: DataFrame, split: str, source: str, num: int, den: int) -> DataFrame:
    """Sources with more than ``num / den`` of a split's rows."""
    per = rows.groupBy(split, source).agg(F.count("*").alias("n"))
    return per.withColumn("of", F.sum("n").over(Window.partitionBy(split))).filter(F.col("n") * den > F.col("of") * num)


def missing_families(rows: DataFrame, split: str, family: str, required: list[str], at_least: int = 1) -> DataFrame:
    """Required families that a split has fewer rows of than it must."""
    wanted = rows.select(split).distinct().withColumn(family, F.explode(F.array(*(F.lit(f) for f in required))))
    n = rows.groupBy(split, family).agg(F.count("*").alias("n"))
    return wanted.join(n, [split, family], "left").withColumn("n", F.coalesce("n", F.lit(0))).filter(F.col("n") < at_least)


# Sources and coverage.


def evidence(found: DataFrame) -> DataFrame:
    """Per digest: how often it was found, and by which kinds, providers and classes."""
    some = lambda c: F.array_sort(F.collect_set(c)).alias(f"{c}s")
    return found.groupBy("sha").agg(F.count("*").alias("times"), some("kind"), some("provider"), some("class"))


def covered(inventory: DataFrame, found: DataFrame) -> DataFrame:
    """Inventory rows with how strongly evidence covers them: digest and provider, digest alone, or not at all."""
    e = evidence(found).select("sha", "providers")
    both = inventory.join(e, "sha", "left")
    level = F.when(F.array_contains("providers", F.col("provider")), "strong").when(F.col("providers").isNotNull(), "weak").otherwise("none")
    return both.withColumn("match", level).drop("providers")


def bound_to(artifacts: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Artifacts with whether another ledger binds them by name and digest, and why not."""
    by_name = others.groupBy(keys[0]).agg(F.count("*").alias("__n"))
    exact = others.select(*keys).distinct().withColumn("__x", F.lit(True))
    both = artifacts.join(exact, keys, "left").join(by_name, keys[0], "left")
    status = F.when(F.col("__x"), "bound").when(F.col("__n") > 0, "digest_changed").otherwise("absent")
    return both.withColumn("binding", status).drop("__x", "__n")


def snapshot_refs(keys: DataFrame, snapshot: DataFrame, inventory: DataFrame, on: list[str]) -> DataFrame:
    """How each key stands between a snapshot and an inventory."""
    s = snapshot.select(*on, F.col("status").alias("s_status"), F.col("sha").alias("s_sha"))
    i = inventory.select(*on, F.col("sha").alias("i_sha"))
    both = keys.join(s, on, "left").join(i, on, "left")
    ref = (
        F.when(F.col("s_status").isNull(), "snapshot_absent").when(F.col("s_status") != "stable", F.concat(F.lit("snapshot_"), "s_status"))
        .when(F.col("i_sha").isNull(), "inventory_absent").when(F.col("i_sha") != F.col("s_sha"), "digest_drift").otherwise("bound")
    )
    return both.select(*on, ref.alias("ref"))


def admitted(asked: DataFrame, ledger: DataFrame, on: list[str]) -> DataFrame:
    """Asked identities by how many ledger rows they have: one admits, none or several do not."""
    n = ledger.groupBy(*on).agg(F.count("*").alias("__n"))
    status = F.when(F.col("__n") == 1, "admitted").when(F.col("__n") > 1, "ambiguous").otherwise("unknown_source")
    return asked.join(n, on, "left").withColumn("admission", status).drop("__n")


def accounting(rows: DataFrame) -> DataFrame:
    """Input, skipped, normalized and rejected records of a build, and what they leave unexplained."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    sums = rows.agg(F.count("*").alias("input"), n("skipped"), n("normalized"), n("rejected"))
    return sums.withColumn("gap", F.col("input") - F.col("skipped") - F.col("normalized") - F.col("rejected"))


def counters(rows: DataFrame, families: list[str]) -> DataFrame:
    """Counts by key of several families of counters in one pass: ``(family, key, n)``."""
    each = rows.select(F.explode(F.array(*(F.struct(F.lit(f).alias("family"), F.col(f).cast("string").alias("key")) for f in families))).alias("x"))
    return each.select("x.*").groupBy("family", "key").agg(F.count("*").alias("n"))


def projection_dedup(rows: DataFrame, key: Column, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first row of each projection digest, and the ledger of repeats."""
    r = rows.withColumn("__k", digest(key)).withColumn("__r", F.row_number().over(Window.partitionBy("__k").orderBy(*order)))
    return r.filter("__r = 1").drop("__k", "__r"), r.filter("__r > 1").drop("__k", "__r").withColumn("reason", F.lit("duplicate_prompt_completion"))
