"""Admission: firewall scans, lineage and tool edges, the decision lattice, review joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.text import PRIVATE_VALUE, SECRET_VALUE, TRAINER_MARKER

#: Gates from best to worst.
GATES = ("candidate", "review_required", "quarantine", "unassessed")


def gate_rank(gate: Column) -> Column:
    """Rank of a gate; unknown gates rank worst."""
    out = None
    for k, g in enumerate(GATES):
        out = F.when(gate == g, k) if out is None else out.when(gate == g, k)
    return out.otherwise(len(GATES) - 1)


def worst_gate(a: Column, b: Column) -> Column:
    """The worse of two gates; a null one does not count."""
    names = F.array(*(F.lit(g) for g in GATES))
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.get(names, F.greatest(gate_rank(a), gate_rank(b))))


def firewall(rows: DataFrame, text: str) -> DataFrame:
    """Add ``findings``: sorted kinds of what must not pass."""
    t = F.coalesce(F.col(text), F.lit(""))
    secret, private = t.rlike(SECRET_VALUE), t.rlike(PRIVATE_VALUE)
    kinds = F.array(F.when(t.rlike(TRAINER_MARKER), F.lit("marker")), F.when(private, F.lit("private_value")), F.when(secret, F.lit("secret_value")))
    return rows.withColumn("findings", F.filter(kinds, lambda k: k.isNotNull()))


def tool_edges(messages: Column) -> Column:
    """Ids of calls without an observation, and of observations without a call, of an array of ``(call_id, result_id)``."""
    ids = lambda f: F.filter(F.transform(messages, lambda m: m[f]), lambda x: x.isNotNull())
    calls, results = ids("call_id"), ids("result_id")
    return F.struct(F.array_except(calls, results).alias("unanswered"), F.array_except(results, calls).alias("unasked"))


def decide(gate: Column, findings: Column, lineage: Column, reasons: Column) -> Column:
    """Partition of a row: privacy and missing lineage force quarantine, markers and other reasons demote a candidate."""
    private = F.arrays_overlap(findings, F.array(F.lit("secret_value"), F.lit("private_value")))
    demoted = F.array_contains(findings, "marker") | (F.size(reasons) > 0)
    return F.when(private | ~lineage, "quarantine").when(demoted & (gate == "candidate"), "review_required").otherwise(gate)


def reviewed(candidates: DataFrame, units: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Accepted candidates, and a ledger of units that match none or several."""
    per = candidates.groupBy(key).agg(F.count("*").alias("matches"))
    checked = units.filter("accepted").join(per, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return candidates.join(checked.filter("matches = 1").select(key), key, "left_semi"), checked.filter("matches <> 1").select(key, "matches")


def conflicting_labels(rows: DataFrame, prompt: str, completion: str, order: list[str]) -> DataFrame:
    """Rows of prompts with one completion only, and of them the first of each prompt.

    Extremes tell whether a prompt has several completions, so a hot prompt is
    one aggregated row a task.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("own")
    per = rows.select(F.col(prompt).alias("p"), F.col(completion).alias("c"), F.struct(*order).alias("o"), own).groupBy("p").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.min_by("own", "o").alias("own")
    )
    return per.filter("low <=> high").select("own.*")


def split_conflicts(rows: DataFrame, parent: str, split: str) -> DataFrame:
    """Parents that stand in more than one split; empty where splits are disjoint."""
    return rows.groupBy(parent).agg(F.min(split).alias("low"), F.max(split).alias("high")).filter("low <> high").select(parent)


def retained_suffix(turns: DataFrame, episode: str, tokens: str, bound: int) -> DataFrame:
    """Newest whole turns of each episode that fit the bound, cut at the first that does not."""
    w = Window.partitionBy(episode).orderBy(F.desc("ordinal")).rowsBetween(Window.unboundedPreceding, 0)
    return turns.withColumn("newest", F.sum(tokens).over(w)).filter(F.col("newest") <= bound)
