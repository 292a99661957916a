"""Action windows and trajectories: turns, evidence, state chains, and pairs of choices in one state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.identity import digest

#: What a joined observation proves.
STRENGTH = {"call-id": "exact", "event-order": "ordered", "singleton-fallback": "heuristic", "unmatched": "absent"}
#: Harness sentinel, and commands that change or check a work tree; what a failing tool writes.
TERMINAL = "COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"
MUTATES = r"(?i)\b(?:sed\s+-i|apply_patch|git\s+(?:apply|commit|checkout|reset)|rm\s|mv\s|cp\s|tee\s|mkdir\s|touch\s)|>>?\s*[\w./-]+"
VERIFIES = r"(?i)\b(?:pytest|unittest|tox|npm\s+test|cargo\s+test|go\s+test|make\s+test|ctest|mvn\s+test)\b"
FAILED = r"(?i)\b(?:traceback|error:|failed|failure|exception|command not found|no such file)\b"


def turns(events: DataFrame, episode: str, action: Column, message: str, signature: str, artifact: Column | None = None) -> DataFrame:
    """One row a turn: the actions of one message together, an action without a message on its own.

    ``ordinal`` numbers the turns of an episode by their first event; ``artifacts``
    are the distinct ones between a turn's last event and the next turn's first.
    """
    own = F.when(F.col(message).isNull(), F.struct(F.lit(None).cast("bigint").alias("m"), F.col("ordinal").alias("o"))).otherwise(
        F.struct(F.col(message).cast("bigint").alias("m"), F.lit(None).cast("bigint").alias("o"))
    )
    acts = events.filter(action).withColumn("turn", own)
    entry = F.struct(F.col("ordinal"), F.col(signature).alias("s"))
    made = acts.groupBy(episode, "turn").agg(
        F.min("ordinal").alias("first"), F.max("ordinal").alias("last"), F.count("*").alias("calls"), F.array_sort(F.collect_list(entry)).alias("c")
    )
    w = Window.partitionBy(episode).orderBy("first")
    made = made.withColumn("signature", digest(F.array_join(F.transform("c", lambda x: x["s"]), "\u0000"))).drop("c", "turn")
    made = made.withColumn("turn_ordinal", F.row_number().over(w).cast("long") - 1).withColumn("next_first", F.lead("first").over(w))
    if artifact is None:
        return made
    # A range join inside an episode: every artifact belongs to the turn whose gap holds it.
    a = events.filter(artifact).select(F.col(episode).alias("ep"), F.col("ordinal").alias("at"), F.col(signature).alias("a"))
    held = made.join(
        a, (F.col(episode) == F.col("ep")) & (F.col("at") > F.col("last")) & (F.col("next_first").isNull() | (F.col("at") < F.col("next_first")))
    ).groupBy(episode, "turn_ordinal").agg(F.array_sort(F.collect_set(digest(F.col("a")))).alias("artifacts"))
    return made.join(held, [episode, "turn_ordinal"], "left").withColumn("artifacts", F.coalesce("artifacts", F.array().cast("array<string>")))


def sequence_evidence(made: DataFrame, episode: str) -> DataFrame:
    """Repeats and complete cycles of two and three turns."""
    same = Window.partitionBy(episode, "signature").orderBy("turn_ordinal")
    w = Window.partitionBy(episode).orderBy("turn_ordinal")
    lag = lambda k: F.lag("signature", k).over(w) if k else F.col("signature")
    cycle = lambda p: F.coalesce(F.forall(F.array(*(lag(k) == lag(k + p) for k in range(p))), lambda x: x), F.lit(False))
    distance = F.col("turn_ordinal") - F.lag("turn_ordinal").over(same)
    periods = F.filter(F.array(*(F.when(cycle(p), F.lit(p)) for p in (2, 3))), lambda p: p.isNotNull())
    return made.withColumn("prior", F.row_number().over(same).cast("long") - 1).withColumn("distance", distance).withColumn(
        "immediate", F.coalesce(distance == 1, F.lit(False))
    ).withColumn("periods", periods)


def prefix_states(events: DataFrame, episode: str, ids: str, domain: str = "prefix") -> DataFrame:
    """Hash of all events before each: one pass that folds the digest of the prefix so far, instead of hashing every prefix anew."""
    entry = F.struct("ordinal", F.col(ids).cast("string").alias("i"))
    folded = events.groupBy(episode).agg(F.array_sort(F.collect_list(entry)).alias("c"))
    start = F.array(digest(F.lit(domain)))
    states = F.aggregate("c", start, lambda s, x: F.concat(s, F.array(digest(F.concat(F.element_at(s, -1), F.lit("\u0000"), x["i"])))))
    each = folded.select(episode, F.posexplode(F.arrays_zip(F.transform("c", lambda x: x["ordinal"]).alias("o"), F.slice(states, 1, F.size("c")).alias("s"))))
    return each.select(episode, F.col("col.o").alias("ordinal"), F.col("col.s").alias("state"))


def tool_failed(content: Column) -> Column:
    """A return code that is not zero, or text of a failure in the output."""
    parsed = F.try_parse_json(content)
    code = F.try_variant_get(parsed, "$.returncode", "int")
    output = F.try_variant_get(parsed, "$.output", "string")
    there = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(there, F.coalesce(code != 0, F.lit(False)) | F.coalesce(output.rlike(FAILED), F.lit(False))).otherwise(F.coalesce(content.rlike(FAILED), F.lit(False)))


def categories(made: DataFrame, episode: str, failed: str, mutates: str, verifies: str) -> DataFrame:
    """Turns chosen of each trajectory: the first, the first after a failure, the first change, the first check after the last change."""
    per = Window.partitionBy(episode)
    after = F.lag(failed).over(per.orderBy("turn_ordinal"))
    at = made.withColumn("after", F.coalesce(after, F.lit(False))).withColumn("last_change", F.max(F.when(F.col(mutates), F.col("turn_ordinal"))).over(per))
    first = lambda c: F.min(F.when(c, F.col("turn_ordinal"))).over(per)
    at = at.withColumn("r", first(F.col("after"))).withColumn("m", first(F.col(mutates))).withColumn("v", first(F.col(verifies) & (F.col("turn_ordinal") > F.col("last_change"))))
    own = F.col("turn_ordinal")
    names = (("first_grounded_action", own == 0), ("post_failure_recovery", own == F.col("r")), ("first_mutation", own == F.col("m")), ("post_mutation_verification", own == F.col("v")))
    found = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in names)), lambda x: x.isNotNull())
    return at.select(episode, "turn_ordinal", found.alias("categories")).filter(F.size("categories") > 0)


def positional_join(calls: DataFrame, results: DataFrame, episode: str, turn: str, place: str) -> tuple[DataFrame, DataFrame]:
    """The i-th call of a turn with its i-th result; turns whose numbers differ are rejected whole."""
    n = calls.groupBy(episode, turn).agg(F.count("*").alias("n")).join(results.groupBy(episode, turn).agg(F.count("*").alias("m")), [episode, turn], "full_outer")
    bad = n.filter(~F.col("n").eqNullSafe(F.col("m"))).select(episode, turn, F.when(F.coalesce("m", F.lit(0)) < F.coalesce("n", F.lit(0)), "observation_missing").otherwise("observation_join_ambiguous").alias("reason"))
    good = calls.join(bad, [episode, turn], "left_anti")
    return good.join(results, [episode, turn, place]), bad


def state_transitions(made: DataFrame, episode: str, base: Column, target: Column, chunk: Column) -> DataFrame:
    """``(episode, turn_ordinal, state_hash, target_hash)``: every state is the digest of the one before and the chunk."""
    entry = F.struct("turn_ordinal", digest(target).alias("t"), digest(chunk).alias("d"))
    folded = made.groupBy(episode).agg(F.array_sort(F.collect_list(entry)).alias("c"), F.first(digest(F.concat(F.lit("state\u0000"), base))).alias("b"))
    states = F.aggregate("c", F.array("b"), lambda s, x: F.concat(s, F.array(digest(F.concat(F.lit("state\u0000"), F.element_at(s, -1), x["d"])))))
    each = folded.select(episode, F.explode(F.arrays_zip("c", F.slice(states, 1, F.size("c")).alias("s"))))
    return each.select(episode, F.col("col.c.turn_ordinal").alias("turn_ordinal"), F.col("col.s").alias("state_hash"), F.col("col.c.t").alias("target_hash"))


def same_state_preferences(transitions: DataFrame, chosen: Column, rejected: Column, order: list[str], cap: int) -> DataFrame:
    """Pairs of a chosen and a rejected target from one state, instance and repository; the first ``cap`` in order.

    Targets are grouped before they meet: a pair of different targets stands for
    all rows behind it only in its order, so each (state, target) side keeps its
    first ``cap`` rows, which is all that can be among the first ``cap`` pairs.
    """
    keys = ["instance_id", "state_hash", "repository"]
    side = lambda rows, names: rows.select(*keys, *(F.col(c).alias(f"{names}_{c}") for c in ("target_hash", *order)))
    few = Window.partitionBy(*keys, "target_hash").orderBy(*order)
    top = lambda rows: rows.withColumn("__r", F.row_number().over(few)).filter(F.col("__r") <= cap).drop("__r")
    both = side(top(transitions.filter(chosen)), "c").join(side(top(transitions.filter(rejected)), "r"), keys)
    both = both.filter("c_target_hash <> r_target_hash")
    return both.orderBy("instance_id", "state_hash", *(f"c_{c}" for c in order), *(f"r_{c}" for c in order)).limit(cap)


def cycle_keys(made: DataFrame, signatures: Column, observations: Column, state: Column) -> DataFrame:
    """Key of a turn by what it did, saw and left; without a told state the observations stand for it."""
    seen = digest(F.to_json(observations))
    left = F.coalesce(state, seen)
    return made.withColumn("observation_sha256", seen).withColumn("state_after", left).withColumn(
        "state_source", F.when(state.isNotNull(), "explicit").otherwise("observation_digest")
    ).withColumn("cycle_key", digest(F.to_json(F.struct(signatures.alias("action_signatures"), seen.alias("observation_sha256"), left.alias("state_after")))))


def score(cases: DataFrame, calls: DataFrame, cycles: DataFrame) -> DataFrame:
    """Failures of each case against what it demands, with their number by kind.

    ``cases``: case, required, required_any, forbidden, skills (arrays), before
    (array of (first, then, need)); ``calls``: case, at, name, skill;
    ``cycles``: case, period.
    """
    per = calls.groupBy("case").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names"), F.collect_set(F.lower("skill")).alias("read")
    )
    looped = cycles.groupBy("case").agg(F.array_sort(F.collect_list(F.concat(F.lit("cycle_period_"), F.col("period").cast("string")))).alias("loops"))
    all_ = cases.join(per, "case", "left").join(looped, "case", "left")
    none = F.array().cast("array<string>")
    names, read = F.coalesce("names", none), F.coalesce("read", none)
    tell = lambda prefix, items: F.transform(items, lambda x: F.concat(F.lit(prefix), x))
    lack_any = (F.size("required_any") > 0) & ~F.arrays_overlap("required_any", names)
    at = lambda x: F.array_position(names, x["then"])
    early = F.filter("before", lambda x: (at(x) > 0) & (F.size(F.filter(F.slice(names, 1, F.greatest(at(x) - 1, F.lit(0)).cast("int")), lambda n: n == x["first"])) < x["need"]))
    failures = F.concat(
        tell("missing_required:", F.array_except("required", names)),
        F.when(lack_any, F.array(F.concat(F.lit("missing_required_any:"), F.array_join("required_any", ",")))).otherwise(none),
        tell("forbidden_call:", F.array_intersect("forbidden", names)),
        F.transform(early, lambda x: F.concat(F.lit("order:"), x["first"], F.lit("<"), x["then"], F.lit(":need"), x["need"].cast("string"))),
        tell("missing_skill:", F.array_except(F.transform("skills", lambda s: F.lower(s)), read)), F.coalesce("loops", none),
    )
    return all_.select("case", failures.alias("failures"), (F.size(failures) == 0).alias("passed"), F.size(names).cast("long").alias("calls"))


def run_totals(scores: DataFrame, run: str) -> DataFrame:
    """Attempted, passed and failed cases of each run, and failures by kind."""
    kinds = scores.select(run, F.explode("failures").alias("f")).groupBy(run, F.split("f", ":")[0].alias("kind")).agg(F.count("*").alias("n"))
    by = kinds.groupBy(run).agg(F.array_sort(F.collect_list(F.struct("kind", "n"))).alias("by_kind"))
    sums = scores.groupBy(run).agg(F.count("*").alias("attempted"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.sum("calls").alias("calls"))
    return sums.join(by, run, "left")
