"""Sequence analytics over ordered event streams, all as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.identity import digest


def ordinals(events: DataFrame, episode: str, order: list[str]) -> DataFrame:
    """Add ``ordinal``, from 0, within each episode."""
    w = Window.partitionBy(episode).orderBy(*order)
    return events.withColumn("ordinal", F.row_number().over(w).cast("long") - 1)


def recurrence(turns: DataFrame, episode: str, signature: str) -> DataFrame:
    """Earlier turns with the same signature, the distance to the nearest, and whether it is the one before."""
    w = Window.partitionBy(episode, signature).orderBy("ordinal")
    return (
        turns.withColumn("prior", F.row_number().over(w).cast("long") - 1)
        .withColumn("distance", F.col("ordinal") - F.lag("ordinal").over(w))
        .withColumn("immediate", F.coalesce(F.col("distance") == 1, F.lit(False)))
    )


def cycles(turns: DataFrame, episode: str, signature: str) -> DataFrame:
    """Whether the last two, or three, signatures repeat those before, and the smallest period of one to three."""
    w = Window.partitionBy(episode).orderBy("ordinal")
    s = [F.col(signature), *(F.lag(signature, k).over(w) for k in range(1, 6))]
    equal = lambda p: F.coalesce(F.lit(True) & _all([s[k] == s[k + p] for k in range(p)]), F.lit(False))
    return turns.withColumn("period_2", equal(2)).withColumn("period_3", equal(3)).withColumn(
        "smallest", F.when(equal(1), 1).when(equal(2), 2).when(equal(3), 3)
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def novelty(events: DataFrame, episode: str, signature: str, value: str) -> DataFrame:
    """Whether a value differs from the last one that is not null of the same signature; null for the first."""
    before = Window.partitionBy(episode, signature).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(value, ignorenulls=True).over(before)
    return events.withColumn("novel", F.col(value) != last)


def interval_match(events: DataFrame, episode: str, kind: str, call: str, action: str, observation: str) -> DataFrame:
    """Actions with the observation that answers them, and how it was found.

    First by a call id that is unique on both sides; then the only observation
    that follows the action before the next one, is not taken yet and does not
    conflict; last a single action with a single observation.
    """
    e = events.select(F.col(episode).alias("ep"), "ordinal", F.col(kind).alias("kind"), F.nullif(F.col(call).cast("string"), F.lit("")).alias("cid"))
    e = e.filter(F.col("kind").isin(action, observation))
    is_a, is_o, at = F.col("kind") == action, F.col("kind") == observation, F.col("ordinal")
    whole, same = Window.partitionBy("ep"), Window.partitionBy("ep", "cid")
    exact = F.col("cid").isNotNull() & (F.count_if(is_a).over(same) == 1) & (F.count_if(is_o).over(same) == 1)
    e = e.withColumn("exact", exact).withColumn("partner", F.min(F.when(is_o, at)).over(same))
    before = whole.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    e = (
        e.withColumn("act", F.last(F.when(is_a, F.struct("ordinal", "cid", "exact")), ignorenulls=True).over(before))
        .withColumn("na", F.count_if(is_a).over(whole)).withColumn("no", F.count_if(is_o).over(whole))
        .withColumn("so", F.min(F.when(is_o, at)).over(whole)).withColumn("sc", F.max(F.when(is_o, F.col("cid"))).over(whole))
    )
    unlike = lambda x, y: F.coalesce(F.col(x) != F.col(y), F.lit(False))
    fits = is_o & ~F.col("exact") & F.col("act").isNotNull() & ~F.col("act.exact") & ~unlike("act.cid", "cid")
    # An action and the observations of its interval are one group: no join is needed.
    slots = e.withColumn("slot", F.when(is_a, at).otherwise(F.col("act.ordinal"))).filter("slot is not null").groupBy("ep", "slot").agg(
        F.max(F.when(is_a, F.struct("exact", "partner", "na", "no", "so", "sc", "cid"))).alias("a"), F.count_if(fits).alias("n"), F.min(F.when(fits, at)).alias("own")
    )
    single = (F.col("a.na") == 1) & (F.col("a.no") == 1) & ~unlike("a.cid", "a.sc")
    found = (
        F.when(F.col("a.exact"), F.struct(F.col("a.partner").alias("o"), F.lit("call-id").alias("m"))).when(F.col("n") == 1, F.struct(F.col("own").alias("o"), F.lit("event-order").alias("m")))
        .when(single, F.struct(F.col("a.so").alias("o"), F.lit("singleton-fallback").alias("m")))
    )
    judged = slots.filter("a is not null").withColumn("f", found)
    return judged.select(F.col("ep").alias(episode), F.col("slot").alias("ordinal"), F.col("f.o").alias("observation"), F.coalesce("f.m", F.lit("unmatched")).alias("match"))


def fifo_pairs(events: DataFrame, key: list[str], kind: str, left: str, right: str) -> DataFrame:
    """The k-th left event of a key with the k-th right one; left events without a partner stay."""
    w = Window.partitionBy(*key, kind).orderBy("ordinal")
    ranked = events.filter(F.col(kind).isin(left, right)).withColumn("k", F.row_number().over(w).cast("long"))
    a = ranked.filter(F.col(kind) == left).select(*key, "k", F.col("ordinal").alias("left_at"))
    b = ranked.filter(F.col(kind) == right).select(*key, "k", F.col("ordinal").alias("right_at"))
    return a.join(b, [*key, "k"], "left")


def first_after(events: DataFrame, episode: str, mark: Column, wanted: Column) -> DataFrame:
    """For each episode, the last marked ordinal and the first wanted one after it."""
    last = F.max(F.when(mark, F.col("ordinal"))).over(Window.partitionBy(episode))
    return events.withColumn("mark_at", last).groupBy(episode).agg(
        F.max("mark_at").alias("mark_at"), F.min(F.when(wanted & (F.col("ordinal") > F.col("mark_at")), F.col("ordinal"))).alias("after_at")
    )


def state_chain(events: DataFrame, episode: str, chunk: Column, domain: str = "state") -> DataFrame:
    """Running hash of each episode: every state is the digest of the one before and the chunk.

    A fold is the one shape here that needs an episode's chunks together; they
    are hashed first, so an entry is small whatever the payload.
    """
    entry = F.struct("ordinal", digest(chunk).alias("d"))
    folded = events.groupBy(episode).agg(F.array_sort(F.collect_list(entry)).alias("c"))
    chained = F.aggregate("c", digest(F.lit(domain)), lambda h, x: digest(F.concat(F.lit(domain), h, x["d"])))
    return folded.select(episode, F.size("c").cast("long").alias("n_events"), chained.alias("state"))


def loop_guard(events: DataFrame, episode: str, signature: str, limit: int) -> DataFrame:
    """First ordinal at which some signature has been seen more than ``limit`` times."""
    w = Window.partitionBy(episode, signature).orderBy("ordinal")
    seen = events.withColumn("times", F.row_number().over(w))
    return seen.groupBy(episode).agg(
        F.max("times").cast("long").alias("most"), F.min(F.when(F.col("times") > limit, F.col("ordinal"))).alias("stopped_at")
    )


def open_ids(events: DataFrame, key: list[str], kind: str, opens: str, closes: str) -> DataFrame:
    """Keys opened more often than closed."""
    return events.groupBy(*key).agg(F.count_if(F.col(kind) == opens).alias("opened"), F.count_if(F.col(kind) == closes).alias("closed")).filter(
        "opened > closed"
    )


def paired_runs(events: DataFrame, case: str, run: Column, score: Column) -> DataFrame:
    """Scores of two runs of each case, with the winner."""
    sums = events.groupBy(case).agg(F.sum(F.when(run, score)).alias("baseline"), F.sum(F.when(~run, score)).alias("candidate"))
    both = sums.filter("baseline is not null and candidate is not null")
    return both.withColumn("result", F.when(F.col("candidate") > F.col("baseline"), "win").when(F.col("candidate") < F.col("baseline"), "loss").otherwise("tie"))
