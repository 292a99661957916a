"""Bounded, balanced and deterministic selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, key: Column, order: list) -> DataFrame:
    """The first row of each key.  Hot keys are cut down to one row a task before the shuffle."""
    own = F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("own")
    first = rows.select(key.alias("__key"), F.struct(*order).alias("__order"), own)
    return first.groupBy("__key").agg(F.min_by("own", "__order").alias("own")).select("own.*")


def top_k(rows: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark keeps ``k`` a task before it shuffles."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def round_robin(rows: DataFrame, parent: str, order: list, parent_cap: int, total_cap: int) -> DataFrame:
    """At most ``parent_cap`` rows a parent, then parents in turn up to ``total_cap``."""
    capped = top_k(rows, [parent], order, parent_cap)
    return capped.orderBy("rank", parent).limit(total_cap)


def balanced_caps(categories: DataFrame, category: str, total: int) -> DataFrame:
    """Equal shares of ``total``; the remainder goes to the first categories."""
    names = categories.select(category).distinct()
    w = Window.orderBy(category)  # one row a category
    n = names.agg(F.count("*").alias("n"))
    ranked = names.withColumn("k", F.row_number().over(w))
    share = F.floor(F.lit(total) / F.col("n"))
    return ranked.join(F.broadcast(n)).select(category, (share + F.when(F.col("k") <= F.lit(total) % F.col("n"), 1).otherwise(0)).alias("cap"))


def balanced(rows: DataFrame, category: str, order: list, total: int) -> DataFrame:
    """Up to each category's share of ``total`` rows."""
    caps = balanced_caps(rows, category, total)
    w = Window.partitionBy(category).orderBy(*order)
    few = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= total)  # no cap is larger: tasks keep as many before the shuffle
    return few.join(caps, category).filter("rank <= cap")


def effective_cap(part: Column, rest: Column, num: int, den: int) -> Column:
    """Most rows of the rest such that the part keeps ``num / den``, in whole numbers."""
    return F.greatest(F.lit(0), F.floor((part * den - num * part) / num)).cast("long")


def over_cap(rows: DataFrame, group: list[str], order: list, cap: int) -> DataFrame:
    """Flag rows beyond ``cap`` of their group, in file order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("over", F.row_number().over(w) > cap)


def resolve_lanes(rows: DataFrame, parent: str, lane: str, priority: dict[str, int]) -> DataFrame:
    """One lane a parent: that of the best priority."""
    rank = F.create_map(*(F.lit(x) for kv in priority.items() for x in kv))
    return rows.groupBy(parent).agg(F.min_by(lane, F.coalesce(F.try_element_at(rank, F.col(lane)), F.lit(10**6))).alias("lane"), F.countDistinct(lane).alias("lanes"))


def within_budget(rows: DataFrame, order: list, size: Column, budget: int, bucket: Column) -> DataFrame:
    """The longest prefix in a given order whose sizes sum up to the budget.

    ``bucket`` rises with the order and takes a few thousand values (the first
    digits of a hash): sums before each bucket are added to the running sums
    inside it, so no task sees more than one bucket in order.
    """
    sized = rows.withColumn("__size", size).withColumn("__b", bucket)
    w = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    before = sized.groupBy("__b").agg(F.sum("__size").alias("__s")).withColumn("__before", F.coalesce(F.sum("__s").over(w), F.lit(0)))
    run = F.sum("__size").over(Window.partitionBy("__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + F.col("__before")
    near = sized.join(before.filter(F.col("__before") < budget).select("__b", "__before"), "__b")
    return near.withColumn("running", run).filter(F.col("running") <= budget).drop("__size", "__b", "__before")


def greedy_cover(candidates: DataFrame, parent: str, items: str, limit: int) -> list[tuple]:
    """Parents picked one by one, each adding the most new items; ties go to the smaller parent.

    A sequential choice over compact rows: every round is one aggregation on
    the executors, and the driver gets one row.
    """
    picked: list[tuple] = []
    left = candidates.select(parent, items).distinct()
    while len(picked) < limit:
        best = left.groupBy(parent).agg(F.countDistinct(items).alias("gain")).orderBy(F.desc("gain"), parent).limit(1).collect()
        if not best:
            break
        picked.append((best[0][0], best[0][1]))
        # One plan over the source, however many rounds: the picked parents' items are excluded.
        have = candidates.filter(F.col(parent).isin([p for p, _ in picked])).select(F.col(items).alias("__have")).distinct()
        left = candidates.select(parent, items).distinct().join(have, F.col(items) == F.col("__have"), "left_anti")
    return picked


def every_fifth(rows: DataFrame, parent: str) -> DataFrame:
    """Split of each distinct parent in sorted order: every fifth is validation, if there are several.

    Parents are ranked by range partitions: counts of the partitions before are
    added, so no task sees all of them.
    """
    names = rows.select(parent).distinct().repartitionByRange(parent).sortWithinPartitions(parent)
    placed = names.withColumn("__part", F.spark_partition_id()).groupBy("__part").agg(F.array_sort(F.collect_list(parent)).alias("names"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sized = placed.withColumn("n", F.size("names")).select("__part", "names", "n")
    before = sized.select("__part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))  # one row a partition
    total = sized.agg(F.sum("n").alias("total"))
    each = sized.join(before, "__part").join(F.broadcast(total))  # total is one row
    flat = each.select("before", "total", F.posexplode("names").alias("k", parent))
    return flat.select(parent, F.when((F.col("total") > 1) & ((F.col("before") + F.col("k")) % 5 == 0), "validation").otherwise("train").alias("split"))
