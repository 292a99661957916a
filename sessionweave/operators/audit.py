"""Manifests, coverage, reconciliation and constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest(inventory: DataFrame, snapshot: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Full outer join of two ledgers, with how each key stands."""
    a = inventory.select(*keys, F.col(value).alias("before"))
    b = snapshot.select(*keys, F.col(value).alias("after"))
    status = (
        F.when(F.col("after").isNull(), "missing_from_snapshot").when(F.col("before").isNull(), "new_in_snapshot")
        .when(F.col("before") == F.col("after"), "stable").otherwise("changed")
    )
    return a.join(b, keys, "full_outer").withColumn("status", status)


def coverage(rows: DataFrame, strong: Column, weak: Column, size: Column) -> DataFrame:
    """Share of rows and of sizes matched strongly and weakly; one where there are none."""
    part = lambda c, of: F.coalesce(F.try_divide(F.sum(F.when(c, of).otherwise(0)), F.sum(of)), F.lit(1.0)).cast("double")
    one = F.lit(1)
    return rows.agg(
        F.count("*").alias("rows"), part(strong, one).alias("strong_rows"), part(strong, size).alias("strong_size"),
        part(~strong & weak, one).alias("weak_rows"),
    )


def match_status(exact: Column, digests: Column, blocked: Column) -> Column:
    """Adapter match by priority."""
    return (
        F.when(exact, "exact_ref").when(digests == 1, "unique_digest").when(digests > 1, "ambiguous_digest")
        .when(blocked, "blocked").otherwise("unparsed")
    )


def two_level_counts(rows: DataFrame, outer: str, inner: str, size: str) -> DataFrame:
    """Counts and sums by the outer level, and by both."""
    sets = rows.groupingSets([(outer,), (outer, inner)], outer, inner)
    return sets.agg(F.count("*").alias("files"), F.sum(size).alias("size"))


def violations(rows: DataFrame, group: list[str], condition: Column) -> DataFrame:
    """Groups that break a constraint: a ledger, empty if it holds."""
    return rows.groupBy(*group).agg(condition.alias("broken"), F.count("*").alias("n")).filter("broken").drop("broken")


def same_state_pairs(rows: DataFrame, key: str, target: str, id: str) -> DataFrame:
    """For each key whose targets differ, the first row of the smallest and of the largest target.

    Pairs of extremes stand for the group, so a hot key costs one row.
    """
    low = F.min(F.struct(F.col(target), F.col(id))).alias("low")
    high = F.max(F.struct(F.col(target), -F.col(id))).alias("high")
    both = rows.groupBy(key).agg(low, high).filter(F.col("low")[target] != F.col("high")[target])
    return both.select(key, F.col("low")[id].alias("chosen"), (-F.col("high.col2")).alias("rejected"))


def key_schema(rows: DataFrame, json: str, group: str) -> DataFrame:
    """How often each key of JSON objects is present, and with which types."""
    parsed = rows.select(group, F.explode(F.from_json(json, "map<string,string>")).alias("key", "value"))
    kind = (
        F.when(F.col("value").isNull(), "null").when(F.col("value").rlike(r"^(?:true|false)$"), "boolean")
        .when(F.col("value").rlike(r"^-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?$"), "number").otherwise("string")
    )
    return parsed.groupBy(group, "key").agg(F.count("*").alias("present"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("types"))
