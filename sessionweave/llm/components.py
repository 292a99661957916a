"""Connected components of an edge table, without gathering it anywhere.

Alternating large-star and small-star steps: every round is two aggregations
and two joins on the edges, and ends as a star around each component's
smallest node.  Each round is written to the shared folder, so that plans stay
short and a lost executor costs one stage.  Hot nodes are the large side of a
sort-merge join against one row a node, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """``(a, b)`` edges of any orientable type to ``(node, root)``, roots excluded.

    ``root`` is the smallest node reachable.  Null ends and self loops are
    ignored, repeated edges count once; an edge table without rows gives none.
    """
    e = edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    e = scratch.save(e, f"{name}-0")
    before, k = None, 0
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, k = now, k + 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.save(
            both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-{k}-low"
        )
        large = (
            both.join(low.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
            .filter("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = scratch.save(large, f"{name}-{k}-large")
        low = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{k}-small")
        joined = large.join(low.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        ).distinct()
        e = scratch.save(small, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}", f"{name}-{k}-low", f"{name}-{k}-large", f"{name}-{k}-small")
