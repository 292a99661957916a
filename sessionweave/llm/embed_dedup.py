"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors of equal label and length are compared by cosine in double precision.
Equal vectors are compared once, with their number.  The second-moment matrix
of all unit vectors is summed on the executors (its size depends on the
dimension alone), and its eigenvectors order the coordinates by how much they
explain.  Vectors are range-sorted by label and leading coordinate and cut into
bricks of ``tile`` vectors at most; consecutive bricks of a label form a tile.
Two tiles meet only if their ranges of the leading coordinate come within the
largest distance that the threshold allows: a task holds the one and streams
the bricks of the other.  Within a pair of bricks, dot products accumulate over
leading coordinates; the rest is bounded by the product of suffix norms, and
pairs drop out as soon as they cannot reach the threshold.  Survivors are
decided by the full cosine of the unrotated vectors.

A pair of tiles yields the number of links of each vector and a spanning
forest, never all pairs.  A label is ``PARTS`` tiles of equal size, so each of
its vectors is sent to as many tasks at most and a label with a third of all
rows is spread over ``PARTS ** 2 / 2`` tasks; only where a tile would exceed
``TILE_BYTES`` are there more.

Defined results: vectors that are null, empty, all zero, or hold a null or a
non-finite component, and those with a null label, link with nothing and are
kept; rows that repeat a vector are separate vectors that link; vectors of
different lengths do not link; a component id is null only where all its ids
are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches, runs
from sessionweave.llm.components import components
from sessionweave.llm.scratch import Scratch
from sessionweave.llm.simhash import spanning

TILE = 1024
#: Tiles of a label, unless one would hold more bytes than the bound.
PARTS, TILE_BYTES = 8, 32 << 20
#: Slack of bounds against rounding; links are decided by the exact cosine.
SLACK = 1e-9


def units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def moments(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Eigenvectors, largest eigenvalue first, of the sum of outer products, by dimension.

    A task sums its vectors to one matrix a dimension; about the square root of
    all tasks add up those of as many others, and one task the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b["dim"].to_numpy()
            for dim in np.unique(dims):
                rows = b["v"].filter(pa.array(dims == dim))
                x = units(rows.flatten().to_numpy().astype(np.float64).reshape(-1, dim))
                total[dim] = total.get(dim, 0) + x.T @ x
        yield sums(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, m in zip(b["dim"].to_pylist(), b["m"].to_pylist(), strict=True):
                total[dim] = total.get(dim, 0) + np.frombuffer(m, np.float64).reshape(dim, dim)
        yield sums(total)

    def sums(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        cells = pa.array([m.tobytes() for m in total.values()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), cells], ["dim", "m"])

    kind, given = "dim int, m binary", distinct.select("dim", "v")
    few = max(1, round(given.rdd.getNumPartitions() ** 0.5))
    table = given.mapInArrow(run, kind).repartition(few).mapInArrow(add, kind).repartition(1).mapInArrow(add, kind).toArrow()
    return {
        dim: np.linalg.eigh(np.frombuffer(m, np.float64).reshape(dim, dim))[1][:, ::-1]
        for dim, m in zip(table["dim"].to_pylist(), table["m"].to_pylist(), strict=True)
    }


def close_pairs(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of rows of ``a`` and ``b`` with cosine at or above the threshold (``i < j`` if they are the same)."""
    ua, ub = units(a), units(b)
    ra, rb = ua @ turn, ub @ turn
    dim = a.shape[1]
    steps = [*(k for k in (8, 16, 32, 64, 128, 256, 512) if k < dim), dim]
    tail = lambda r, k: np.sqrt((r[:, k:] ** 2).sum(1))
    k = steps[0]
    lead = ra[:, :k] @ rb[:, :k].T
    i, j = np.nonzero(lead + np.outer(tail(ra, k), tail(rb, k)) >= threshold - SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    lead = lead[i, j]
    for low, high in zip(steps, steps[1:], strict=False):
        keep = []
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            lead[s] += np.einsum("nk,nk->n", ra[i[s], low:high], rb[j[s], low:high])
            keep.append(lead[s] + tail(ra, high)[i[s]] * tail(rb, high)[j[s]] >= threshold - SLACK)
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j, lead = i[keep], j[keep], lead[keep]
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    keep = [
        np.einsum("nk,nk->n", a[i[s]], b[j[s]]) / (na[i[s]] * nb[j[s]]) >= threshold
        for s in (slice(at, at + (1 << 16)) for at in range(0, len(i), 1 << 16))
    ]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[keep], j[keep]


def near_vectors(
    table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98, tile: int = TILE,
    parts: int = PARTS, tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of each row."""
    spark = table.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "vectors")
    v = F.col("v")
    rows = table.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    sound = F.coalesce(
        F.col("label").isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
        & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    rows = rows.withColumn("k1", F.when(sound, F.xxhash64("label", "v"))).withColumn("k2", F.when(sound, F.xxhash64("v", F.lit(1), "label")))
    distinct = rows.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("low"), F.count("*").alias("n")
    )
    distinct = scratch.save(distinct.withColumn("dim", F.size("v")).withColumn("rep", F.monotonically_increasing_id()), "distinct")
    turns = moments(distinct)
    shared = spark.sparkContext.broadcast(turns)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, out = b["dim"].to_numpy(), np.zeros(b.num_rows)
            for dim in np.unique(dims):
                at = dims == dim
                x = units(b["v"].filter(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(-1, dim))
                out[at] = x @ shared.value[int(dim)][:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "y"])

    # Vectors of single precision stay so on their way; they are compared in double precision.
    real = np.float32 if isinstance(table.schema[vector].dataType, T.ArrayType) and isinstance(table.schema[vector].dataType.elementType, T.FloatType) else np.float64
    wide = distinct.select("label", "dim", "rep", "n", "v")
    sorted_ = wide.mapInArrow(lead, f"{schema_of(wide)}, y double").repartitionByRange("label", "dim", "y").sortWithinPartitions("label", "dim", "y")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def blocks(t: pa.Table, last: bool):
            codes = t["label"].combine_chunks().dictionary_encode().indices.to_numpy()
            starts = runs(codes, t["dim"].to_numpy())
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                for at in range(a, b, tile):
                    end = min(b, at + tile)
                    if end == t.num_rows and not last:  # may go on in the next batch
                        return t.slice(at), out
                    part = t.slice(at, end - at)
                    y = part["y"].to_numpy()
                    x = part["v"].combine_chunks().flatten().to_numpy().astype(real)
                    out.append(
                        {
                            "label": part["label"][0], "dim": part["dim"][0].as_py(), "lo": y[0], "hi": y[-1],
                            "rows": len(y), "reps": part["rep"].to_numpy().tobytes(), "ns": part["n"].to_numpy().tobytes(), "xs": x.tobytes(),
                        }
                    )
            return None, out

        def batch(found: list[dict]):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k].as_py() if k == "label" else f[k] for f in found], kind) for k, kind in kinds], [k for k, _ in kinds]
            )

        kinds = None
        for b in batches:
            if not b.num_rows:
                continue
            if kinds is None:
                kinds = [("label", b["label"].type), ("dim", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64()), ("rows", pa.int64()), ("reps", pa.binary()), ("ns", pa.binary()), ("xs", pa.binary())]
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            out: list[dict] = []
            held, out = blocks(t.combine_chunks(), False)
            if out:
                yield batch(out)
        if held is not None:
            out = []
            _, out = blocks(held.combine_chunks(), True)
            yield batch(out)

    kind = dict(wide.dtypes)["label"]
    bricks = sorted_.mapInArrow(cut, f"label {kind}, dim int, lo double, hi double, rows bigint, reps binary, ns binary, xs binary")
    bricks = scratch.save(bricks.withColumn("brick", F.monotonically_increasing_id()), "bricks")
    # A row a brick from here on: consecutive ones make a tile.
    whole = Window.partitionBy("label", "dim")
    before = whole.orderBy("lo", "hi", "brick").rowsBetween(Window.unboundedPreceding, -1)
    size = F.greatest(F.lit(tile), F.least(F.ceil(F.sum("rows").over(whole) / parts), F.floor(F.lit(tile_bytes) / 8 / F.col("dim"))))
    heads = bricks.select("label", "dim", "lo", "hi", "brick", "rows").withColumn("size", size)
    heads = heads.withColumn("nth", F.floor(F.coalesce(F.sum("rows").over(before), F.lit(0)) / F.col("size")))
    heads = scratch.save(heads.drop("size"), "heads")
    tiles = heads.groupBy("label", "dim", "nth").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("brick").alias("tile"))
    tiles = scratch.save(tiles, "tiles")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    a, b = tiles.alias("a"), tiles.alias("b")
    pairs = a.join(
        b,
        (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.nth") <= F.col("b.nth"))
        & (F.col("a.lo") <= F.col("b.hi") + reach) & (F.col("b.lo") <= F.col("a.hi") + reach),
    ).select(F.col("a.tile").alias("ta"), F.col("b.tile").alias("tb"))
    pairs = scratch.save(pairs, "pairs")
    sides = pairs.select("ta", "tb", F.col("ta").alias("of"), F.lit(0).alias("side")).unionByName(
        pairs.filter("ta <> tb").select("ta", "tb", F.col("tb").alias("of"), F.lit(1).alias("side"))
    )
    member = heads.join(tiles.select("label", "dim", "nth", "tile"), ["label", "dim", "nth"]).select("brick", "tile")
    jobs = bricks.select("brick", "dim", "reps", "ns", "xs").join(member, "brick").join(sides, F.col("tile") == F.col("of"))
    jobs = jobs.select("ta", "tb", "side", "dim", "reps", "ns", "xs").repartition("ta", "tb").sortWithinPartitions("ta", "tb", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def brick(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return (np.frombuffer(row["reps"], np.int64), np.frombuffer(row["ns"], np.int64), np.frombuffer(row["xs"], real).astype(np.float64).reshape(-1, row["dim"]))

        def links(a: tuple, b: tuple, dim: int, same: bool) -> pa.RecordBatch:
            i, j = close_pairs(a[2], b[2], shared.value[dim], threshold, same)
            every, jj = (a[0], j) if same else (np.concatenate([a[0], b[0]]), j + len(a[0]))
            count = np.bincount(i, b[1][j], len(every)) + np.bincount(jj, a[1][i], len(every))
            ka, kb, _ = spanning(len(every), [(i, jj, np.zeros(len(i), np.int64))])
            some = count > 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([every[some], every[ka]])),
                    pa.array(np.concatenate([every[some], every[kb]])),
                    pa.array(np.concatenate([count[some].astype(np.int64), np.zeros(len(ka), np.int64)])),
                ],
                ["a", "b", "n"],
            )

        own, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if own != (row["ta"], row["tb"]):
                    own, held = (row["ta"], row["tb"]), []
                new, same = brick(row), row["ta"] == row["tb"]
                for old in held if same or row["side"] else ():
                    yield links(old, new, row["dim"], False)
                if row["side"] == 0:
                    if same:
                        yield links(new, new, row["dim"], True)
                    held.append(new)

    found = scratch.save(jobs.mapInArrow(compare, "a bigint, b bigint, n bigint"), "found")
    counts = found.filter("a = b").groupBy("a").agg(F.sum("n").alias("others"))
    stars = scratch.save(components(found.filter("a <> b").select("a", "b"), scratch), "stars")
    placed = distinct.select("k1", "k2", "rep", "low", "n").join(stars.withColumnRenamed("node", "rep"), "rep", "left")
    placed = scratch.save(placed.withColumn("root", F.coalesce("root", "rep")), "placed")
    lows = scratch.save(placed.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    judged = placed.join(lows, "root").join(counts.withColumnRenamed("a", "rep"), "rep", "left").select(
        "k1", "k2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    judged = scratch.save(judged, "judged")
    out = rows.select("id", "k1", "k2").join(judged, ["k1", "k2"], "left")
    group = F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), group.alias("component_id"),
        F.col("id").eqNullSafe(group).alias("kept"),
    )


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)
