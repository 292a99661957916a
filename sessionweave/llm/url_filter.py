"""URL filter: blocked Bloom filter first, exact hash join after.

Listed entries are canonical URLs: a host with all its subdomains, and a path
prefix.  A URL's possible entries are its host suffixes, each with the path
prefixes of those lengths that the list holds at all.  Their 64-bit hashes
probe a split-block Bloom filter (256-bit blocks, eight bits an entry); only
possible hits go on to a hash join with the list, which removes every false
positive.  Of the entries that fit, the longest rule decides; where none of
them is a rule, a listed URL is blocked.

Scale: the filter is built by a distributed aggregation and is broadcast only
up to ``max_filter_bytes``; longer lists are cut by hash into parts, each of
which is a pass that is saved before the next one is broadcast and the last one
released, so an executor holds one part whatever the length of the list.  The
exact join broadcasts the list only below ``broadcast_entries``; beyond it both
sides are shuffled by key, with the probing side salted, so one host with a
third of all rows is spread.  URLs without a possible hit are never shuffled.

Defined results: a null URL, or one without ``://``, has an empty host and an
empty path and fits no entry; repeated rows are judged one by one; an empty
list gives every row the default verdict; null hosts, paths or verdicts in the
list are entries that fit nothing.  Other columns of ``pages`` do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.scratch import Scratch

BITS_PER_ENTRY = 16
#: Odd multipliers, one for each 32-bit word of a block (as in the Parquet specification of split-block filters).
SALTS = np.array(
    [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(rest, UPPER, LOWER)).otherwise("")


def canonical_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    at = F.instr(rest, "/")
    return F.when((F.instr(url, "://") > 0) & (at > 0), F.substring(rest, at, F.length(rest))).otherwise("")


def block_masks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number, and the eight one-bit words, of each 64-bit hash."""
    h = hashes.view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return block.astype(np.int64), np.uint32(1) << ((low[:, None] * SALTS) >> np.uint32(27))


def build_filter(keys: DataFrame, blocks: int) -> np.ndarray:
    """Filter over the column ``h``; the driver gets ``blocks`` rows at most."""

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, words = block_masks(np.asarray(b["h"]), blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), *(pa.array(words[:, k].view(np.int32)) for k in range(8))], names
            )

    names = ["block", *(f"w{k}" for k in range(8))]
    schema = T.StructType([T.StructField("block", T.LongType())] + [T.StructField(n, T.IntegerType()) for n in names[1:]])
    rows = keys.select("h").mapInArrow(masks, schema).groupBy("block").agg(*(F.bit_or(n).alias(n) for n in names[1:]))
    table = rows.toArrow()
    out = np.zeros((blocks, 8), np.uint32)
    if table.num_rows:
        at = table["block"].to_numpy()
        for k in range(8):
            out[at, k] = table[f"w{k}"].to_numpy().view(np.uint32)
    return out


def possible_hits(candidates: DataFrame, bits: np.ndarray, part: int, parts: int, spark: SparkSession) -> tuple[DataFrame, Broadcast]:
    """Add to ``hits`` those positions of the array ``hashes`` that the filter of this part passes; also the broadcast filter."""
    shared = spark.sparkContext.broadcast(bits)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            column = b["hashes"]
            flat = np.asarray(column.flatten())
            block, words = block_masks(flat, len(table))
            ok = ((table[block] & words) == words).all(axis=1) & (flat % parts == part)
            ends = np.cumsum(np.asarray(pa.compute.list_value_length(column)).astype(np.int64))
            starts = np.append(0, ends[:-1])
            row = np.repeat(np.arange(len(column)), ends - starts)[ok]
            place = (np.arange(len(flat)) - np.repeat(starts, ends - starts))[ok]
            count = np.bincount(row, minlength=len(column))
            found = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(place, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, "found"])

    schema = T.StructType([*candidates.schema.fields, T.StructField("found", T.ArrayType(T.IntegerType()))])
    return candidates.mapInArrow(probe, schema).withColumn("hits", F.concat("hits", "found")).drop("found"), shared


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed_urls: DataFrame | None = None,
    url: str = "url",
    keep: list[str] | None = None,
    default: str = "allow",
    max_filter_bytes: int = 32 << 20,
    broadcast_entries: int = 100_000,
    salts: int = 32,
) -> DataFrame:
    """``keep`` columns of ``pages`` with ``host, path, rule, verdict``.

    ``rules`` holds ``host, path, verdict``, ``listed_urls`` holds ``host,
    path`` of URLs to block where no rule fits; of repeated rules the smallest
    verdict counts.  ``rule`` is host and path of the deciding rule, null where
    none fits; ties in length go to the longer host.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "urls")
    stated = rules.select("host", "path", "verdict", F.lit(True).alias("stated"))
    if listed_urls is not None:
        stated = stated.unionByName(listed_urls.select("host", "path", F.lit("block").alias("verdict"), F.lit(False).alias("stated")))
    listed = (
        stated.filter("host is not null and path is not null and verdict is not null")
        .groupBy("host", "path")
        .agg(F.max("stated").alias("stated"), F.min(F.struct(~F.col("stated"), "verdict")).alias("v"))
        .select("host", "path", "stated", F.col("v.verdict").alias("v"), F.xxhash64("host", "path").alias("h"))
    )
    listed = scratch.save(listed, "listed")
    count, *_ = listed.agg(F.count("*")).first()
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())  # one row a path length
    per_part = max_filter_bytes * 8 // BITS_PER_ENTRY
    parts = max(1, -(-count // per_part))
    blocks = max(1, -(-min(count, per_part) * BITS_PER_ENTRY // 256))

    keep = keep if keep is not None else [c for c in pages.columns if c not in {"host", "path", "rule", "verdict"}]
    own = pages.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("own"), F.col(f"`{url}`").alias("u")).select(
        "own", canonical_host(F.col("u")).alias("host"), canonical_path(F.col("u")).alias("path")
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    sizes = F.filter(F.array(*(F.lit(n) for n in lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    pairs = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(sizes, lambda n: F.struct(s.alias("host"), F.substring(F.col("path"), F.lit(1), n).alias("path"))),
        )
    )
    asked = own.withColumn("pairs", pairs).withColumn(
        "hashes", F.transform("pairs", lambda p: F.xxhash64(p["host"], p["path"]))
    ).withColumn("hits", F.array().cast("array<int>"))
    for part in range(parts):
        of_part = listed if parts == 1 else listed.filter(F.expr(f"pmod(h, {parts}) = {part}"))
        asked, shared = possible_hits(asked, build_filter(of_part, blocks), part, parts, spark)
        asked = scratch.save(asked, f"asked-{part}")  # probed once, though two branches read it
        shared.destroy()
        scratch.drop(f"asked-{part - 1}")
    none = [F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")]
    missed = asked.filter("size(hits) = 0").select("own.*", "host", "path", *none)
    hit = asked.filter("size(hits) > 0").withColumn("row", F.monotonically_increasing_id()).select(
        "row", "own", "host", "path", F.explode(F.transform("hits", lambda k: F.get("pairs", k))).alias("pair")
    ).select("row", "own", "host", "path", F.col("pair.host").alias("eh"), F.col("pair.path").alias("ep"))
    exact = listed.select(F.col("host").alias("eh"), F.col("path").alias("ep"), "stated", "v")
    if count <= broadcast_entries:
        joined = hit.join(F.broadcast(exact), ["eh", "ep"], "left")
    else:
        joined = hit.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts))).join(
            exact.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))), ["eh", "ep", "salt"], "left"
        )
    best = F.max(
        F.when(
            F.col("v").isNotNull(),
            F.struct(
                "stated",
                (F.length("eh") + F.length("ep")).alias("n"),
                F.length("eh").alias("m"),
                F.when(F.col("stated"), F.concat("eh", "ep")).alias("rule"),
                "v",
            ),
        )
    ).alias("best")
    judged = joined.groupBy("row").agg(
        F.first("own").alias("own"), F.first("host").alias("host"), F.first("path").alias("path"), best
    ).select("own.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict"))
    return missed.unionByName(judged)
