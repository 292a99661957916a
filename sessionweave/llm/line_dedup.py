"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lower-cased.
Keys of ``min_chars`` code points or more that several documents hold lose all
their lines except in the document with the smallest id.

Documents come in batches of ascending ids.  A batch's distinct keys (128-bit
hash, smallest id) are merge-joined with the sorted runs of earlier batches:
keys found there belong to an earlier document, the rest become a new run
(anti-join).  When ``fanout`` runs stand on a level they are merged into one of
the next level, so a key is rewritten a logarithmic number of times.  Runs are
bucketed by key and sorted inside each bucket, so neither the joins nor the
merges shuffle them.  A ``LineRuns`` object can take further batches later, in
this application or, with a folder of its own, in another, as long as their ids
are larger.

Scale: only hashes are shuffled by key, aggregated to one row a key and task
first; a key that a third of all documents hold is the large side of a join
with one row, which Spark splits.  Texts are shuffled once, by id.

Defined results: a null or empty text is one empty line; documents with a null
id neither own nor lose lines; rows that repeat an id are one document and
lose the same lines; an empty table gives an empty result; a document may lose
all lines and then has an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches, raw_texts
from sessionweave.llm.scratch import Scratch

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Batches of a run over a whole table.
BATCHES = 4


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the line's key, or None if the key is too short to count."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def document_keys(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """Distinct keys of each row: ``(id, h1, h2)``; rows with a null id have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [{line_key(x, min_chars) for x in t.split(b"\n")} - {None} for t in raw_texts(b["raw"])]
            at = np.repeat(np.arange(b.num_rows), [len(x) for x in found])
            halves = np.frombuffer(b"".join(k for x in found for k in x), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b["id"].take(pa.array(at)), pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["id", "h1", "h2"]
            )

    given = docs.filter(F.col(f"`{id}`").isNotNull()).select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("raw"))
    long = lambda n: T.StructField(n, T.LongType())
    return given.mapInArrow(run, T.StructType([given.schema["id"], long("h1"), long("h2")]))


class LineRuns:
    """Sorted runs ``(h1, h2, owner)`` by level; no key stands in two runs.

    A run is a table of hash buckets, each sorted by key.  Joins of a batch with
    a run, and merges of two runs, read bucket by bucket in order: nothing of a
    run is shuffled again.  Below a stated ``where`` the runs outlive the
    application, and a later one goes on from them.
    """

    KEYS = ["h1", "h2"]

    def __init__(self, spark: SparkSession, fanout: int = 2, where: str | None = None, id_type: str = "bigint"):
        self.spark, self.fanout = spark, fanout
        self.scratch, self.buckets = Scratch(spark, "runs", where), int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = []
        self.made = self.merges = 0
        for name in self.scratch.names():
            _, made, level, buckets = name.split("-")
            self.buckets, self.made = int(buckets), max(self.made, int(made) + 1)
            self._stand(int(level), name, self.scratch.open_buckets(name, f"h1 bigint, h2 bigint, owner {id_type}", self.KEYS, self.buckets))

    def _stand(self, level: int, name: str, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, run))

    def _write(self, level: int, rows: DataFrame) -> None:
        name, self.made = f"run-{self.made}-{level}-{self.buckets}", self.made + 1
        self._stand(level, name, self.scratch.save_buckets(rows, name, self.KEYS, self.buckets))
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = old[0][1]
            for _, more in old[1:]:  # keys are disjoint: a full join is a merge
                b = more.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("owner").alias("b"))
                merged = merged.join(b.hint("merge"), (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2")), "full_outer").select(
                    F.coalesce("h1", "b1").alias("h1"), F.coalesce("h2", "b2").alias("h2"), F.coalesce("owner", "b").alias("owner")
                )
            self.merges += 1
            self._write(level + 1, merged)
            self.scratch.drop(*(n for n, _ in old))

    def known(self, keys: DataFrame) -> DataFrame:
        """``keys`` with the owner that some run holds, or null: a merge join with each run."""
        found = keys.withColumn("owner", F.lit(None).cast(keys.schema["low"].dataType))
        for level in self.levels:
            for _, run in level:
                r = run.select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.col("owner").alias("r"))
                found = found.join(r.hint("merge"), (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")), "left").select(
                    *keys.columns, F.coalesce("owner", "r").alias("owner")
                )
        return found

    def add(self, pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
        """Take a batch's ``(id, h1, h2)``; returns the ``(id, h1, h2)`` to drop."""
        batch = pairs.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        keys = scratch.save_buckets(self.known(batch), f"{name}-keys", self.KEYS, self.buckets)
        self._write(0, keys.filter("owner is null").select("h1", "h2", F.col("low").alias("owner")))
        # Read without its buckets, so that Spark may split a key that very many documents hold.
        shared = scratch.read(f"{name}-keys", keys).filter("owner is not null or low <> high").select(
            F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.coalesce("owner", "low").alias("keeper")
        )
        lost = pairs.join(shared, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))).filter("id <> keeper")
        lost = scratch.save(lost.select("id", "h1", "h2"), name)
        scratch.drop(f"{name}-keys")
        return lost


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 10, batches: int = BATCHES, runs: LineRuns | None = None
) -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced by the kept lines, and ``n_lines, n_dropped`` (long) added.

    Where ``docs`` has columns of these names already, the new ones replace
    them.  With ``runs``, lines of the documents they were made of count too,
    all of smaller ids, and the runs take this table's keys.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "lines")
    column = F.col(f"`{id}`")
    cuts = docs.agg(F.percentile_approx(column, [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    keyed = document_keys(docs, id, text, min_chars)
    keyed = scratch.save(keyed.withColumn("batch", number_of(F.col("id"), cuts)), "pairs", ["batch"])
    runs, lost = runs or LineRuns(spark, id_type=docs.schema[id].dataType.simpleString()), None
    for k in range(len(cuts) + 1):
        part = runs.add(keyed.filter(F.col("batch") == k).select("id", "h1", "h2"), scratch, f"batch-{k}")
        lost = part if lost is None else lost.unionByName(part)
    gone = lost.groupBy("id").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")).select(
        F.col("id").alias("gone_id"), F.transform("gone", lambda x: x["h1"]).alias("g1"), F.transform("gone", lambda x: x["h2"]).alias("g2")
    )
    own = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in {text, "n_lines", "n_dropped"})).alias("own"),
        column.alias("id"), F.col(f"`{text}`").cast("binary").alias("raw"),
    )
    given = own.join(gone, F.col("id") == F.col("gone_id"), "left").select("own", "raw", "g1", "g2")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, total, dropped = [], [], []
            for raw, g1, g2 in zip(raw_texts(b["raw"]), b["g1"], b["g2"], strict=True):
                lines = raw.split(b"\n")
                total.append(len(lines))
                if g1.is_valid:
                    out = np.stack([g1.values.to_numpy(), g2.values.to_numpy()], axis=1).tobytes()
                    out = {out[k : k + 16] for k in range(0, len(out), 16)}
                    lines = [x for x in lines if line_key(x, min_chars) not in out]
                dropped.append(total[-1] - len(lines))
                kept.append(b"\n".join(lines).decode())
            yield pa.RecordBatch.from_arrays(
                [b["own"], pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
                ["own", "kept", "n_lines", "n_dropped"],
            )

    long = lambda n: T.StructField(n, T.LongType())
    schema = T.StructType([given.schema["own"], T.StructField("kept", T.StringType()), long("n_lines"), long("n_dropped")])
    done = given.mapInArrow(keep, schema)
    return done.select(
        *(F.col("kept").alias(c) if c == text else F.col(f"own.`{c}`") for c in docs.columns if c not in {"n_lines", "n_dropped"}),
        "n_lines", "n_dropped",
    )


def number_of(column, cuts: list):
    """Batch of an id: how many of the ascending cuts it exceeds."""
    out = F.lit(0)
    for c in cuts:
        out = out + (column > F.lit(c)).cast("int")
    return out
