"""Best-fit-decreasing packing of token sequences, certified by lower bounds.

Documents are tokenized once; those longer than a sequence are cut into full
pieces, of which the first may be shorter.  Shorter pieces are dealt evenly to
partitions, each packs its own by best-fit decreasing, and dual-feasible
functions bound from below how many sequences any packing of them needs.
While the total is above the bound of all pieces together, partitions with a
gap to their bound exchange the documents of their sequences that are not full,
which are packed anew.  Rounds go on as long as they save sequences; one that
saves none is undone and is the last, as are one that meets the bound, one of a
single partition (nobody is left to exchange with) and the ``rounds``-th.

Scale: a partition holds ``partition_items`` pieces on average, dealt by hash,
whatever their source; only piece lengths (a histogram of at most ``capacity``
rows) go to the driver.

Defined results: a null text is empty and has its end token alone; rows that
repeat an id are packed as documents of their own; an empty table gives an
empty result; ids may be null.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches, whole_runs
from sessionweave.llm.scratch import Scratch
from sessionweave.llm.tokens import Encoder

#: Vocabulary files are sent to executors up to this size.
FILE_BYTES = 64 << 20
ROUNDS = 32


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id: str, text: str) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` of each document."""
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer, "rb") as f:
        file = f.read(FILE_BYTES + 1)
    if len(file) > FILE_BYTES:
        raise ValueError(f"{tokenizer} has more than {FILE_BYTES} bytes")
    shared = spark.sparkContext.broadcast(file)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for b in batches:
            rows, out = [], ([], [], [], [])
            for k, data in enumerate(encoder.encode_batch([t or "" for t in b["text"].to_pylist()])):
                ids = memoryview(data + end)
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n % capacity or capacity) if not start else capacity
                    rows.append(k)
                    for x, v in zip(out, (piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                        x.append(v)
                    start, piece = start + length, piece + 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["id"].take(pa.array(rows, pa.int64())), *(pa.array(x, kind) for x, kind in zip(out, kinds, strict=True))],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    given = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([given.schema["id"], T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32"))])
    return given.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, which must be descending, and room left by bin."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room
    rooms = 0  # bit r: some bin has room r
    for k, n in enumerate(lengths.tolist()):
        fit = rooms >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            at = open_[r].pop()
            if not open_[r]:
                rooms ^= 1 << r
        else:
            at, r = len(room), capacity
            room.append(capacity)
        bins[k], offsets[k] = at, capacity - r
        room[at] = r - n
        if r > n:
            open_[r - n].append(at)
            rooms |= 1 << (r - n)
    return bins, offsets, np.array(room, np.int64)


def lower_bound(count: np.ndarray) -> Fraction:
    """Bound (round it up) on the sequences of any packing of ``count[n]`` pieces of length ``n``; ``len(count) - 1`` is the capacity."""
    c = len(count) - 1
    x = np.arange(c + 1, dtype=np.int64)
    total = int((x * count).sum())
    best = Fraction(total, c)
    used = np.flatnonzero(count)
    for e in {int(n) for n in used if 2 * n <= c} | {int(c - n) for n in used if 2 * n > c}:
        # Longer than c - e: a whole sequence; shorter than e: nothing.
        value = np.where(x > c - e, c, np.where(x < e, 0, x))
        best = max(best, Fraction(int((value * count).sum()), c))
    for k in range(1, 64):
        # Rounded down to multiples of c / k, but for exact multiples of c / (k + 1); times k to stay whole.
        value = np.where((k + 1) * x % c == 0, x * k, (k + 1) * x // c * c)
        best = max(best, Fraction(int((value * count).sum()), k * c))
    return best


def pack(
    items: DataFrame, capacity: int, scratch: Scratch, partition_items: int, rounds: int = ROUNDS, report: dict | None = None
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces ``(..., length, uid)`` shorter than the capacity.

    ``report`` takes the number of sequences, the bound, the rounds and why they ended.
    """
    names = items.columns
    settled, pool, loose_before, why = None, items, None, "empty"
    total, bound, before, round_ = 0, None, 0, -1
    for round_ in range(rounds):
        sizes = np.zeros(capacity + 1, np.int64)
        for n, c in pool.groupBy("length").count().collect():  # one row a length
            sizes[n] = c
        if not sizes.sum():
            break
        bound = math.ceil(lower_bound(sizes)) if bound is None else bound
        parts = max(1, round(int(sizes.sum()) / partition_items))
        base = round_ << 56

        def run(batches: Iterator[pa.RecordBatch], base: int = base) -> Iterator[pa.RecordBatch]:
            for t in whole_runs(batches, ["part"]):
                part = t["part"].to_numpy()
                edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    own = t.slice(a, b - a)
                    length = own["length"].to_numpy()
                    order = np.lexsort((own["uid"].to_numpy(), -length))
                    bins, offsets, room = best_fit(length[order], capacity)
                    # The bound is not rounded up here: partitions' last sequences can be joined with one another.
                    certified = len(room) <= lower_bound(np.bincount(length, minlength=capacity + 1))
                    loose = (room[bins] > 0) & (not certified)
                    own = own.take(pa.array(order)).combine_chunks()
                    cols = [own[n].combine_chunks() for n in names]
                    yield pa.RecordBatch.from_arrays(
                        [*cols, pa.array(base + (int(part[a]) << 32) + bins), pa.array(offsets), pa.array(loose)],
                        [*names, "sequence_id", "offset", "loose"],
                    )

        dealt = pool.withColumn("part", F.expr(f"pmod(xxhash64(uid, {round_}), {parts})"))
        dealt = dealt.repartition(parts, "part").sortWithinPartitions("part")
        schema = T.StructType(
            [*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("loose", T.BooleanType())]
        )
        done = scratch.save(dealt.mapInArrow(run, schema), f"round-{round_}")
        used = done.filter("offset = 0").count()
        if round_ and used >= before:  # nothing saved: the sequences of the round before stay
            settled, why = settled.unionByName(loose_before), "nothing saved"
            break
        total += used - before
        ends = {"bound met": total <= bound, "one partition": parts == 1, "last round": round_ + 1 == rounds}
        if any(ends.values()):
            settled = done if settled is None else settled.unionByName(done)
            why = next(k for k, v in ends.items() if v)
            break
        firm, loose_before = done.filter("not loose"), done.filter("loose")
        settled = firm if settled is None else settled.unionByName(firm)
        pool, before = loose_before.select(*names), loose_before.filter("offset = 0").count()
    if report is not None:
        report |= {"sequences": total, "bound": bound or 0, "rounds": round_ + 1, "ended": why}
    out = settled if settled is not None else items.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    return out.select(*names, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id: str = "doc_id", text: str = "text", partition_items: int = 50_000,
    rounds: int = ROUNDS, report: dict | None = None,
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of each piece; ``report`` is of those that are not full."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.save(pieces(docs, tokenizer, capacity, end_id, id, text), "pieces").withColumn("uid", F.monotonically_increasing_id())
    full = cut.filter(F.col("length") == capacity).select(
        *cut.columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    packed = pack(cut.filter(F.col("length") < capacity), capacity, scratch, partition_items, rounds, report)
    return full.unionByName(packed).select(F.col("id").alias(id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
