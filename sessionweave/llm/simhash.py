"""SimHash near-duplicates found with pivot distance tables.

Fingerprints are taken of word shingles, repeats included: a bit is 1 if it is
set in over half the shingles' XXH64 hashes.  Each distinct fingerprint is
compared once, whatever number of documents share it.

Pairs are looked for inside blocks of equal masked bits.  For a radius ``r``
the masks are the choices of ``m - r`` of ``m`` bit blocks, so every pair
within the radius shares a mask value (``m`` grows with the number of
fingerprints, by a cost estimate; any ``m`` is exact).  Inside a block, a table
of Hamming distances to reference fingerprints (pivots) is made; rows are
sorted by the first distance, so partners lie in a window, the maximum
coordinate difference discards pairs that cannot be within the radius, and the
survivors are verified by their own distance.  A block yields the edges of a
minimum spanning forest of its links, never all pairs; links are thereby kept
up to connectivity.  Blocks with more than ``tile`` members are cut into tiles
that are compared two by two, so no task holds an unbounded block.

Blocking on equal bits goes before the pivot tables because distances to
pivots alone cannot be joined on without comparing all pairs: distances of
unrelated fingerprints differ by less than the radius too often.

Defined results: null and empty texts have fingerprint zero and link like any
other; a null id never becomes a component id unless all ids of its component
are null; rows that repeat an id are kept and judged alike; an empty table
gives an empty result.  Other columns of the documents do not matter.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches, raw_texts, runs, whole_runs
from sessionweave.llm.components import components
from sessionweave.llm.scratch import Scratch

PIVOTS = 16
#: Pivots that are members of their block.
MEMBERS = 4
TILE = 1024
#: Shingle sets that a task compares at once.
SET_TILE = 256


def shingles(text: bytes, k: int) -> tuple[memoryview, list[int], list[int]]:
    """Joined words and the bounds of their k-word shingles; all words if they are fewer."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return memoryview(b""), [], []
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    last = max(0, len(words) - k)
    return memoryview(b" ".join(words)), starts[: last + 1].tolist(), ends[min(k, len(words)) - 1 :].tolist()


def shingle_hashes(text: bytes, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle, in text order."""
    joined, starts, ends = shingles(text, k)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)), np.uint64, len(starts))


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    """A further 64 bits of each hash; the hash itself for k = 0."""
    if not k:
        return h
    h = (h ^ np.uint64(0x9E3779B97F4A7C15 * k & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """Majority bits of the hashes, ``words`` times 64 of them, little-endian."""
    out = b""
    for k in range(words):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part = _mix(hashes[at : at + (1 << 16)], k)
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
        out += np.packbits(2 * counts > len(hashes), bitorder="little").tobytes()
    return out


def fingerprints(docs: DataFrame, id: str, text: str, k: int, words: int = 1) -> DataFrame:
    """``(id, fp)`` of each row; ``fp`` holds ``8 * words`` bytes."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(shingle_hashes(t, k), words) for t in raw_texts(b["raw"])]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(fps, pa.binary())], ["id", "fp"])

    given = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("raw"))
    schema = T.StructType([given.schema["id"], T.StructField("fp", T.BinaryType())])
    return given.mapInArrow(run, schema)


def block_masks(radius: int, n: int, bits: int = 64) -> np.ndarray:
    """Masks of which any two fingerprints within the radius share a value.

    The number of blocks is the cheapest for ``n`` fingerprints: each mask costs
    a shuffled row a fingerprint, each expected random partner a comparison.
    """

    def cost(m: int) -> float:
        masks = math.comb(m, radius)
        return masks * n * 2e-6 + masks * n * n / 2 ** (bits * (m - radius) / m) * 1.5e-8

    m = min(range(radius + 1, radius + 6), key=cost)
    edges = [round(bits * k / m) for k in range(m + 1)]
    out = []
    for chosen in itertools.combinations(range(m), m - radius):
        flags = np.zeros(bits, np.uint8)
        for c in chosen:
            flags[edges[c] : edges[c + 1]] = 1
        out.append(np.packbits(flags, bitorder="little").view(np.uint64))
    return np.array(out)


def pivot_table(words: int, pivots: int = PIVOTS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, (pivots, words), dtype=np.uint64)


def distances(fp: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.stack([np.bitwise_count(fp ^ p).sum(1, dtype=np.int16) for p in pivots], axis=1)


def links(fp: np.ndarray, ends: np.ndarray, table: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs within the radius among rows of one run, as arrays ``(i, j, distance)``.

    Rows of a run are sorted by the first column of the distance table;
    ``ends[i]`` is the end of the run of row ``i``.
    """
    i, step = np.arange(len(fp)), 1
    while True:
        i = i[i + step < ends[i]]
        i = i[table[i + step, 0] - table[i, 0] <= radius]
        if not len(i):
            return
        near = i
        for k in range(1, table.shape[1]):
            near = near[np.abs(table[near + step, k] - table[near, k]) <= radius]
        d = np.bitwise_count(fp[near] ^ fp[near + step]).sum(1, dtype=np.int16)
        ok = d <= radius
        if ok.any():
            yield near[ok], near[ok] + step, d[ok]
        step += 1


def spanning(n: int, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forest of the links, shortest first."""
    if not sum(len(x[0]) for x in found):
        none = np.zeros(0, np.int64)
        return none, none, none
    a, b, d = (np.concatenate(x) for x in zip(*found, strict=True))
    label, ka, kb, kd = np.arange(n), [], [], []
    for level in np.unique(d):
        at = d == level
        x, y = a[at], b[at]
        while True:
            lx, ly = label[x], label[y]
            open_ = lx != ly
            x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
            if not len(x):
                break
            low, high = np.minimum(lx, ly), np.maximum(lx, ly)
            # Each higher label hooks on to one lower label, which cannot close a cycle.
            order = np.lexsort((low, high))
            first = order[np.append(True, high[order][1:] != high[order][:-1])]
            ka.append(x[first]), kb.append(y[first]), kd.append(np.full(len(first), level))
            to = np.arange(n)
            to[high[first]] = low[first]
            while (to[to] != to).any():
                to = to[to]
            label = to[label]
    return np.concatenate(ka), np.concatenate(kb), np.concatenate(kd)


def near_edges(
    distinct: DataFrame, masks: np.ndarray, radius: int, scratch: Scratch, tile: int = TILE, pivot_count: int = PIVOTS
) -> DataFrame:
    """Spanning edges ``(a, b, d)`` of all links that some mask shows, from distinct ``fp``."""
    words = masks.shape[1]
    pivots = pivot_table(words, pivot_count)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                fp = np.frombuffer(b"".join(part["fp"].to_pylist()), np.uint64).reshape(-1, words)
                d0 = distances(fp, pivots[:1])[:, 0]
                value = np.zeros((len(masks), len(fp)), np.uint64)
                for k in range(words):
                    value = _mix(value ^ (fp[None, :, k] & masks[:, None, k]), 1) if words > 1 else fp[None, :, 0] & masks[:, None, 0]
                every = pa.array(np.tile(np.arange(len(fp)), len(masks)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.arange(len(masks), dtype=np.int16), len(fp))),
                        pa.array(value.reshape(-1).view(np.int64)),
                        part["fp"].take(every),
                        pa.array(np.tile(d0, len(masks))),
                    ],
                    ["c", "part", "fp", "d0"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["c", "part", "i", "j"]):
            cols = [t[k].to_numpy() for k in ("c", "part", "i", "j")]
            starts = runs(*cols)
            ends = np.repeat(starts[1:], np.diff(starts))
            raw = t["fp"].to_pylist()
            fp = np.frombuffer(b"".join(raw), np.uint64).reshape(-1, words)
            found, size, table = [], 0, distances(fp, pivots)
            for x in links(fp, ends, table, radius):
                found.append(x)
                size += len(x[0])
                if size > 1 << 21:
                    found = [spanning(len(fp), found)]
                    size = len(found[0][0])
            a, b, d = spanning(len(fp), found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[k] for k in a], pa.binary()), pa.array([raw[k] for k in b], pa.binary()), pa.array(d.astype(np.int32))],
                ["a", "b", "d"],
            )

    keyed = distinct.select("fp").mapInArrow(keys, "c smallint, part bigint, fp binary, d0 smallint")
    return tiled_blocks(keyed, scratch, tile).mapInArrow(compare, "a binary, b binary, d int")


def tiled_blocks(keyed: DataFrame, scratch: Scratch, tile: int) -> DataFrame:
    """Rows ``(c, part, fp, d0)`` as runs ``(c, part, i, j)`` sorted by ``d0``: a block, or two tiles of one with over ``tile`` rows."""
    big = keyed.groupBy("c", "part").count().filter(F.col("count") > tile)
    big = scratch.save(big.select("c", "part", F.ceil(F.col("count") / tile).cast("int").alias("cuts")), "big")
    joined = keyed.join(big, ["c", "part"], "left") if not big.isEmpty() else keyed.withColumn("cuts", F.lit(None).cast("int"))
    own = F.coalesce(F.expr("cast(pmod(xxhash64(fp), cuts) as int)"), F.lit(0))
    others = F.sequence(F.lit(0), F.coalesce("cuts", F.lit(1)) - 1)
    tiled = joined.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "c", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "d0"
    )
    return tiled.repartition("c", "part", "i", "j").sortWithinPartitions("c", "part", "i", "j", "d0")


def group_documents(prints: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, fp, component_id)`` of each row of ``prints``; edges link fingerprints."""
    firsts = scratch.save(prints.groupBy("fp").agg(F.min("id").alias("low")), "firsts")
    stars = scratch.save(components(edges.select("a", "b"), scratch), "stars")
    members = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
    placed = members.join(firsts, members["node"] == firsts["fp"]).select("fp", "root", "low")
    lows = scratch.save(placed.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    of_members = scratch.save(
        placed.join(lows.withColumnRenamed("root", "r"), F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id"), "members"
    )
    ids = firsts.join(of_members, F.col("fp") == F.col("f"), "left").select(
        F.col("fp").alias("f"), F.coalesce("component_id", "low").alias("component_id")
    )
    ids = scratch.save(ids, "ids")
    return prints.join(ids, F.col("fp") == F.col("f"), "left").select("id", "fp", "component_id")


def hex_print(fp):
    """16 lowercase hex digits of a little-endian 64-bit fingerprint."""
    digits = F.lower(F.hex(fp))
    return F.concat(*(F.substring(digits, k, 2) for k in range(15, 0, -2)))


def near_components(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 4, radius: int = 4) -> DataFrame:
    """``(id, fingerprint, component_id)``: documents whose 64-bit fingerprints chain within the radius."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.save(fingerprints(docs, id, text, k), "prints")
    distinct = scratch.save(prints.select("fp").distinct(), "distinct")
    edges = scratch.save(near_edges(distinct, block_masks(radius, distinct.count()), radius, scratch), "edges")
    return group_documents(prints, edges, scratch).select(
        F.col("id").alias(id), hex_print(F.col("fp")).alias("fingerprint"), "component_id"
    )


def reach(similarity: float, bits: int, missed: float = 1e-9) -> int:
    """A Hamming distance that fingerprints of two sets at the threshold exceed with a chance below ``missed``.

    Bits are independent.  The chance that one differs is counted for all pairs
    of small sets at the threshold (with up to 64 common members) and is at its
    highest there; it falls to ``acos(2 s / (1 + s)) / pi`` for large ones.
    """

    def share(n: int) -> np.ndarray:
        return np.array([math.comb(n, k) for k in range(n + 1)], float) / 2.0**n

    def differs(common: int, a: int, b: int) -> float:
        c = np.arange(common + 1)[:, None]
        x, y = (((2 * (c + np.arange(m + 1)) > common + m) * share(m)).sum(1) for m in (a, b))
        return float((share(common) * (x * (1 - y) + y * (1 - x))).sum())

    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    for common in range(1, 65):
        most = min(64, math.floor(common * (1 / similarity - 1) + 1e-9))
        p = max([p, *(differs(common, a, b) for a in range(most + 1) for b in range(min(a, most - a) + 1))])
    distance, beyond = bits, 0.0
    while distance > 0:
        beyond += math.comb(bits, distance) * p**distance * (1 - p) ** (bits - distance)
        if beyond > missed:
            break
        distance -= 1
    return distance


def member_table(fp: np.ndarray, starts: np.ndarray, pivots: int) -> np.ndarray:
    """Hamming distances of each row to ``pivots`` members of its own run."""
    size = np.diff(starts)
    at = [np.repeat(starts[:-1] + (2 * k + 1) * size // (2 * pivots), size) for k in range(pivots)]
    return np.stack([np.bitwise_count(fp ^ fp[x]).sum(1, dtype=np.int16) for x in at], axis=1)


def print_nodes(fp: np.ndarray) -> np.ndarray:
    """64 bits that stand for each fingerprint."""
    value = np.zeros(len(fp), np.uint64)
    for k in range(fp.shape[1]):
        value = _mix(value ^ fp[:, k], 1)
    return value.view(np.int64)


def print_edges(keyed: DataFrame, words: int, radius: int, scratch: Scratch, tile: int = TILE, pivots: int = MEMBERS) -> DataFrame:
    """Spanning edges ``(a, b)`` of all links inside blocks ``(c, part)``, between the nodes of fingerprints.

    At a wide radius distances to random pivots discard nothing.  Here the
    pivots are members of the block: what is near one cannot be near what is
    far from it.  A block that lies within the radius of its first pivot is
    one group, and costs one comparison a member.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["c", "part", "i", "j"]):
            starts = runs(*(t[k].to_numpy() for k in ("c", "part", "i", "j")))
            size = np.diff(starts)
            fp = np.frombuffer(b"".join(t["fp"].to_pylist()), np.uint64).reshape(-1, words)[np.repeat(size > 1, size)]
            size = size[size > 1]
            if not len(size):
                continue
            starts = np.append(0, np.cumsum(size))
            table = member_table(fp, starts, pivots)
            order = np.lexsort((table[:, 0], np.repeat(np.arange(len(size)), size)))
            fp, table = fp[order], table[order]
            pivot, near = np.repeat(starts[:-1], size), table[:, 0] <= radius  # the pivot is now the first of its run
            star = np.flatnonzero(near & (np.arange(len(fp)) != pivot))
            found, many = [(pivot[star], star, table[star, 0])], len(star)
            whole = np.repeat(np.logical_and.reduceat(near, starts[:-1]), size)
            for x in links(fp, np.where(whole, 0, np.repeat(starts[1:], size)), table, radius):
                found.append(x)
                many += len(x[0])
                if many > 1 << 21:
                    found = [spanning(len(fp), found)]
                    many = len(found[0][0])
            a, b, _ = spanning(len(fp), found)
            node = print_nodes(fp)
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    return tiled_blocks(keyed, scratch, tile).mapInArrow(compare, "a bigint, b bigint")


def near_prints(given: DataFrame, k: int, similarity: float, words: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(id, key, g, n, node, fp)`` of each row, the same of each set with its lowest id, and groups ``(node, root)`` of near fingerprints, roots excluded.

    ``key`` and ``g`` are hashes of the set of shingles, ``fp`` is its SimHash
    and ``node`` a hash of that.  Fingerprints are compared inside
    blocks of an equal rare shingle, which any two sets at the threshold share.
    """

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(shingle_hashes(t, k)) for t in raw_texts(b["raw"])]
            keys = [xxhash.xxh3_128_digest(x.tobytes()) for x in found]
            fps = [fingerprint(x, words) for x in found]
            nodes = print_nodes(np.frombuffer(b"".join(fps), np.uint64).reshape(-1, words))
            columns = [
                b["id"], pa.array(keys, pa.binary()), pa.array([_short(x) for x in keys], pa.int64()), pa.array([len(x) for x in found], pa.int32()),
                pa.array(nodes), pa.array(fps, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "g", "n", "node", "fp"])

    schema = T.StructType([given.schema["id"], *T.StructType.fromDDL("key binary, g bigint, n int, node bigint, fp binary")])
    prints = scratch.save(given.mapInArrow(sized, schema), "prints")
    rare = scratch.save(rare_shingles(given, prints, k, similarity), "rare")
    lowest = scratch.save(prints.groupBy("key", "g", "node", "fp").agg(F.min("id").alias("low")), "lowest")
    keyed = rare.join(lowest.select(F.col("g").alias("of"), "fp"), F.col("g") == F.col("of"))
    keyed = scratch.save(keyed.select(F.expr("0s as c"), F.col("h").alias("part"), "fp", F.expr("0s as d0")), "blocks")
    edges = print_edges(keyed, words, reach(similarity, 64 * words), scratch)
    return prints, lowest, scratch.save(components(edges, scratch, "candidates"), "candidates")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, similarity: float = 0.8, words: int = 8
) -> DataFrame:
    """``(id, component_id)`` of rows with an id: texts chained by a Jaccard similarity of their shingles at or above the threshold.

    Texts are equal if their whole shingle sets are (by a hash of 128 bits).
    Each set has a SimHash of ``64 * words`` bits.  Fingerprints within the
    radius that sets at the threshold keep to are found with pivot distance
    tables, in blocks of an equal rare shingle; sets are compared only where
    fingerprints chain them (or are equal), pair by pair, tile by tile, and
    only true links make groups.  So fingerprints find and the sets decide.

    Exact, up to equal 64-bit hashes of different shingles and a chance below
    1e-9 that fingerprints of a pair at the threshold lie beyond the radius.
    """
    scratch = Scratch(docs.sparkSession, "near")
    bound_batches(docs.sparkSession)
    given = docs.filter(F.col(f"`{id}`").isNotNull()).select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("raw"))
    prints, lowest, stars = near_prints(given, k, similarity, words, scratch)
    lowest = lowest.select(F.col("key").alias("fp"), F.col("node").alias("of"), "low")
    placed = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
    equal = lowest.groupBy("of").count().filter("count > 1").select(F.col("of").alias("node"))
    nodes = placed.unionByName(equal.join(placed, "node", "left_anti").withColumn("root", F.col("node")))
    wanted = scratch.save(nodes.join(lowest, F.col("node") == F.col("of")).select("fp", "low", F.col("root").alias("c")), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(shingle_hashes(t, k)).tobytes() for t in raw_texts(b["raw"])]
            keys = pa.array([xxhash.xxh3_128_digest(x) for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.binary())], ["f", "s"])

    texts = given.join(wanted.select("low").distinct(), F.col("id") == F.col("low")).select("raw")
    shingled = texts.mapInArrow(sets, "f binary, s binary").dropDuplicates(["f"])
    shingled = scratch.save(shingled.join(wanted, F.col("f") == F.col("fp")).select("c", "fp", "s"), "sets")
    edges = scratch.save(similar_edges(shingled, similarity, scratch), "edges")
    return group_documents(prints.select("id", F.col("key").alias("fp")), edges, scratch).select(F.col("id").alias(id), "component_id")


def _short(key: bytes) -> int:
    """The first 64 bits of a set's hash."""
    return int.from_bytes(key[:8], "little", signed=True)


def rare_shingles(given: DataFrame, prints: DataFrame, k: int, similarity: float) -> DataFrame:
    """``(g, h)``: the shared ones of each set's rarest shingles, of which two sets at the threshold have one in common.

    Sets at the threshold share ``similarity * n`` shingles of either at least.
    In one order of all shingles, by the number of sets that hold them and by
    hash, the first ``n - ceil(similarity * n) + 1`` of each therefore meet.
    Shingles of one set alone come first and meet nothing.
    """
    total = prints.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    buckets = max(64, total >> 18)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                found = [np.unique(shingle_hashes(t, k)) for t in raw_texts(b.slice(at, 4096)["raw"])]
                if not sum(map(len, found)):
                    continue
                g = np.array([_short(xxhash.xxh3_128_digest(x.tobytes())) for x in found], np.int64)
                n = np.array([len(x) for x in found], np.int32)
                h, own = np.concatenate(found), np.repeat(np.arange(len(n), dtype=np.uint16), n)
                part = (h % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                h, own, part = h[order], own[order], part[order]
                starts = runs(part)
                rows = []
                for s, e in itertools.pairwise(starts):
                    who, which = np.unique(own[s:e], return_inverse=True)
                    rows.append((part[s], h[s:e].tobytes(), which.astype(np.uint16).tobytes(), g[who].tobytes(), n[who].tobytes()))
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "h", "which", "g", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["part"]):
            rows = [t[x].to_pylist() for x in ("h", "which", "g", "n")]
            for s, e in itertools.pairwise(runs(t["part"].to_numpy())):
                h, g, n = [], [], []
                for x, which, of, size in zip(*(r[s:e] for r in rows), strict=True):
                    which = np.frombuffer(which, np.uint16)
                    h.append(np.frombuffer(x, np.int64)), g.append(np.frombuffer(of, np.int64)[which]), n.append(np.frombuffer(size, np.int32)[which])
                h, g, n = np.concatenate(h), np.concatenate(g), np.concatenate(n)
                order = np.argsort(h, kind="stable")
                size = np.diff(runs(h[order]))
                order = order[np.repeat(size > 1, size)]
                order = order[np.lexsort((g[order], h[order]))]
                h, g, n = h[order], g[order], n[order]
                first = runs(h, g)[:-1]  # equal sets count once
                h, g, n = h[first], g[first], n[first]
                size = np.diff(runs(h))
                held = np.repeat(size, size)
                some = held > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[some]), pa.array(held[some].astype(np.int64)), pa.array(h[some]), pa.array(n[some])], ["g", "held", "h", "n"]
                )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["g"]):
            g, n = t["g"].to_numpy(), t["n"].to_numpy().astype(np.int64)
            starts = runs(g)
            shared = np.diff(starts)
            size = n[starts[:-1]]
            prefix = size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1
            place = np.arange(len(g)) - np.repeat(starts[:-1], shared)
            keep = place < np.repeat(prefix - (size - shared), shared)
            yield pa.RecordBatch.from_arrays([pa.array(g[keep]), pa.array(t["h"].to_numpy()[keep])], ["g", "h"])

    dealt = given.select("raw").mapInArrow(deal, "part int, h binary, which binary, g binary, n binary").repartition("part").sortWithinPartitions("part")
    counted = dealt.mapInArrow(count, "g bigint, held bigint, h bigint, n int")
    return counted.repartition("g").sortWithinPartitions("g", "held", "h").mapInArrow(choose, "g bigint, h bigint")


def similar_edges(sets: DataFrame, similarity: float, scratch: Scratch, tile: int = SET_TILE, tile_bytes: int = 1 << 24) -> DataFrame:
    """Spanning edges ``(a, b)`` of all pairs at the threshold among sets ``(c, fp, s)`` with the same ``c``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["c", "i", "j"]):
            raw, found = t["fp"].to_pylist(), [np.frombuffer(x, np.uint64) for x in t["s"].to_pylist()]
            a, b = [], []
            for s, e in itertools.pairwise(runs(*(t[x].to_numpy() for x in ("c", "i", "j")))):
                for x, y in similar_pairs(found[s:e], similarity):
                    a.append(raw[s + x]), b.append(raw[s + y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    cuts = F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum(F.length("s")) / tile_bytes)).cast("int").alias("cuts")
    sizes = scratch.save(sets.groupBy("c").agg(F.count("*").alias("members"), cuts).filter("members > 1"), "sizes")
    joined = sets.join(sizes.withColumnRenamed("c", "of"), F.col("c") == F.col("of"))
    tiled = joined.withColumn("own", F.expr("cast(pmod(xxhash64(fp), cuts) as int)")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    tiled = tiled.select("c", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "s")
    return tiled.repartition("c", "i", "j").sortWithinPartitions("c", "i", "j").mapInArrow(compare, "a binary, b binary")


def similar_pairs(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Spanning pairs of all at the threshold: each set's overlaps with all others are counted by a table of who holds a shingle."""
    n = np.array([len(x) for x in sets])
    shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(shingle, kind="stable")
    holder, starts = np.repeat(np.arange(len(n)), n)[order], runs(shingle[order])
    own, label = np.append(0, np.cumsum(n)), np.arange(len(n))
    for x in range(len(n) - 1):
        if (label[x + 1 :] == label[x]).all():
            continue
        mine = shingle[own[x] : own[x + 1]]
        low, size = starts[mine], starts[mine + 1] - starts[mine]
        at = np.arange(size.sum()) + np.repeat(low - np.append(0, np.cumsum(size)[:-1]), size)
        both = np.bincount(holder[at], minlength=len(n))
        linked = both >= similarity * (n[x] + n - both) - 1e-9
        for y in np.flatnonzero(linked & (label != label[x])):
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                yield x, int(y)
