"""Benchmark decontamination by SimHash of item-sized windows.

Words are runs of letters, digits and underscores, lower-cased; shingles take
five words (all words of a shorter item) and weigh as often as they stand in a
text.  For each length of a benchmark item, windows of that many words slide
over every document (a shorter document is one window).  A window's SimHash is
looked up in a multi-index: fingerprints are cut into ``BLOCKS`` blocks, and
the index holds each block value of each item; block values of the window are
tried with up to ``RADIUS // BLOCKS`` bits flipped, so every item fingerprint
within ``RADIUS`` bits of the window's is found.  Candidates are verified by
the exact weighted Jaccard similarity of their shingles.

Windows that cannot reach the threshold are skipped before they are hashed:
a similarity of ``s`` needs at least ``s`` times the item's shingles among the
window's, and that bound is checked by a running count of benchmark shingles.

The radius is wide: at a similarity of 0.8 the distance is 9.7 of 64 bits on
average with a deviation of 2.9, for items of any length (simulated for 1 to 200
shingles: beyond the radius in 3 of 10,000 pairs at the threshold itself, and
fewer above it).  Items go in passes of ``PASS_BYTES`` of text at most; a pass's
index is built once on the driver and broadcast as NumPy arrays.  The documents
are read once a pass and never shuffled.

Defined results: null or empty items and texts match nothing; null ids are
carried; rows that repeat a document or an item give rows of their own; empty
tables give an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches
from sessionweave.llm.simhash import fingerprint
from sessionweave.llm.substring import rolling

WORD = re.compile(r"\w+")
#: Characters beyond ASCII that are not of a word.
OTHER = re.compile(r"[^\w\x00-\x7f]")
SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 20, 7
#: Text of the items of one pass, of which an index is broadcast; bytes of the bit table of windows in work at once.
PASS_BYTES, PART_BYTES = 4 << 20, 8 << 20
#: Bits of the table that sieves shingles before the exact lookup.
SIEVE = 20


#: ASCII bytes that are not of a word become spaces.
GAPS = bytes(b if b >= 128 or chr(b).isalnum() or b == 95 else 32 for b in range(256))


def words(text: str | None) -> np.ndarray:
    """Hash of each word."""
    low = (text or "").lower()
    if not low.isascii() and OTHER.search(low):
        found = [w.encode() for w in WORD.findall(low)]
    else:  # the same words, cut at ASCII bytes
        found = low.encode().translate(GAPS).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def flips(width: int) -> np.ndarray:
    """Every choice of at most ``RADIUS // BLOCKS`` of so many bits."""
    return np.array([sum(1 << f for f in c) for n in range(RADIUS // BLOCKS + 1) for c in itertools.combinations(range(width), n)], np.int64)


class Index:
    """Items by length with a multi-index of their fingerprints: NumPy arrays alone, about twice the size of the items.

    Every item has one entry a block of its fingerprint's bits.  Fingerprints
    within the radius differ in at most ``RADIUS // BLOCKS`` bits of some block,
    so a window looks up its own block values with that many bits flipped.
    """

    def __init__(self, texts: list[str | None], threshold: float, shingle: int):
        self.threshold, self.shingle = threshold, shingle
        self.edges = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
        bags = [(h, rolling(h, min(shingle, len(h)))) for h in map(words, texts) if len(h)]
        self.of = np.array([i for i, t in enumerate(texts) if len(words(t))], np.int64)  # place of each item among the texts
        each = [np.unique(s, return_counts=True) for _, s in bags]
        self.starts = np.append(0, np.cumsum([len(v) for v, _ in each])).astype(np.int64)
        self.values = np.concatenate([np.zeros(0, np.uint64), *(v for v, _ in each)])
        self.counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in each)])
        self.prints = np.array([int.from_bytes(fingerprint(s), "little") for _, s in bags], np.uint64)
        length = np.array([len(h) for h, _ in bags], np.int64)
        self.lengths = np.unique(length).tolist()
        keys = np.concatenate([np.zeros(0, np.int64), *(self._key(length, b, self._value(self.prints, b)) for b in range(BLOCKS))])
        order = np.argsort(keys, kind="stable")
        self.items = np.tile(np.arange(len(bags), dtype=np.int32), BLOCKS)[order]
        self.keys, first = np.unique(keys[order], return_index=True)
        self.low, self.high = first, np.append(first[1:], len(keys))
        near = [flips(self.edges[b + 1] - self.edges[b]) for b in range(BLOCKS)]
        self.near = np.zeros((BLOCKS, max(map(len, near))), np.int64)  # filled up with no flip at all
        for b, f in enumerate(near):
            self.near[b, : len(f)] = f
        self.known = np.unique(self.values)
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[self.known & np.uint64((1 << SIEVE) - 1)] = True

    @classmethod
    def made_of(cls, state: dict) -> Index:
        out = cls.__new__(cls)
        vars(out).update(state)
        return out

    def _value(self, prints: np.ndarray, block: int) -> np.ndarray:
        width = self.edges[block + 1] - self.edges[block]
        return (prints >> np.uint64(self.edges[block]) & np.uint64((1 << width) - 1)).astype(np.int64)

    @staticmethod
    def _key(length, block, value):
        return (length * BLOCKS + block) * 1024 + value

    def _candidates(self, prints: np.ndarray, length: int) -> np.ndarray:
        """Pairs (window, item) within the radius."""
        block = np.arange(BLOCKS)
        value = np.stack([self._value(prints, b) for b in block], axis=1)
        key = self._key(length, block[:, None], value[:, :, None] ^ self.near).reshape(-1)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[place] == key)
        low, n = self.low[place[hit]], self.high[place[hit]] - self.low[place[hit]]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        window = np.repeat(hit // self.near.size, n)
        pairs = np.unique(np.stack([window, self.items[at]], axis=1), axis=0)
        return pairs[np.bitwise_count(prints[pairs[:, 0]] ^ self.prints[pairs[:, 1]]) <= RADIUS]

    def _similarity(self, bag: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's shingles and an item's."""
        own, count = np.unique(bag, return_counts=True)
        s = slice(self.starts[item], self.starts[item + 1])
        place = np.minimum(np.searchsorted(self.values[s], own), s.stop - s.start - 1)
        both = int(np.minimum(count, self.counts[s][place])[self.values[s][place] == own].sum())
        return both / (len(bag) + int(self.counts[s].sum()) - both)

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """``(item, first word, words, similarity)`` of the best window of each item that the text holds."""
        h = words(text)
        best: dict[int, tuple[int, int, float]] = {}
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in self.lengths:
            k = min(self.shingle, length)
            if len(h) < k:
                continue
            if k not in sums:
                s = rolling(h, k)
                member = self.sieve[s & np.uint64((1 << SIEVE) - 1)]
                at = np.flatnonzero(member)
                place = np.minimum(np.searchsorted(self.known, s[at]), len(self.known) - 1)
                member[at] = self.known[place] == s[at]
                sums[k] = s, np.append(0, np.cumsum(member))
            s, total = sums[k]
            if not total[-1]:
                continue
            size = min(length, len(h))
            count = total[size - k + 1 :] - total[: len(total) - (size - k + 1)]
            starts = np.flatnonzero(count >= self.threshold * (length - k + 1) - 1e-9)
            rows = max(1, PART_BYTES // (64 * (size - k + 1)))
            for part in (starts[at : at + rows] for at in range(0, len(starts), rows)):
                bags = s[part[:, None] + np.arange(size - k + 1)]
                bits = np.unpackbits(bags.view(np.uint8).reshape(len(part), -1, 8), axis=2, bitorder="little").sum(1, dtype=np.int32)
                prints = np.packbits(2 * bits > bags.shape[1], axis=1, bitorder="little").view(np.uint64)[:, 0]
                for w, i in self._candidates(prints, length).tolist():
                    x, item = self._similarity(bags[w], i), int(self.of[i])
                    if x >= self.threshold and x > best.get(item, (0, 0, 0.0))[2]:
                        best[item] = (int(part[w]), size, x)
        return [(i, *x) for i, x in sorted(best.items())]


def _passes(benchmark: DataFrame, item: str, item_text: str, threshold: float, shingle: int) -> Iterator[tuple[pa.Array, dict]]:
    """Items in passes of bounded size: names, and the arrays of an index built once."""
    items = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    for p in range(passes):
        some = items if passes == 1 else items.filter(F.expr(f"pmod(xxhash64(item, text), {passes}) = {p}"))
        table = some.toArrow()
        names = table["item"].combine_chunks() if table.num_rows else pa.array([], table.schema.field("item").type)
        yield names, vars(Index(table["text"].to_pylist(), threshold, shingle))


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    threshold: float = SIMILARITY, shingle: int = SHINGLE,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; nothing is joined or shuffled."""
    bound_batches(docs.sparkSession)
    out = docs
    for _, made in _passes(benchmark, item, item_text, threshold, shingle):
        shared = docs.sparkSession.sparkContext.broadcast(made)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index.made_of(shared.value)
            for b in batches:
                yield b.select(["own"]).filter(pa.array([not index.matches(t) for t in b["text"].to_pylist()], pa.bool_()))

        own = out.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own"), F.col(f"`{text}`").alias("text"))
        out = own.mapInArrow(run, T.StructType([own.schema["own"]])).select("own.*")
    return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    threshold: float = SIMILARITY, shingle: int = SHINGLE,
) -> DataFrame:
    """``(id, item, start_word, n_words, similarity)`` of the best window of each item in each document that holds one."""
    spark = docs.sparkSession
    bound_batches(spark)
    given = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    out = None
    for names_index in _passes(benchmark, item, item_text, threshold, shingle):
        shared = spark.sparkContext.broadcast(names_index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, index = shared.value[0], Index.made_of(shared.value[1])
            for b in batches:
                rows = [(k, *m) for k, t in enumerate(b["text"].to_pylist()) for m in index.matches(t)]
                col = lambda n, kind: pa.array([r[n] for r in rows], kind)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [b["id"].take(col(0, pa.int64())), names.take(col(1, pa.int64())), col(2, pa.int64()), col(3, pa.int64()), col(4, pa.float64())],
                    ["id", "item", "start_word", "n_words", "similarity"],
                )

        schema = T.StructType(
            [given.schema["id"], T.StructField("item", benchmark.schema[item].dataType), T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType())]
        )
        part = given.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": id, "item": item})
