"""Removal of passages of ``window`` words that occur more than once.

A word goes if some run of ``window`` consecutive words around it also starts
at another place, in the same document or in any other.

Suffix automata of reference shards decide this.  Streaming every document
through the automata of all shards, broadcast one after the other, would cost
the product of shards and documents; so shards are formed of what can match at
all, and what is to be streamed is sent to its shard.  Every window is
represented by the smallest hash of its ``gram``-word sequences, its anchor,
which equal windows share; neighbouring windows with one anchor form a context.
Anchors that occur once hold no repeated window.  All other contexts are
spelled out in words, once each, and those of one anchor are a shard: one
automaton over them, through which they are streamed for matching statistics;
windows whose words have a second end position are repeated.

An anchor with more than ``shard`` different contexts (a passage in a third of
all documents, cut off by other words each time) would make an automaton
without bound.  Its windows are routed one by one, by the hash of all their
words instead of the anchor's, to as many small shards, where the same automata
decide.  Hashes only route: equality is always that of words in an automaton.
(A context is told by 128 bits of hashes, its anchor's and its own.)

Defined results: a null or empty text has no words; documents shorter than the
window stay; rows that repeat a document are occurrences like any other; ids
may be null; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches, raw_texts, runs, whole_runs
from sessionweave.llm.scratch import Scratch

GRAM, SHARD = 6, 256
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` items, by doubling."""
    n, out, at, part, size = len(h) - k + 1, None, 0, h, 1
    while True:
        if k & size:
            own = part[at : at + n]
            out = own if out is None else mix(out * ODD + own)
            at += size
        if 2 * size > k:
            return mix(out + np.uint64(k))
        part = mix(part[:-size] * ODD + part[size:])
        size *= 2


def first_smallest(v: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each run of ``width``."""
    at, size = np.arange(len(v)), 1
    while size < width:
        step = min(size, width - size)
        a, b = at[:-step], at[step:]
        at = np.where(v[a] <= v[b], a, b)
        size += step
    return at


def contexts(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window, number of windows, and hash of the words of each context."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    grams = rolling(h, gram)
    anchor = first_smallest(grams, window - gram + 1)
    low = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    count = np.diff(np.append(low, len(anchor)))
    # A context is told by its windows in order: by a hash over their hashes.
    each = rolling(h, window) * (2 * np.arange(len(anchor), dtype=np.uint64) - 2 * np.repeat(low, count).astype(np.uint64) + np.uint64(1))
    whole = mix(np.add.reduceat(mix(each), low) + count.astype(np.uint64))
    return grams[anchor[low]], low, count, whole


class Automaton:
    """Suffix automaton over several word sequences, with the number of end positions of each state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.ends = [-1], [0], [0]

    def add(self, words: list, weight: int) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w, weight)

    def _state(self, length: int, ends: int, nxt: dict, link: int) -> int:
        self.length.append(length), self.ends.append(ends), self.next.append(nxt), self.link.append(link)
        return len(self.length) - 1

    def _clone(self, p: int, q: int, w) -> int:
        c = self._state(self.length[p] + 1, 0, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, w, weight: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # known from an earlier sequence
            if self.length[q] != self.length[last] + 1:
                q = self._clone(last, q, w)
            self.ends[q] += weight
            return q
        new = self._state(self.length[last] + 1, weight, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return new

    def close(self) -> None:
        """Carry end positions up to shorter suffixes."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.ends[self.link[s]] += self.ends[s]

    def repeated(self, words: list, window: int) -> list[int]:
        """Starts of the windows that end in two places at least."""
        out, s, matched = [], 0, 0
        for k, w in enumerate(words):
            while s and w not in self.next[s]:
                s = self.link[s]
                matched = self.length[s]
            if w in self.next[s]:
                s, matched = self.next[s][w], matched + 1
            while self.length[self.link[s]] >= window if s else False:
                s = self.link[s]
                matched = self.length[s]
            if matched >= window and self.ends[s] > 1:
                out.append(k - window + 1)
        return out


def stretches(starts: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as ``(first, how many)`` of consecutive ones."""
    out: list[tuple[int, int]] = []
    for k in starts:
        if out and out[-1][0] + out[-1][1] == k:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((k, 1))
    return out


def dedup_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 35, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``(id, n_words, n_removed, kept)``; ``kept`` joins the words that stay by single spaces.

    Any ``window`` will do; ``gram`` is cut down to it, ``shard`` bounds the
    contexts of one automaton.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch, gram = Scratch(spark, "passages"), min(gram, window)
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    given = docs.select(F.col(f"`{id}`").alias("id"), raw.alias("raw")).withColumn("t1", F.xxhash64("raw")).withColumn("t2", F.hash("raw"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, key, low, count, whole = [], [], [], [], []
            for k, t in enumerate(raw_texts(b["raw"])):
                words = t.split()
                if len(words) >= window:
                    found = contexts(words, window, gram)
                    of.append(np.full(len(found[0]), k))
                    for x, v in zip((key, low, count, whole), found, strict=True):
                        x.append(v)
            if not of:
                continue
            at = pa.array(np.concatenate(of))
            yield pa.RecordBatch.from_arrays(
                [
                    b["t1"].take(at), b["t2"].take(at), pa.array(np.concatenate(low).astype(np.int32)), pa.array(np.concatenate(count).astype(np.int32)),
                    pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(whole).view(np.int64)),
                ],
                ["t1", "t2", "low", "n", "key", "c"],
            )

    found = scratch.save(given.select("t1", "t2", "raw").mapInArrow(anchors, "t1 bigint, t2 int, low int, n int, key bigint, c bigint"), "contexts")
    again = scratch.save(found.groupBy("key").count().filter("count > 1").select(F.col("key").alias("k")), "again")
    live = scratch.save(found.join(again, F.col("key") == F.col("k")).drop("k"), "live")
    scratch.drop("contexts", "again")
    groups = live.groupBy("key", "c").agg(F.count("*").alias("times"), F.min(F.struct("t1", "t2", "low", "n")).alias("one"))
    groups = scratch.save(groups, "groups")
    kinds = scratch.save(groups.groupBy("key").count().filter(F.col("count") > shard).select(F.col("key").alias("k")), "large")
    asks = groups.join(kinds, F.col("key") == F.col("k"), "left").select(
        "one.*", "key", "c", F.least("times", F.lit(2)).cast("int").alias("weight"), F.col("k").isNotNull().alias("large")
    )
    per_text = asks.groupBy("t1", "t2").agg(F.collect_list(F.struct("low", "n", "key", "c", "weight", "large")).alias("asks"))
    per_text = scratch.save(per_text.withColumnsRenamed({"t1": "a1", "t2": "a2"}), "asks")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, asked in zip(raw_texts(b["raw"]), b["asks"].to_pylist(), strict=True):
                words, rows = t.split(), []
                for a in asked:
                    whole = words[a["low"] : a["low"] + a["n"] + window - 1]
                    if not a["large"]:
                        rows.append((a["key"], a["c"], a["weight"], None, None, None, b" ".join(whole)))
                        continue
                    for k in range(a["n"]):
                        own = b" ".join(whole[k : k + window])
                        d = np.frombuffer(xxhash.xxh3_128_digest(own), np.int64)
                        rows.append((a["key"], a["c"], a["weight"], k, int(d[0]), int(d[1]), own))
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["key", "c", "weight", "k", "w1", "w2", "words"]
                )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["key"]):
            edges = runs(t["key"].to_numpy())
            key, cs, weights, texts = t["key"].to_numpy(), t["c"].to_pylist(), t["weight"].to_pylist(), t["words"].to_pylist()
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = [x.split(b" ") for x in texts[a:b]]
                reference = Automaton()
                for weight, words in zip(weights[a:b], own, strict=True):
                    reference.add(words, weight)
                reference.close()
                for c, words in zip(cs[a:b], own, strict=True):
                    out += [(key[a], c, low, n) for low, n in stretches(reference.repeated(words, window))]
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], ["key", "c", "from", "count"])

    of_text = lambda d, x: (F.col("t1") == F.col(d)) & (F.col("t2") == F.col(x))
    texts = given.select("t1", "t2", "raw").join(per_text, of_text("a1", "a2")).select("raw", "asks")
    spelled = texts.mapInArrow(spell, "key bigint, c bigint, weight int, k int, w1 bigint, w2 bigint, words binary")
    spelled = scratch.save(spelled, "spelled")
    # Copies of a text spell a context again.
    contexts_ = spelled.filter("k is null").select("key", "c", "weight", "words").dropDuplicates(["key", "c"])
    places = scratch.save(spelled.filter("k is not null").select("key", "c", "weight", "k", "w1", "w2").distinct(), "places")
    windows = spelled.filter("k is not null").groupBy("w1", "w2").agg(F.first("words").alias("words"))
    held = places.groupBy("w1", "w2").agg(F.least(F.sum("weight"), F.lit(2)).cast("int").alias("weight"))
    windows = windows.join(held, ["w1", "w2"]).select(F.col("w1").alias("key"), F.col("w2").alias("c"), "weight", "words")
    decide = lambda shards: shards.repartition("key").sortWithinPartitions("key").mapInArrow(stream, "key bigint, c bigint, from int, count int")
    small = decide(contexts_)
    large = decide(windows).select(F.col("key").alias("x1"), F.col("c").alias("x2"))
    large = places.join(large, (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2"))).select("key", "c", F.col("k").alias("from"), F.lit(1).alias("count"))
    marks = scratch.save(small.unionByName(large).withColumnsRenamed({"key": "k", "c": "kc"}), "repeated")
    marks = live.join(marks, (F.col("key") == F.col("k")) & (F.col("c") == F.col("kc"))).select("t1", "t2", (F.col("low") + F.col("from")).alias("low"), "count")
    marks = marks.groupBy("t1", "t2").agg(F.collect_set(F.struct("low", "count")).alias("marks"))
    marks = scratch.save(
        marks.select(F.col("t1").alias("a1"), F.col("t2").alias("a2"), F.col("marks.low").alias("low"), F.col("marks.count").alias("count")), "marks"
    )
    scratch.drop("live", "groups", "large", "asks", "spelled", "places", "repeated")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for t, low, count in zip(raw_texts(b["raw"]), b["low"], b["count"], strict=True):
                words = t.split()
                total.append(len(words))
                if low.is_valid:
                    starts, steps = low.values.to_numpy(), np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, starts + count.values.to_numpy() + window - 1, -1)
                    stay = np.cumsum(steps)[:-1] == 0
                    words = [words[x] for x in np.flatnonzero(stay)]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"]
            )

    judged = given.join(marks, of_text("a1", "a2"), "left").select("id", "raw", "low", "count")
    long = lambda n: T.StructField(n, T.LongType())
    schema = T.StructType([judged.schema["id"], long("n_words"), long("n_removed"), T.StructField("kept", T.StringType())])
    return judged.mapInArrow(remove, schema).withColumnRenamed("id", id)
