"""Toxicity by a subsequence string kernel, a Nyström map and a linear support vector machine.

The kernel of two words counts common subsequences of three letters, gaps
included, with weight ``DECAY`` to the power of their spread (up to ``SPREAD``
characters), normalized by both words' own kernels; so ``id-iot`` or
``i.d.i.o.t`` stay close to ``idiot``.  Characters that are not letters count as
gaps only; runs of three or more single letters are read as one word as well.
The kernel of two sentences is the sum over all pairs of their words.

The machine is trained on labelled sentences: those of ``train_docs`` documents
at most, by hash order of their ids, ``TOXIC`` of toxic and ``CLEAN`` of clean
ones at most, by hash order of the sentences.  A document's label tells that
some of its sentences are toxic, not which.  So training goes in rounds: of the
sentences of toxic documents those stay positive that a machine puts above
nearly all sentences of clean ones, and the machine is trained again.
Landmarks of the Nyström map are words: such as stand in many contexts of toxic
documents and few of clean ones, words over which clean sentences were taken
for toxic ones, and common words.  They are points of reference alone; what is
learned are weights of the sentences' subsequences.  As the kernel is a product
of explicit subsequence counts, the machine folds into one weight a
subsequence, and a word costs one lookup for each of its subsequences.

A document's score is a logistic function of its largest decision on a word
(a sentence of that word alone), and of how far its words pass several levels,
fitted on the training documents.

Defined results: null and empty texts, and texts without a word, score as the
least toxic document possible; without training rows of both labels every
score is the share of toxic ones (0 without any); rows that repeat an id are
scored alike; null ids are scored and not held out; an empty table gives an
empty result; other columns do not matter, and one named like the score is
replaced.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches
from sessionweave.llm.scratch import Scratch

DECAY, SPREAD, WIDTH = 0.6, 7, 24
#: Letters by their place in an alphabet of 63; 0 is a gap.
LETTERS = 64
#: Labelled documents a classifier is fitted on, at most.
TRAIN_DOCS = 8_000
#: Sentences it is trained on, at most; landmarks by kind; rounds; share of clean sentences that a positive one must be above; words of a part of a long sentence.
TOXIC, CLEAN = 30_000, 60_000
TELLING, MISTAKEN, LANDMARKS = 120, 160, 360
ROUNDS, ABOVE, LONGEST = 6, 0.9995, 6
#: Least likelihood ratio statistic of a word that counts as toxic: above what chance gives among 100,000 words.
SURPRISE = 25.0
#: Decisions that a document's words are counted above; bounds of its largest decision; weight decay of the logistic fit.
LEVELS, LEAST, MOST, RIDGE = (0.0, 0.7, 1.4, 2.0), 0.0, 3.0, 1e-4
KEPT_WORDS = 400_000
#: Where a sentence ends.
END = re.compile(r"[.!?]+(?=\s|$)|\n+")


def codes(words: list[str], width: int) -> np.ndarray:
    """Letter codes of lower-case words, padded with gaps."""
    flat = np.array([w.ljust(width, "\0") for w in words], f"<U{width}").view(np.uint32).reshape(len(words), width)
    ascii_ = (flat >= 97) & (flat <= 122)
    other = flat >= 0xC0
    return np.where(ascii_, flat - 96, np.where(other, 27 + flat % 37, 0)).astype(np.int64)


@functools.cache
def places(width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All index triples within the spread, and the spread of each."""
    t = np.array([x for x in itertools.combinations(range(width), 3) if x[2] - x[0] < SPREAD], np.int64).reshape(-1, 3)
    return t[:, 0], t[:, 1], t[:, 2], t[:, 2] - t[:, 0] + 1


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalized subsequence weights as sparse ``(row, subsequence, weight)``; words of up to ``WIDTH`` characters."""
    rows, ids, values = [], [], []
    size = np.array([len(w) for w in words])
    for low, width in ((0, 6), (6, 9), (9, 13), (13, WIDTH)):
        at = np.flatnonzero((size > low) & (size <= width))
        i, j, k, spread = places(width)
        for part in np.array_split(at, max(1, len(at) * len(i) // 400_000)):
            if not len(part):
                continue
            c = codes([words[x] for x in part], width)
            a, b, d = c[:, i], c[:, j], c[:, k]
            ok = ((a > 0) & (b > 0) & (d > 0)).reshape(-1)
            key = (np.arange(len(part))[:, None] << 21) | ((a << 12 | b << 6 | d) << 3) | spread[None, :]
            key = np.sort(key.reshape(-1)[ok])
            if not len(key):
                continue
            weight = DECAY ** (key & 7)
            group = key >> 3
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            total = np.add.reduceat(weight, first)
            row = group[first] >> 18
            norm = np.sqrt(np.bincount(row, total**2, len(part)))
            rows.append(part[row]), ids.append(group[first] & (LETTERS**3 - 1)), values.append(total / norm[row])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(values)


def pieces(word: str) -> list[str]:
    """A word, or overlapping parts of one longer than ``WIDTH``."""
    if len(word) <= WIDTH:
        return [word]
    return [word[k : k + WIDTH] for k in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def units(text: str) -> list[str]:
    """Lower-case words, and runs of three or more single letters read together."""
    words = text.lower().split()
    spelled, run = [], []
    for w in (*words, ""):
        if len(w) == 1:
            run.append(w)
        elif run:
            if len(run) > 2:
                spelled.append("".join(run))
            run = []
    return words + spelled


class Machine:
    """Weights of all subsequences, a bias, and the logistic weights of a document's evidence."""

    def __init__(self, weights: np.ndarray, bias: float, slope: np.ndarray | None = None):
        self.weights, self.bias, self.slope = weights, bias, slope

    def state(self) -> tuple:
        """Plain values for a broadcast."""
        return self.weights, self.bias, self.slope

    def decide(self, words: list[str]) -> np.ndarray:
        """Decision of each word; the largest of its parts."""
        parts = [pieces(w) for w in words]
        of = np.repeat(np.arange(len(words)), [len(p) for p in parts])
        row, sub, value = features([p for x in parts for p in x])
        f = np.bincount(row, value * self.weights[sub], len(of)) + self.bias
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, of, f)
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.slope, -40, 40)))

    def least(self) -> float:
        """Score of a text without a word: that of a text of 100 harmless words, or a tenth of it."""
        x = np.zeros(len(self.slope))
        x[0], x[-2], x[-1] = LEAST, np.log1p(100), 1
        s = float(self.score(x[None])[0])
        return s if not self.weights.any() else s / 10


def sentences(text: str) -> list[str]:
    """Sentences with any word; long ones in parts of ``LONGEST`` words."""
    words = [s.split() for s in END.split(text)]
    return [" ".join(w[k : k + LONGEST]) for w in words for k in range(0, len(w), LONGEST)]


class Sentences:
    """Sentences as numbers of distinct words, with the words' subsequence weights."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        ids = [[number.setdefault(w, len(number)) for w in units(t)] for t in texts]
        self.number, self.words = number, list(number)
        self.size = np.array([len(s) for s in ids])
        self.flat = np.fromiter((k for s in ids for k in s), np.int32, int(self.size.sum()))
        self.start = np.append(0, np.cumsum(self.size))
        subs, values, counts = [], [], []
        for low in range(0, len(self.words), 8192):
            parts = [pieces(w) for w in self.words[low : low + 8192]]
            of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            row, sub, value = features([p for x in parts for p in x])
            row = of[row]
            order = np.argsort(row, kind="stable")
            subs.append(sub[order].astype(np.int32)), values.append(value[order].astype(np.float32)), counts.append(np.bincount(row, minlength=len(parts)))
        self.sub, self.value = np.concatenate(subs), np.concatenate(values)
        self.edge = np.append(0, np.cumsum(np.concatenate(counts)))

    def row(self, word: int) -> slice:
        return slice(self.edge[word], self.edge[word + 1])

    def kernel(self, marks: list[int]) -> np.ndarray:
        """Kernel of every word with the marked ones."""
        used = np.unique(np.concatenate([self.sub[self.row(m)] for m in marks]))
        place = np.full(LETTERS**3, -1, np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        dense = np.zeros((len(used), len(marks)), np.float32)
        for k, m in enumerate(marks):
            np.add.at(dense[:, k], place[self.sub[self.row(m)]], self.value[self.row(m)])
        out = np.zeros((len(self.words), len(marks)), np.float32)
        at = place[self.sub]
        for w in range(len(self.words)):
            s = self.row(w)
            known = at[s] >= 0
            if known.any():
                out[w] = self.value[s][known] @ dense[at[s][known]]
        return out

    def add_up(self, of_words: np.ndarray, out: np.ndarray) -> None:
        """Sum over the words of each sentence."""
        for low in range(0, len(self.size), 2048):
            high = min(low + 2048, len(self.size))
            s = slice(self.start[low], self.start[high])
            out[low:high] = np.add.reduceat(of_words[self.flat[s]], self.start[low:high] - self.start[low])

    def mapped(self, marks: list[int], step: int = 60) -> tuple[np.ndarray, np.ndarray]:
        """Kernel of every sentence with the marks, and of the marks with one another; words' own kernels stand for some marks at a time."""
        x, own = np.zeros((len(self.size), len(marks)), np.float32), np.zeros((len(marks), len(marks)))
        for low in range(0, len(marks), step):
            of_words = self.kernel(marks[low : low + step])
            self.add_up(of_words, x[:, low : low + step])
            own[:, low : low + step] = of_words[marks]
        return x, own

    def decisions(self, weights: np.ndarray) -> np.ndarray:
        """Of each word, by a weight a subsequence."""
        total = np.append(0.0, np.cumsum(self.value * weights[self.sub]))
        return total[self.edge[1:]] - total[self.edge[:-1]]


def hinge(x: np.ndarray, turn: np.ndarray, y: np.ndarray, cost: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, float, np.ndarray]:
    """Squared-hinge machine on the mapped rows ``x @ turn``, by Newton steps on its support vectors: weights on ``x``, bias, and both in the mapped space (a start for the next)."""
    n = turn.shape[1]
    w = np.zeros(n + 1) if start is None else start
    for _ in range(40):
        beta = turn @ w[:n]
        inside = np.flatnonzero((y * (x @ beta.astype(np.float32) + w[n]) < 1) & (cost > 0))
        h, g = np.eye(n + 1), np.zeros(n + 1)
        for part in np.array_split(inside, max(1, len(inside) // 4096)):
            z = np.hstack([x[part] @ turn.astype(np.float32), np.ones((len(part), 1), np.float32)]).astype(np.float64)
            h += 2 * (z.T * cost[part]) @ z
            g += 2 * z.T @ (cost[part] * y[part])
        new = np.linalg.solve(h, g)
        done, w = np.allclose(new, w, atol=1e-4), new
        if done:
            break
    return turn @ w[:n], float(w[n]), w


def train(toxic: list[str], clean: list[str], telling: list[str], common: list[str]) -> Machine:
    """Machine of the sentences of toxic and of clean documents; ``telling`` and ``common`` words are landmarks, best first."""
    data = Sentences(toxic + clean)
    y = np.append(np.ones(len(toxic)), -np.ones(len(clean)))
    first = [data.number[w] for w in telling if w in data.number][:TELLING]
    others = [data.number[w] for w in common if w in data.number]
    positive, mistaken = y > 0, []
    for _ in range(ROUNDS):
        hard = [w for w in mistaken if w not in set(first)][:MISTAKEN]
        taken = {*first, *hard}
        marks = first + hard + [w for w in others if w not in taken][: LANDMARKS - len(taken)]
        x = None  # the last round's is given up first
        x, own = data.mapped(marks)
        value, vector = np.linalg.eigh((own + own.T) / 2)
        good = value > 1e-6 * value[-1]
        turn = vector[:, good] / np.sqrt(value[good])
        start = None
        for _ in range(3):
            n1, n0 = positive.sum(), len(clean)
            cost = np.where(y < 0, 0.5 / n0, np.where(positive, 0.5 / n1, 0.0)) * (n1 + n0)
            beta, bias, start = hinge(x, turn, y, cost, start)
            decision = x @ beta.astype(np.float32) + bias
            chosen = (y > 0) & (decision > max(0.0, float(np.quantile(decision[y < 0], ABOVE))))
            if not chosen.any():
                break
            positive = chosen
        weights, blamed = np.zeros(LETTERS**3), Counter()
        for m, b in zip(marks, beta, strict=True):
            np.add.at(weights, data.sub[data.row(m)], data.value[data.row(m)] * b)
        weight = data.decisions(weights)
        for k in np.flatnonzero((y < 0) & (decision > 0)):
            s = data.flat[data.start[k] : data.start[k + 1]]
            blamed[int(s[np.argmax(weight[s])])] += 1
        mistaken = [w for w, _ in sorted(blamed.items(), key=lambda b: (-b[1], b[0]))]
    return Machine(weights, bias)


def calibrate(machine: Machine, evidence: np.ndarray, toxic: np.ndarray) -> Machine:
    """Logistic fit of labels on documents' evidence, the rarer class weighing more (by the root of its share)."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, n1**-0.5, n0**-0.5) / (n1**0.5 + n0**0.5)
    active = list(range(evidence.shape[1]))
    while True:
        x, w = evidence[:, active], np.zeros(len(active))
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            grad = x.T @ (weight * (p - target)) + RIDGE * w
            hess = (x.T * (weight * p * (1 - p))) @ x + RIDGE * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w = w - step * min(1, 5 / max(1e-12, np.abs(step).max()))
            if np.abs(step).max() < 1e-9:
                break
        if len(w) < 3 or w[:-2].min() >= 0:
            break
        active.pop(int(np.argmin(w[:-2])))  # more evidence never lowers a score
    full = np.zeros(evidence.shape[1])
    full[active] = w
    return Machine(machine.weights, machine.bias, full)


def evidence(machine: Machine, texts: list[str], kept: dict[str, float]) -> np.ndarray:
    """Of each text: its largest word decision, by how much words pass each level in sum, how many words there are, and one."""
    out = np.zeros((len(texts), len(LEVELS) + 3))
    out[:, -1] = 1
    out[:, 0] = LEAST
    split = [units(t) for t in texts]
    if len(kept) > KEPT_WORDS:
        kept.clear()
    new = list({w for words in split for w in words} - kept.keys())
    for at in range(0, len(new), 2048):  # the words of all texts at once
        kept.update(zip(new[at : at + 2048], machine.decide(new[at : at + 2048]).tolist(), strict=True))
    for k, words in enumerate(split):
        if not words:
            continue
        high = [f for f in map(kept.__getitem__, words) if f > LEVELS[0]]
        if high:
            out[k, 0] = max(LEAST, min(max(high), MOST))
        for n, level in enumerate(LEVELS):
            out[k, n + 1] = np.log1p(sum(f - level for f in high if f > level))
        out[k, -2] = np.log1p(len(words))
    return out


def held_out(id):
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", train_docs: int = TRAIN_DOCS) -> Machine:
    """Machine of the labels of documents that are not held out."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "toxic")
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("y")).filter("id is not null and y is not null")
    known = known.groupBy("id").agg(F.max(F.col("y") > 0).alias("y")).filter(~held_out(F.col("id")))
    known = scratch.save(known.orderBy(F.xxhash64("id"), "id").limit(train_docs), "known")
    texts = docs.select(F.col(f"`{id}`").alias("i"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), F.col("i") == F.col("id"))
    texts = scratch.save(texts.select("y", F.coalesce("text", F.lit("")).alias("text")).distinct(), "texts")
    share = texts.agg(F.avg(F.col("y").cast("int"))).first()[0] or 0.0
    none = Machine(np.zeros(LETTERS**3), 0.0, np.append(np.zeros(len(LEVELS) + 2), np.log(max(share, 1e-17) / max(1 - share, 1e-17))))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, t in zip(b["y"].to_pylist(), b["text"].to_pylist(), strict=True):
                words = units(t)
                pairs = list(set(zip(words, ["", *words])))  # noqa: B905
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), y)), *(pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1))], ["y", "word", "before"]
                )

    seen = texts.mapInArrow(contexts, "y boolean, word string, before string").filter(f"length(word) between 3 and {WIDTH}").distinct()
    words = scratch.save(seen.groupBy("word").agg(F.count_if("y").alias("t"), F.count_if(~F.col("y")).alias("c")), "words")
    sums = words.agg(F.sum("t"), F.sum("c")).first()
    if not sums[0] or not sums[1]:
        return none
    ratio = (F.col("t") + 0.5) / sums[0] / ((F.col("c") + 0.5) / sums[1])
    pool = (F.col("t") + F.col("c")) / (sums[0] + sums[1])
    part = lambda n, of: F.when(n > 0, n * F.log(n / (pool * of))).otherwise(0.0)
    surprise = 2 * (part(F.col("t"), sums[0]) + part(F.col("c"), sums[1]))
    ranked = words.filter(ratio >= 8).withColumn("surprise", surprise).filter(F.col("surprise") >= SURPRISE)
    telling = [r[0] for r in ranked.orderBy(F.desc("surprise"), "word").limit(TELLING).collect()]
    common = words.filter((F.col("c") > 0) & (ratio < 2)).orderBy(F.desc("c"), "word").limit(LANDMARKS)
    common = [r[0] for r in common.collect()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, t in zip(b["y"].to_pylist(), b["text"].to_pylist(), strict=True):
                own = list(dict.fromkeys(sentences(t.lower())))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), y)), pa.array(own, pa.string())], ["y", "sentence"])

    said = scratch.save(texts.select("y", "text").mapInArrow(cut, "y boolean, sentence string").distinct(), "sentences")
    some = lambda y, n: said.filter(F.col("y") == y).orderBy(F.xxhash64("sentence"), "sentence").limit(n).select("sentence").toArrow()["sentence"].to_pylist()
    toxic, clean = some(True, TOXIC), some(False, CLEAN)
    if not telling or not common or not toxic or not clean:
        return none
    machine = train(toxic, clean, telling, common)
    shared = spark.sparkContext.broadcast(machine.state())

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, kept = Machine(*shared.value), {}
        for b in batches:
            x = evidence(fitted, b["text"].to_pylist(), kept)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b["y"]], ["x", "y"])

    table = texts.select("text", "y").mapInArrow(decide, "x array<double>, y boolean").toArrow()  # train_docs rows at most
    y = table["y"].to_numpy().astype(bool)
    return calibrate(machine, np.array(table["x"].to_pylist()), y)


def score(docs: DataFrame, machine: Machine, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the score added (in place of a column of that name)."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(machine.state())
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != to)).alias("own"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, kept = Machine(*shared.value), {}
        for b in batches:
            x = evidence(fitted, [t or "" for t in b["text"].to_pylist()], kept)
            y = fitted.score(x)
            y[x[:, -2] == 0] = min(fitted.least(), 1.0)  # no word
            yield pa.RecordBatch.from_arrays([b["own"], pa.array(y)], ["own", "score"])

    done = own.mapInArrow(run, T.StructType([own.schema["own"], T.StructField("score", T.DoubleType())]))
    return done.select("own.*", F.col("score").alias(to))
