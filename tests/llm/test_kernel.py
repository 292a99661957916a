"""The subsequence kernel and the machine against plain definitions."""

import itertools
import random
from math import sqrt

import numpy as np
import pytest

from sessionweave.llm import toxicity as t


def plain_weights(word):
    """Weight of each subsequence of three letters: the sum of its occurrences' decays; other characters are gaps."""
    out = {}
    for at in itertools.combinations(range(len(word)), 3):
        if at[-1] - at[0] < t.SPREAD and all("a" <= word[k] <= "z" for k in at):
            key = "".join(word[k] for k in at)
            out[key] = out.get(key, 0) + t.DECAY ** (at[-1] - at[0] + 1)
    return out


def plain_kernel(a, b):
    x, y = plain_weights(a), plain_weights(b)
    own = lambda w: sqrt(sum(v * v for v in w.values()))
    return sum(v * y.get(k, 0) for k, v in x.items()) / (own(x) * own(y)) if x and y else 0.0


WORDS = ["idiot", "id-iot", "i.d.i.o.t", "idiots", "banana", "anab", "ab", "xyzzy", "abcabcabc", "a1b2c3", "plain", "planet"]


def test_word_kernel():
    rng = random.Random(0)
    words = sorted({*WORDS, *("".join(rng.choice("abcd-") for _ in range(rng.randint(3, 12))) for _ in range(40))})
    data = t.Sentences([" ".join(words)])
    marks = [data.number[w] for w in words if w in data.number]
    got = data.kernel(marks)
    for i, m in itertools.product(range(len(data.words)), range(len(marks))):
        assert got[i, m] == pytest.approx(plain_kernel(data.words[i], data.words[marks[m]]), abs=1e-5)


def test_sentence_kernel_is_the_sum_over_pairs():
    data = t.Sentences(["idiot banana", "id-iot plain planet", "xyzzy"])
    phi, own = data.mapped(list(range(len(data.words))), 2)
    assert np.allclose(own, data.kernel(list(range(len(data.words)))))
    for k, (s, u) in enumerate(itertools.product(range(3), repeat=2)):
        mine, other = (data.flat[data.start[x] : data.start[x + 1]] for x in (s, u))
        want = sum(plain_kernel(data.words[a], data.words[b]) for a in mine for b in other)
        assert phi[s][other].sum() == pytest.approx(want, abs=1e-4), k


def test_machine_minimizes_the_squared_hinge():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 4)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=80) > 0, 1.0, -1.0)
    cost = np.full(80, 0.7)
    beta, bias, _ = t.hinge(x, np.eye(4), y, cost)
    loss = lambda w, b: 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()
    best = loss(beta, bias)
    assert all(loss(beta + rng.normal(size=4) * s, bias + rng.normal() * s) >= best - 1e-5 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


def test_folded_weights_are_the_machine():
    """A word's decision by the folded weights is that of the kernel expansion."""
    rng = random.Random(2)
    noise = lambda n: [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(5)) for _ in range(n)]
    toxic = [f"{s} plonkel" if k % 2 else s for k, s in enumerate(noise(60))]
    clean = noise(120)
    common = [w for s in clean for w in s.split()][:40]
    m = t.train(toxic, clean, ["plonkel"], common)
    f = m.decide(["plonkel", "plon-kel", *common])
    assert f[0] > 0 > f[2:].mean() and f[1] > f[2:].max()
