"""Near copies by exact Jaccard similarity, against all pairs."""

import itertools
import random

import numpy as np

from sessionweave.llm import simhash
from sessionweave.llm.scratch import Scratch
from tests.llm import fixtures
from tests.llm.test_edges import components


def all_pairs(rows, k=5, similarity=0.8):
    """Groups by the Jaccard similarity of every pair's sets of ``k`` words."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    near = lambda x, y: len(x & y) >= similarity * len(x | y) - 1e-9
    return components([(a, b) for a, b in itertools.combinations(sets, 2) if near(sets[a], sets[b])], sets)


def found(spark, rows):
    return {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_groups_of_edited_copies_do_not_fall_apart(spark):
    rng, rows = random.Random(5), []
    for size, edits in ((200, 4), (100, 2)):
        base = fixtures.words(rng, size).split()
        for _ in range(200):
            w = list(base)
            for at in rng.sample(range(size), rng.randint(1, edits)):
                w[at] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    assert found(spark, rows) == all_pairs(rows)


def test_texts_that_one_repeated_word_dominates_are_compared(spark):
    rng = random.Random(6)
    rows = [(i, "spam " * 50 + " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(10)]
    assert found(spark, rows) == all_pairs(rows) == {i: i for i, _ in rows}


def test_repeats_do_not_part_equal_sets(spark):
    rng, rows = random.Random(7), []
    for i in range(10):
        w = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        phrase = [f"p{rng.randrange(10**6)}" for _ in range(8)]
        rows += [(2 * i, " ".join(w + phrase * 2)), (2 * i + 1, " ".join(w + phrase * 30))]
    assert found(spark, rows) == all_pairs(rows) == {i: i - i % 2 for i, _ in rows}


def test_no_pair_at_the_threshold_is_missed(spark):
    rng, rows = random.Random(8), []
    for i in range(300):
        w = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        changed = list(w)
        for at in range(20, 20 + 6 * 40, 40):  # 30 of 296 shingles changed: 266 of 326 are common
            changed[at] = f"edit{rng.randrange(10**6)}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(changed))]
    assert found(spark, rows) == {i: i - i % 2 for i, _ in rows}


def test_groups_about_the_threshold_against_all_pairs(spark):
    rng, rows = random.Random(9), []
    word = lambda: f"w{rng.randrange(10**6)}"
    for _ in range(8):
        base = [word() for _ in range(160)]
        phrase = [word() for _ in range(6)]
        for part in (0.75, 0.79, 0.8, 0.81, 0.85, 0.9, 0.95) * 2:
            cut = round(160 * (1 - part) * rng.random())
            w = base[: 160 - cut] + [word() for _ in range(rng.randint(0, 30))]
            rows.append((len(rows), " ".join(w + phrase * rng.randint(0, 12))))
    rows += [(len(rows), ""), (len(rows) + 1, ""), (len(rows) + 2, "two words"), (len(rows) + 3, "Two WORDS")]
    want = all_pairs(rows)
    assert 10 < len(set(want.values())) < len(rows)
    assert found(spark, rows) == want


def test_the_stage_finds_copies_by_their_fingerprints(spark, monkeypatch):
    """Edited copies go if their fingerprints lie within the radius; at radius 0 only equal sets are found."""
    import corpus_pipeline

    rng, rows = random.Random(10), []
    for i in range(20):
        w = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(3 * i, " ".join(w)), (3 * i + 1, "  ".join(w)), (3 * i + 2, " ".join([*w[:-1], "edited"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = lambda: {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept() == {3 * i for i in range(20)}
    monkeypatch.setattr(simhash, "reach", lambda *_: 0, raising=False)
    assert kept() == {3 * i + j for i in range(20) for j in (0, 2)}


def test_sets_are_compared_only_where_fingerprints_chain_them(spark):
    """Texts that chain through shared passages, at a similarity of about 0.1, are no candidates; edited copies are."""
    rng = random.Random(11)
    word = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [word(30) for _ in range(41)]
    bodies = [passages[i] + word(100) + passages[i + 1] for i in range(40)]
    rows = [(i, " ".join(w)) for i, w in enumerate(bodies)] + [(40 + i, " ".join([*w[:-1], "edited"])) for i, w in enumerate(bodies)]
    docs = spark.createDataFrame(rows, "id bigint, text string").selectExpr("id", "cast(text as binary) as raw")
    prints, _, stars = simhash.near_prints(docs, 5, 0.8, 8, Scratch(spark, "test-near"))
    node = {r.id: r.node for r in prints.collect()}
    root = {r.node: r.root for r in stars.collect()}
    groups = {i: root.get(n, n) for i, n in node.items()}
    assert len(set(groups.values())) == 40 and all(groups[i] == groups[40 + i] for i in range(40))


def test_fingerprints_at_the_threshold_lie_within_the_radius():
    rng = np.random.default_rng(12)
    radius, most, least = simhash.reach(0.8, 512), 0, 512
    for common, a, b in ((4, 1, 0), (8, 1, 1), (12, 2, 1), (20, 3, 2), (100, 25, 0), (240, 30, 30)):
        for _ in range(300):
            h = rng.integers(0, 2**64, common + a + b, dtype=np.uint64)
            x, y, z = (simhash.fingerprint(s, 8) for s in (h[: common + a], np.delete(h, np.s_[common : common + a]), ~h[:common]))
            most = max(most, distance(x, y))
            other = simhash.fingerprint(rng.integers(0, 2**64, common + a, dtype=np.uint64), 8)
            least = min(least, distance(x, other), distance(x, z))
    assert 100 < most <= radius < least
    assert simhash.reach(1.0, 512) == 0


def distance(x, y):
    return (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()


def test_fingerprints_in_blocks_against_all_pairs(spark):
    """Blocks of several groups and of one, whole and cut into tiles."""
    rng, rows, links = random.Random(13), set(), []
    fps = []
    for _ in range(12):
        base = rng.getrandbits(512)
        for _ in range(20):
            x = base
            for bit in rng.sample(range(512), rng.randint(0, 110)):
                x ^= 1 << bit
            fps.append(x)
    for part in range(30):
        rows |= {(0, part, x) for x in (rng.sample(fps, 25) if part % 2 else fps[20 * (part % 12) : 20 * (part % 12) + 20])}
    near = lambda x, y: (x ^ y).bit_count() <= 152
    for part in range(30):
        links += [(x, y) for x, y in itertools.combinations([x for _, p, x in rows if p == part], 2) if near(x, y)]
    nodes = simhash.print_nodes(np.frombuffer(b"".join(x.to_bytes(64, "little") for x in fps), np.uint64).reshape(-1, 8)).tolist()
    node = dict(zip(fps, nodes, strict=True)).__getitem__
    want = components([(node(x), node(y)) for x, y in links], nodes)
    keyed = spark.createDataFrame([(0, p, x.to_bytes(64, "little"), 0) for _, p, x in rows], "c smallint, part bigint, fp binary, d0 smallint")
    assert 12 < len(set(want.values())) < len(fps)
    for tile in (1024, 6):
        got = simhash.print_edges(keyed, 8, 152, Scratch(spark, "test-blocks"), tile).collect()
        assert components([(r.a, r.b) for r in got], nodes) == want
