"""Near duplicates by registers next to all pairs of whole sets."""

import random
from itertools import combinations

import numpy as np

from tabml.llm import minhash, streamed

SCHEMA = "doc_id long, text string, node string, data int"


def groups(texts, words=4, percent=80):
    sets, parent = {}, {k: k for k in texts}
    for key, text in texts.items():
        said = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).split() if w]
        size = min(words, len(said))
        sets[key] = {tuple(said[k : k + size]) for k in range(len(said) - size + 1)} if said else set()

    def root(key):
        return key if parent[key] == key else root(parent[key])

    for a, b in combinations(sorted(texts), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if either and 100 * both >= percent * either:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: (len(sets[k]), root(k), root(k) == k) for k in texts}


def family(draw, size, words, change):
    """Copies of one text with a share of the words replaced."""
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(words)]
    for _ in range(size):
        yield " ".join(w if draw.random() > draw.random() * change else f"x{draw.randint(0, 10**6)}" for w in base)


def test_like_all_pairs(spark):
    draw = random.Random(2)
    texts = [t for size, words, change in ((60, 60, 0.06), (40, 300, 0.05), (30, 9, 0.1), (20, 3, 0.2)) for t in family(draw, size, words, change)]
    texts += [texts[0].upper(), texts[0] + " \n", "", " ", None, "one", "ONE", "long " * 30_000, "ä Ä b c d"]
    texts = dict(enumerate(texts))
    frame = spark.createDataFrame([(k, t, "n", 1) for k, t in texts.items()], SCHEMA)
    got = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(frame).collect()}
    assert got == groups(texts)


def test_blocks_and_slices(spark, monkeypatch):
    # Buckets of several blocks and partners of several slices give the same groups.
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(streamed, "SLICE_ROWS", 3)
    draw = random.Random(3)
    texts = dict(enumerate(family(draw, 120, 50, 0.1)))
    frame = spark.createDataFrame([(k, t, "n", 1) for k, t in texts.items()], SCHEMA)
    got = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(frame).collect()}
    assert got == groups(texts)


def test_awkward_rows(spark):
    rows = [(None, "a b c d e f", "n", 1), (7, "a b c d e f", "n", 1), (7, "a b c d e f", "n", 1), (3, None, None, None), (None, None, "n", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in minhash.near_duplicates(frame).collect()), key=str)
    want = [(None, 3, 7, False), (7, 3, 7, True), (7, 3, 7, True), (3, 0, 3, True), (None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_registers_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 5, 134, 3000):
        misses, shared = [], 0
        for _ in range(60):
            union = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            rng.shuffle(union)
            both = max(1, round(0.8 * n))
            one, two = np.sort(union[: both + (n - both) // 2]), np.sort(np.concatenate([union[:both], union[both + (n - both) // 2 :]]))
            codes, others = minhash.registers(one), minhash.registers(two)
            assert (minhash.unpack(minhash.pack(codes)) == codes).all()
            estimate, error = minhash.estimates(codes, len(one), others[None], np.array([len(two)]), 0.8)
            misses.append((estimate[0] - both / n) / error[0])
            shared += int((minhash.band_keys(codes) == minhash.band_keys(others)).any())
        # Always within the error that is allowed for, on average right, and always in a common band.
        assert np.abs(misses).max() < 1 and abs(np.mean(misses)) < 0.2 and shared == 60


def test_collisions_like_drawing():
    rng = np.random.default_rng(2)
    equal = both = 0
    for _ in range(400):
        one, two = (minhash.registers(np.unique(rng.integers(0, 2**64, 700, dtype=np.uint64))) for _ in range(2))
        use = (one > 0) & (two > 0)
        equal += int(((one == two) & use).sum())
        both += int(use.sum())
    expected = float(minhash.collisions(700, np.array([700]))[0])
    assert abs(equal / both - expected) < 4 * np.sqrt(expected / both)
