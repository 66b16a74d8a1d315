"""HyperMinHash near-duplicates against brute force over all pairs of sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from partwise.llm import hyperminhash

DDL = "doc_id bigint, text string"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    return {tuple(words[i : i + 2]) for i in range(len(words) - 1)} if len(words) > 1 else {(w,) for w in words}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    # A row without words is a component of its own, whatever others share its doc_id.
    component = [least.get(find(i)) for i in range(len(rows))]
    return sorted(((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, component)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def changed(rng, words, share):
    return [f"z{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def corpus(seed, groups, copies, words, share):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice(words))]
        for _ in range(rng.randrange(1, copies)):
            rows.append(" ".join(changed(rng, base, rng.random() * share)))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, words", [(1, [3, 5, 8, 12, 20]), (2, [40, 100, 300, 2000])])
def test_components(spark, seed, words):
    rows = corpus(seed, 60, 7, words, 0.12)
    df = spark.createDataFrame(rows, DDL).repartition(3)
    wanted = brute(rows)
    assert result(hyperminhash.near_duplicates(df)) == wanted
    assert 60 < len({r[2] for r in wanted}) < len(rows)


def test_crowded_keys(spark):
    """A large group around one text, whose copies are not linked with each other, and a chain of small changes."""
    rng = random.Random(5)
    base = [f"c{i}" for i in range(150)]
    star = [" ".join(base)] + [" ".join(base[:i] + [f"n{i}{k}" for k in range(10)] + base[i + 10 :]) for i in range(0, 140)]
    chain, now = [], [f"d{i}" for i in range(120)]
    for i in range(60):
        now = now[:]
        now[rng.randrange(120)] = f"e{i}"
        now[rng.randrange(120)] = f"f{i}"
        chain.append(" ".join(now))
    rows = list(enumerate(star[1:] + chain + star[:1] + [star[3]] * 20))
    assert result(hyperminhash.near_duplicates(spark.createDataFrame(rows, DDL))) == brute(rows)


def test_crowd_pairs(spark, monkeypatch):
    """Near copies of one text: sets that are one component already are not compared again for each key that they share."""
    rng, base = random.Random(8), [f"c{i}" for i in range(150)]
    rows = list(enumerate({" ".join(changed(rng, base, 0.03)) for _ in range(300)}))
    compared, verified = [], hyperminhash.verified
    monkeypatch.setattr(hyperminhash, "verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more))
    assert result(hyperminhash.near_duplicates(spark.createDataFrame(rows, DDL))) == brute(rows)
    assert sum(compared) <= 2 * len(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 900}x{i // 7}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one one"), (7, "one one one"), (8, "É b"), (9, "é b"), (9, "other text"), (9, "other text"), (None, "other text"), (None, "alone here now"), (10, long), (11, long + " end")]
    df = spark.createDataFrame(rows, DDL)
    wanted = sorted(((d, n, d if n == 0 else c, d == (d if n == 0 else c)) for d, n, c, _ in brute(rows)), key=repr)
    assert result(hyperminhash.near_duplicates(df)) == wanted
    clash = df.withColumns({c: F.lit(1) for c in ("set", "n", "digest", "key", "root", "registers", "component_id")})
    assert result(hyperminhash.near_duplicates(clash)) == wanted


def test_empty(spark):
    assert hyperminhash.near_duplicates(spark.createDataFrame([], DDL)).collect() == []


def test_registers_and_estimate():
    """Leading zeros and mantissa by their definition; estimates near the similarity, collisions near their expectation."""
    s = np.array([0x0100000000000001, 0x01F0000000000000, 0xFF00400000000000], np.uint64)
    reg = hyperminhash._registers([np.sort(s)])[0]
    assert reg[1] == 55 * 1024 + 1 and reg[255] == 9 * 1024 + 1 and (reg != 0).sum() == 2
    rng = np.random.default_rng(3)
    for common, own in ((8000, 1000), (400, 50), (4000, 3000)):
        x = rng.integers(0, 2**63, common + 2 * own, np.int64).view(np.uint64) * np.uint64(2)
        a, b = np.unique(x[: common + own]), np.unique(np.concatenate((x[:common], x[common + own :])))
        r = hyperminhash._registers([a, b])
        estimate, ok = hyperminhash.similar(r[:1], r[1:], np.array([len(a)]), np.array([len(b)]), 80)
        assert abs(estimate[0] - common / (common + 2 * own)) < 0.12
        assert ok[0] == (common > 2 * own * 4 * 0.9)
    sets = [np.unique(rng.integers(0, 2**63, 20_000, np.int64).view(np.uint64) * np.uint64(2)) for _ in range(60)]
    r = hyperminhash._registers(sets)
    equal = np.mean([(r[i] == r[j]).sum() for i in range(60) for j in range(i)])
    expected = hyperminhash.expected_collisions(np.array([20_000.0]), np.array([20_000.0]))[0]
    assert abs(equal - expected) < 0.05 + 0.2 * expected


def test_bands_find_pairs_at_the_threshold():
    """Of 400 pairs of similarity 0.8 none shares no band key."""
    rng = np.random.default_rng(4)
    for size in (8, 80, 800):
        missed = 0
        for _ in range(400):
            x = rng.integers(0, 2**63, size + size // 4, np.int64).view(np.uint64) * np.uint64(2)
            half = len(x) // 10
            keys = hyperminhash._band_keys(hyperminhash._registers([np.unique(x[half:]), np.unique(x[: len(x) - half])]))
            missed += not (keys[0] == keys[1]).any()
        assert missed == 0
