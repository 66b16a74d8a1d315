"""SimHash: fingerprints and components against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from partwise.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    """Index of each fingerprint's component by union-find over all pairs."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "Two Words", "A b C d É\x0be f\x85g", "rep rep rep rep rep"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_golay_tables():
    leaders = simhash._leaders().tolist()
    assert len(set(leaders)) == 2048 and max(bin(x).count("1") for x in leaders) == 3
    words, costs = simhash._reach(2)
    assert (costs.min(axis=1) == 0).all() and (words[costs == 0] == 0).all()


def test_anchors_meet():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    rx, ax, nx = simhash.anchors(x.view(np.int64), 2, 1)
    ry, ay, ny = simhash.anchors(y.view(np.int64), 2, 1)
    near_x, all_y = set(zip(rx[nx].tolist(), ax[nx].tolist())), set(zip(ry.tolist(), ay.tolist()))
    assert {r for r, _ in near_x & all_y} == set(range(3000))


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(30):
        base = [word() for _ in range(rng.choice([4, 30, 120, 400]))]
        for _ in range(rng.choice([1, 3, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    hot = [word() for _ in range(600)]
    texts += [" ".join([*hot[:i], word(), *hot[i + 1 :]]) for i in range(150)] + [" ".join(hot)] * 40
    return texts + ["", None, "  "]


@pytest.mark.parametrize("crowd", [simhash.CROWD, 8])
def test_components(spark, crowd):
    texts = corpus()
    rows = [(i * 13 % 1009, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (5, texts[3], "x"), (5, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, crowd=crowd).collect()))
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    group = brute_components(fps, 3)
    least = {}
    for (d, _, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    want = sorted((d is None, d or 0, f"{f:016x}", least[g]) for (d, _, _), f, g in zip(rows, fps, group))
    assert got == want


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
