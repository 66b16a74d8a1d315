"""Packing: every id once, crc by brute force, gapless offsets, little padding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from partwise.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("capacity", [1, 2, 7, 16, 4096])
def test_cuts_cover(capacity):
    for n in [*range(1, 200), 4095, 4096, 4097, 50_000]:
        got = packing.cuts(n, capacity)
        assert sum(got) == n and all(0 < x <= capacity for x in got)


@pytest.mark.parametrize("fan", [packing.FAN, 2])
def test_pack(spark, monkeypatch, fan):
    monkeypatch.setattr(packing, "FAN", fan)
    rng = random.Random(1)
    words = ["alpha", "beta,", "gamma", "Delta's", "x1", "émile"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 300, 900]))), i) for i in range(400)]
    rows += [(5, "twice", 1), (5, "twice", 1), (None, None, 1), (1000, "long one " * 9000, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, offset int")
    got = packing.pack(docs, PATH, 2, 256).collect()
    library = Tokenizer.from_file(PATH)
    ids_of = lambda t: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
    want = defaultdict(list)
    for d, t, _ in rows:
        want[d].append(ids_of(t))
    assert sum(r.length for r in got) == sum(len(x) for xs in want.values() for x in xs)
    for r in got:
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in want[r.doc_id])
    single = defaultdict(list)
    for r in got:
        if len(want[r.doc_id]) == 1:
            single[r.doc_id].append((r.start, r.length))
    for d, parts in single.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(want[d][0])
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    tokens = sum(r.length for r in got)
    assert len(by_sequence) * 256 <= 1.04 * tokens + 256


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(docs, PATH).count() == 0
