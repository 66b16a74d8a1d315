"""Collocations by the graph against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from partwise.llm import collocations

DDL = "doc_id bigint, text string, lang string"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\x0a-\x0d]", low):
        words = re.findall("[^\x20\x09]+", piece)
        if words:
            yield words


def brute(rows, least=10, share=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        for words in pieces(text):
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in found.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    held[q] = max(held[q], a)
        rows = []
        for p, a in found.items():
            if 100 * held[p] >= share * a:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, docs, vocabulary, length):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "la", "LA"]
    weights = [1 / (i + 1) for i in range(len(words))]
    passage = " ".join(f"p{i}" for i in range(12))
    rows = []
    for i in range(docs):
        text = ""
        for w in rng.choices(words, weights, k=rng.randrange(length)):
            text += w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "])
        if i % 5 == 0:
            text += rng.choice([". ", " "]) + passage + rng.choice([".", " "]) + text[:30]
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("seed, vocabulary", [(1, 6), (2, 60)])
def test_against_counting(spark, seed, vocabulary, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 500)
    monkeypatch.setattr(collocations, "SAMPLE", 1.0)  # some nodes are hot
    monkeypatch.setattr(collocations, "HOT_SHARE", 1 / 20)
    rows = corpus(seed, 300, vocabulary, 60)
    wanted = brute(rows)
    assert len(wanted) > 30
    assert result(collocations.mine(spark.createDataFrame(rows, DDL).repartition(3))) == wanted


def test_top_least_and_share(spark):
    rows = corpus(3, 200, 30, 50)
    assert result(collocations.mine(spark.createDataFrame(rows, DDL), least=4, share=90, top=7)) == brute(rows, 4, 90, 7)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (None, "", None), (2, " \t ", "en"), (3, ".;!?\n", "fr"), (3, "one", "fr"), (3, "one", "fr")]
    rows += [(4, "la " * 5000, "fr"), (5, "A b. " * 12 + "x" * 3000 + " y " * 11, None), (6, "a b, " * 3, "und"), (7, "a\x0bb a\x0cb", "en")]
    df = spark.createDataFrame(rows, DDL)
    assert result(collocations.mine(df)) == brute(rows)
    clash = df.withColumns({c: F.lit(1) for c in ("word", "id", "n", "w1", "lang_hash", "rank")})
    assert result(collocations.mine(clash)) == brute(rows)


def test_empty(spark):
    assert collocations.mine(spark.createDataFrame([], DDL)).collect() == []


def test_unary_paths(spark):
    """The nodes of a fixed passage form one path, numbered in their order."""
    rows = [(i, f"x{i} a b c d e f g y{i}", "en") for i in range(12)]
    df = spark.createDataFrame(rows, DDL).select(F.lit(5).cast("bigint").alias("lang_hash"), F.col("text").cast("binary").alias("text"))
    edges, nodes, words = collocations.graph(df, 10)
    paths, marked = collocations.compact(edges, nodes)
    found = paths.collect()
    assert sorted(r.at for r in found) == [1, 2, 3, 4] and len({(r.first1, r.first2) for r in found}) == 1
    assert sorted((r.from_inner, r.to_inner) for r in marked.collect()) == [(False, True), (True, False), (True, True), (True, True), (True, True)]


def test_equal_hashes_are_seen(spark):
    """With hashes of 4 bits words collide at the first attempts; the result is that of an attempt without."""
    rows = corpus(4, 60, 40, 60)
    assert result(collocations.mine(spark.createDataFrame(rows, DDL), least=3, bits=4)) == brute(rows, 3)
