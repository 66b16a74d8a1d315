"""Decontamination: planted passages, exact and with substitutions; brute force along all diagonals."""

from __future__ import annotations

import random
import re

from partwise.llm import decontaminate as D

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def brute(doc, item):
    """Best stretch over all diagonals, by the operator's score and limits."""
    lower = lambda t: [w.encode() for w in WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))]
    d, i = lower(doc), lower(item)
    found = [D.best_stretch(d, i, k) for k in range(-len(i) + D.MIN_MATCH, len(d) - D.MIN_MATCH + 1)] if i and d else []
    found = [(m, -n, -s) for s, n, m in found if m >= D.MIN_MATCH and m >= D.MIN_IDENTITY * n]
    return max(found, default=None)


def corpus():
    rng = random.Random(17)
    text = lambda n: " ".join(rng.choice(["the", "of", "and", *(f"w{k}" for k in range(3000))]) for _ in range(n))
    items = [(i, text(rng.randrange(15, 60)).capitalize() + ".") for i in range(20)] + [(20, "too short an item"), (21, None), (22, ""), (3, text(30))]
    docs = [(i, text(rng.choice([0, 5, 60, 400]))) for i in range(80)]
    for i in range(40):
        words = (items[i % 20][1]).split()
        for k in range(4, len(words), 9) if i >= 20 else []:
            words[k] = "changed"
        own = docs[i][1].split()
        docs[i] = (i, " ".join([*own[: len(own) // 2], *words, *own[len(own) // 2 :]]).upper().replace(" ", ",\n"))
    docs += [(200, None), (201, ""), (0, docs[1][1]), (None, docs[2][1]), (0, docs[1][1]), (300, "x " * 6000 + items[5][1]), (301, items[5][1] + " middle " + items[6][1])]
    return docs, items


def test_leaks(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, doc_id int")
    got = sorted({(r.doc_id is None, r.doc_id or 0, r.item_id, r.start_word, r.n_words, r.n_matched) for r in D.leaks(d, b).collect()})
    want = set()
    for doc_id, text in docs:
        by_id = {}
        for item_id, item in items:
            if (x := brute(text, item)) and len((item or "").split()) >= 9:
                by_id[item_id] = max(x, by_id.get(item_id, x))
        want |= {(doc_id is None, doc_id or 0, i, -s, -n, m) for i, (m, n, s) in by_id.items()}
    assert got == sorted(want)
    assert {x[1] for x in got if not x[0]} >= set(range(40))

    clean = D.without_leaks(d, b)
    assert clean.columns == d.columns
    assert sorted(r.doc_id for r in clean.collect()) == [*range(40, 80), 200, 201]


def test_empty(spark):
    d, b = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    assert D.leaks(d, b).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert D.without_leaks(one, b).count() == 1 and D.leaks(d, spark.createDataFrame([(1, "w " * 40)], "item_id bigint, text string")).count() == 0
