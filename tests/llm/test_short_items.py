"""Decontamination: items of few words, whole and with a substitution."""

from __future__ import annotations

from partwise.llm import decontaminate as D


def test_short_items(spark):
    item = lambda n: [f"i{n}w{k}" for k in range(n)]
    items = [(n, " ".join(item(n))) for n in (1, 2, 5, 8, 9, 10, 11, 12, 13)] + [(20, ""), (21, None)]
    fill = " ".join(f"f{k}" for k in range(70))
    docs, want = [], set()
    for n in (1, 2, 5, 8, 9, 10, 11, 12, 13):
        docs.append((n, f"{fill} {' '.join(item(n)).upper()}, {fill} {' '.join(item(n))} {fill}"))
        want.add((n, n, 70, n, n))
    for n in (10, 11, 12, 13):
        for k in range(n):
            words = item(n)
            words[k] = "changed"
            docs.append((n * 100 + k, f"{fill} {' '.join(words)} {fill}"))
    docs += [(5000 + n, f"{fill} {' '.join(item(n)[:-1])} {fill}") for n in (2, 5, 8)]  # not whole
    docs.append((6000, " ".join(f"{' '.join(item(13)[:7])} x{k} x x" for k in range(3))))  # too few equal words
    got = {(r.doc_id, r.item_id, r.start_word, r.n_words, r.n_matched) for r in D.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert {x for x in got if x[0] < 100} == want
    changed = {x[:2] for x in got if x[0] >= 100}
    assert {(n * 100 + k, n) for n in (10, 11, 12, 13) for k in range(n)} == changed
