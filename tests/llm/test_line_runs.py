"""Line dedup by whole runs against a brute-force pass over documents in order."""

from __future__ import annotations

import random

from partwise.llm import line_runs
from partwise.llm import queries as Q


def brute(rows):
    """Texts after removal, by pairs of lines in doc_id order (each doc_id once)."""
    first, out = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        at, drop = [i for i, x in enumerate(lines) if x.strip()], set()
        for k, (i, j) in enumerate(zip(at, at[1:])):
            where = first.setdefault((lines[i], lines[j]), (doc_id, k))
            if where != (doc_id, k):
                drop |= {j} if where == (doc_id, k - 1) else set(range(i, j + 1))
        out[doc_id] = (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in drop), sum(i in drop for i in at))
    return out


def line(rng):
    return " ".join(rng.choice(["ab", "cd", "é", "fgh", "ij"]) for _ in range(6)) + str(rng.random())


def test_removal(spark):
    rng = random.Random(3)
    passages = [[line(rng) for _ in range(n)] for n in (2, 3, 4, 5, 7, 20)]
    rows = []
    for i in range(90):
        own = [line(rng) for _ in range(rng.choice([1, 2, 5, 9]))]
        cut = rng.randrange(len(own) + 1)
        own[cut:cut] = passages[i % 6] if i % 3 else []
        if i % 5 == 0:
            own.insert(1, "")
        rows.append((i, "\n".join(own)))
    rows += [(100, rows[4][1]), (102, None), (103, ""), (104, "\n\n"), (105, "one line"), (106, "one line"), (107, "same\n" * 300), (108, "\nsame\n" * 300)]
    docs = spark.createDataFrame([(d, t, "x", d, [1]) for d, t in rows], "doc_id bigint, text string, key string, at int, gone array<int>")
    got = {r.doc_id: r for r in line_runs.dedup_runs(docs, "all_lines", "removed").collect()}
    assert {d: (r.text, r.removed) for d, r in got.items()} == brute(rows)
    assert got[0].key == "x" and got[107].text == "same\nsame\n" and got[106].text == "one line" and got[100].text.strip() == ""


def test_short_passages_go_whole(spark, scratch):
    """Each passage is removed from its second document on, head and tail too, and stays in its first."""
    rng = random.Random(4)
    passages = [[line(rng) for _ in range(n)] for n in (2, 2, 3, 3, 4, 5, 6, 10)]
    rows = []
    for copy in range(3):
        for k, passage in enumerate(passages):
            rows.append((copy * 100 + k, "\n".join([*(line(rng) for _ in range(5)), *passage, *(line(rng) for _ in range(6))])))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r.n_removed_lines for r in Q.op5_line_dedup(spark, scratch).collect()}
    assert got == {copy * 100 + k: len(passage) if copy else 0 for copy in range(3) for k, passage in enumerate(passages)}


def test_identical_rows(spark):
    text = "a1\nb2\nc3\nd4"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (None, "z\ny")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_removed_lines) for r in line_runs.dedup_runs(docs).collect())
    assert got == [(0, 0), (0, 0), (1, 4), (1, 4), (2, 4)]


def test_shared_hashes(spark):
    rows = [(1, b"a"), (1, b"a"), (2, b"b"), (2, b"c"), (2, b"c")]
    assert [r.h for r in line_runs.shared_hashes(spark.createDataFrame(rows, "h bigint, body binary")).collect()] == [2]


def test_empty(spark):
    assert line_runs.dedup_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
