"""Quality rules: base counts by brute force, shared lines, odd rows."""

from __future__ import annotations

import re
from collections import Counter

from partwise.llm import line_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in line_rules.SYMBOLS), dup, len(covered), failed


def test_base(spark):
    texts = [
        None, "", " \n\x0b\x0c", "one", "a b c a b c", "a b c a b c a", "x y x y x y x y", "é\x85ü #tag $5 <b>|&%*", "l1\nl1\n l1\nl1 \n\n\nl2\nl2", "日本 語 \x1c z",
        " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 7}" for i in range(90)), "long " * 40000, "\n".join(f"line {i % 40} of text" for i in range(3000)),
    ]
    rows = [(i, t, None if i % 3 == 0 else "s", 1) for i, t in enumerate(texts)] + [(4, texts[10], "s", 1), (4, texts[10], "s", 1), (None, texts[10], None, 1)]
    got = line_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string, lines int")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted([tuple(r)[:7] for r in got], key=key) == sorted([(d, *brute(t)) for d, t, _, _ in rows], key=key)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_shared_lines(spark):
    body = lambda i: " ".join(f"d{i}w{k}" for k in range(200))
    boiler = "\n".join(" ".join(f"shared{j}x{k}" for k in range(12)) for j in range(6))
    rows = [(i, f"{body(i)}\n{boiler if i < 40 else ''}", "a") for i in range(300)]
    rows += [(1000 + i, f"few own words {i}\n{boiler.upper()}", "a") for i in range(5)]  # depleted, in another case
    rows += [(2000 + i, body(5000), "a") for i in range(60)]  # copies of one text are one document
    rows += [(3000, f"few own words\n{boiler}", "b")]  # not frequent in this host
    got = {r.doc_id: r for r in line_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert all(got[i].kept and got[i].words_left == 200 for i in range(300))
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(5))
    assert all(got[2000 + i].kept for i in range(60)) and got[3000].kept


def test_a_line_is_judged_alike_on_small_and_hot_hosts(spark):
    """A passage in 30 documents goes whether its host has 200 or 4,000; one in 12 goes by its share of a small host only."""
    body = lambda h, i: " ".join(f"{h}{i}w{k}" for k in range(60))
    common, rare = (" ".join(f"{name}{k}" for k in range(80)) for name in ("common", "rare"))
    rows = []
    for host, size in (("small", 200), ("hot", 4000)):
        for i in range(size):
            more = f"\n{common}" if i < 30 else f"\n{rare}" if i < 42 else ""
            rows.append((len(rows), body(host, i) + more, host))
    got = {r.doc_id: r for r in line_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    for first, rare_goes in ((0, True), (200, False)):
        assert all(not got[first + i].kept and not got[first + i].base_failed and got[first + i].words_left == 60 for i in range(30))
        assert all(got[first + i].kept != rare_goes for i in range(30, 42))
        assert all(got[first + i].kept for i in range(42, 200))


def test_empty(spark):
    assert line_rules.judge(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0
