"""Merkle manifest: trees, proofs and audit against a plain recomputation."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from partwise.llm import merkle

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def tree(hashes):
    """(top, siblings of each leaf as (sibling is before, hash) or None a level)."""
    paths, at, now = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(now) > 1:
        for path, i in zip(paths, at):
            path.append((i % 2 == 1, now[i ^ 1]) if i ^ 1 < len(now) else None)
        now = [sha("".join(now[i : i + 2])) for i in range(0, len(now), 2)]
        at = [i // 2 for i in at]
    return now[0], paths


def brute(rows):
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        langs.setdefault(lang, []).append((doc_id, leaf_of(doc_id, source, lang, n_chars, text), (source, n_chars, text)))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        made[lang] = tree([r[1] for r in langs[lang]])
    if not order:
        return []
    root, above = tree([made[x][0] for x in order])
    out = []
    for lang, up in zip(order, above):
        for (doc_id, leaf, (source, n_chars, text)), path in zip(langs[lang], made[lang][1]):
            path = path + up
            now = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None:
                now = leaf_of(doc_id, source, lang, n_chars + 1, text)
            for step in path:
                now = sha(now if step is None else step[1] + now if step[0] else now + step[1])
            proof = sha("".join(step[1] for step in path if step))
            out.append((doc_id, leaf, made[lang][0], root, proof, now, now == root))
    return out


def result(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def same(spark, rows):
    assert result(merkle.audit(spark.createDataFrame(rows, DDL))) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (7, 4, 2, 1, 9), (1025, 1024, 3)])
def test_sizes(spark, sizes):
    rows = [(1000 * k + i, f"text {k} {i}", ("", "de", "fr", None, "é")[k], f"s{i % 3}", i) for k, n in enumerate(sizes) for i in range(n)]
    same(spark, rows[::-1])


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (None, "no id", "en", "s", 5), (None, None, "en", None, None), (3, "", "", "", 0),
        (7, "x" * 300_000, "en", "s", 300_000), (7, "another", "en", "s", 7), (7, "another", "en", "s", 7),
        (-5, "négative 😀", "en", "s", 9), (2**62, "large", "de", "s", 2**40), (11, "a:b", "en", "1:s", 3),
    ]
    same(spark, rows)


def test_empty(spark):
    assert merkle.audit(spark.createDataFrame([], DDL)).collect() == []


def test_tampered_rows_fail(spark):
    rows = [(i, f"t{i}", "en", "s", i if i % 5 else None) for i in range(200)]
    found = {r.doc_id: r.verified for r in merkle.audit(spark.createDataFrame(rows, DDL)).collect()}
    bad = {i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0 and i % 5}
    assert {i for i, ok in found.items() if not ok} == bad and bad


def test_extra_columns_and_shuffled_ancestors(spark, monkeypatch):
    """Clashing column names are left out; with nothing broadcast the jumps are shuffled joins and give the same."""
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    rows = [(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(300)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], DDL + ", pos int, tree int, key int, serial int, path int")
    assert result(merkle.audit(df)) == sorted(brute(rows), key=repr)


def test_proof_sets(spark):
    """A manifest's path folds to the root by itself."""
    rows = [(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(50)]
    for r in merkle.manifest(spark.createDataFrame(rows, DDL)).collect():
        assert merkle.fold(bytes(r.leaf).hex().encode(), bytes(r.path)).decode() == bytes(r.root).hex()
