"""Registered queries on the smallest tables: oracle SQL where there is one, else whole brute force of a column or two."""

from __future__ import annotations

import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from partwise.llm import queries as Q
from test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {name} as select * from read_parquet('{SF_SMALL}/{name}.parquet')")
    return con


@pytest.fixture(scope="module")
def docs(db):
    return db.execute("select doc_id, coalesce(text, '') from documents order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_oracle(spark, db, name):
    got = Q.QUERIES[name](spark, SF_SMALL)
    want = db.execute(Q.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    rows = [tuple(r[d[0]] for d in want.description) for r in got.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want.fetchall()))


def test_token_queries(spark, docs):
    word = Tokenizer.from_file(public_tokenizers.path(Q.WORD_BPE))
    ids = {d: np.array(word.encode(t, add_special_tokens=False).ids, "<u4") for d, t in docs}
    stored = {r.doc_id: r for r in Q.op1_token_store(spark, SF_SMALL).collect()}
    at = 0
    for d, _ in docs:
        whole = np.append(ids[d], np.uint32(1)).astype("<u4")
        assert tuple(stored[d]) == (d, at, len(whole), zlib.crc32(whole.tobytes()))
        at += len(whole)
    pieces = Q.op10_packing(spark, SF_SMALL).collect()
    for r in pieces:
        whole = np.append(ids[r.doc_id], np.uint32(2)).astype("<u4")
        assert r.doc_tokens == len(whole) and r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())
    total = sum(len(x) + 1 for x in ids.values())
    assert sum(r.length for r in pieces) == total
    assert len({r.sequence_id for r in pieces}) * 4096 < 1.1 * total + 4096
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(Q.PIECE_BPE))
    counted = {tuple(r) for r in Q.op2_token_counts(spark, SF_SMALL).collect()}
    assert counted == {(d, len(t.encode()), n := len(library.encode(t)), n > 4096) for d, t in docs}


def test_simhash_query(spark, docs):
    fps = [brute_fingerprint(t) for _, t in docs]
    group = brute_components(fps, 3)
    least = {}
    for (d, _), g in zip(docs, group):
        least[g] = min(d, least.get(g, d))
    got = {tuple(r) for r in Q.op3_simhash(spark, SF_SMALL).collect()}
    assert got == {(d, f"{f:016x}", least[g]) for (d, _), f, g in zip(docs, fps, group)}


def test_leak_query(spark, db, docs):
    """Exact passages of the benchmark, found word by word."""
    word = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    items = [(i, " ".join(word.findall(t.lower()))) for i, t in db.execute("select item_id, text from benchmark").fetchall()]
    want = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {' '.join(word.findall(t.lower()))} "}
    got = {(r.doc_id, r.item_id) for r in Q.op4_decontaminate(spark, SF_SMALL).collect()}
    assert want <= got and len(got) <= len(want) + 2


def test_other_queries_cover_their_tables(spark, db, docs):
    lines = {r.doc_id: r for r in Q.op5_line_dedup(spark, SF_SMALL).collect()}
    assert {d: sum(1 for x in t.split("\n") if x.strip(" \t\n\r\x0b\x0c")) for d, t in docs} == {d: r.n_lines for d, r in lines.items()}
    pages = Q.op6_html_text(spark, SF_SMALL).collect()
    assert len(pages) == db.execute("select count(*) from pages").fetchone()[0] and all(r.n_chars == len(r.text) for r in pages)
    scores = {r.doc_id: r for r in Q.op8_quality_classifier(spark, SF_SMALL).collect()}
    labels = dict(db.execute("select doc_id, quality from labels where quality is not null").fetchall())
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert set(scores) == {d for d, _ in docs} and {d for d, r in scores.items() if r.held_out} == {d for d, _ in docs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([scores[d].predicted == labels[d] for d in held]) >= 0.85
