"""Token store: exact round trip, order, ties, short-document access."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from partwise.llm import token_store
from partwise.llm.wordbpe import Encoder, encoder
from partwise.session import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "Hello, it's WORLD's 2nd don't!", "x" * 300, "a b c", "é é ́x Σας ΌΣ İstanbul ǅ ŉ", "<|endoftext|> a<|startoftext|>b <|x|>",
    "a\x1cb\x85c\x0bd", "日本語 text 123 ½ ² ªº µ", "don't'll 're 's\t\n\r 'VE", "한국어 🙂🙂 #$%&*", "mot&&& a.b,c;d 12abc34", "\u0000 null ﻿ bom", "ǰ ß ſ K Å",
]


def brute(text, end=1):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [end]
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("text", [t for t in ODD if t is not None])
def test_memo_equals_library(text):
    assert encoder(PATH).ids(text.encode()) == brute(text)[:-4]


def test_batch_equals_library():
    each = [f"{chr(c)} a{chr(c)} {chr(c)}B. {chr(c)}<|" for c in range(1, 0x260)]
    texts = [t.encode() for t in [*(x or "" for x in ODD), *each]] + [b"\xff\xfe x", b"abc\xff. abc\xc3 x", b"  two  spaces  "]
    library = Tokenizer.from_file(PATH)
    wanted = [library.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
    for first in (0, 3):  # an array that is a slice of another
        ids, offsets = encoder(PATH).batch(pa.array(texts, pa.binary())[first:])
        assert [ids[s:e].tolist() for s, e in zip(offsets[:-1], offsets[1:])] == wanted[first:]
    assert [len(x) for x in encoder(PATH).batch(pa.array([], pa.binary()))] == [0, 1]


def test_batch_looks_a_run_up_once(monkeypatch):
    """However often, and in however many spellings, a run stands in the texts."""
    fresh, asked = Encoder(PATH), []
    unit = Encoder.unit
    monkeypatch.setattr(Encoder, "unit", lambda self, run: asked.append(run) or unit(self, run))
    ids, offsets = fresh.batch(pa.array([f"Word word. WORD, other{'!' * (i % 3)} wOrd!".encode() for i in range(500)], pa.binary()))
    assert len(asked) == len(set(asked)) == 7  # word, other, no marks and . , ! !!
    assert ids[: offsets[1]].tobytes() == brute("Word word. WORD, other wOrd!")[:-4]


def test_round_trip(spark):
    rows = [(i * 7 % 15, t, "x", i) for i, t in enumerate(ODD)] + [(3, "tie one", "x", 1), (3, "tie one", "x", 1), (None, "no id", "x", 1), (99, "long " * 70000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, file string, n_tokens int")
    path = shared_dir(spark, "t")
    token_store.write_store(docs, path, PATH, 1, files=3)
    got = sorted(token_store.read_store(spark, path).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x) and len(got) == len(rows)
    assert sorted((r[0] is None, r[0], brute(r[1])) for r in rows if r[0] is not None) == sorted((False, r.doc_id, bytes(r.ids)) for r in got if r.doc_id is not None)
    digest = {(r.doc_id, r.start, r.ids_crc32) for r in token_store.read_digests(spark, path).collect()}
    assert digest == {(r.doc_id, r.start, zlib.crc32(bytes(r.ids))) for r in got}
    some = token_store.lookup(spark, path, [3, 99]).collect()
    assert sorted((r.doc_id, r.start) for r in some) == sorted((r.doc_id, r.start) for r in got if r.doc_id in (3, 99))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_store.token_digests(docs, PATH, 1).count() == 0
