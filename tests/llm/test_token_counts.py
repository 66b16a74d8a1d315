"""Token counts against the library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import sentencepiece

from partwise.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_counts(spark):
    rng = random.Random(3)
    odd = [None, "", " ", "a  b ", "<s> hi</s>", "x▁y ▁", "日本語 🙂", "a\x00b\n\n c", "\t tab", "ééé é"]
    texts = odd + [" ".join(rng.choice(["the", "Straße", "a,b", "x\ny", "🙂🙂", "", "www.example.com/abc"]) for _ in range(n)) for n in (50, 200, 900, 1500)]
    texts += ["nobreak" * 900, "word " * 300 + "y" * 700 + " word" * 300, " " * 1500, "日本" * 800]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(12, texts[12], 2), (None, texts[13], 3), (None, "short", 3), (13, "other " * 400, 1)]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = token_counts.count_tokens(docs, PATH, limit=500, size=256, overlap=8).collect()
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "")), n > 500) for d, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_boundary_proof():
    assert token_counts.spliceable(PATH)
    model = token_counts._model(PATH)
    assert model.stable("ab cd", 2) and not model.stable("there", 2)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.count_tokens(docs, PATH).count() == 0
