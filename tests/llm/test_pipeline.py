"""The pipeline's stages against brute force on small tables; run() against its own stages."""

from __future__ import annotations

import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests_llm_brute import brute_leaks, brute_lines, brute_simhash_keep

PATH = public_tokenizers.path("word_bpe_49k.json")
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(23)
    vocabulary = ["lorem", "ipsum,", "dolor", "Sit", "amet.", "of", "the", *(f"w{i}" for i in range(4000))]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(25)) for i in range(10)]
    passage = [line(12) for _ in range(10)]
    docs, labels = [], []
    for i in range(240):
        lines = [line(rng.choice([8, 15])) for _ in range(rng.choice([3, 6, 12]))]
        bad = i % 6 == 0
        if i % 7 == 1:
            lines[1:1] = passage
        if i % 11 == 2:
            lines[1] += " " + items[i % 10][1]
        text = "\n".join(" ".join(w.upper() + "!!" for w in x.split()) if bad else x for x in lines)
        docs.append((i, text))
        labels.append((i, int(not bad), 0))
    docs += [(300, docs[1][1]), (301, docs[2][1]), (302, docs[3][1] + " more"), (303, " ".join(docs[4][1].split()[:-1])), (304, docs[5][1].replace("\n", " "))]
    return [(d, t, "en", f"s{d % 3}", len(t)) for d, t in docs], labels, items


@pytest.fixture(scope="module")
def sf_dir(spark):
    root = tempfile.mkdtemp(prefix="partwise-test-pipeline-")
    docs, labels, items = corpus()
    spark.createDataFrame(docs, DDL).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_run(spark, sf_dir):
    docs, labels, items = corpus()
    truth = dict((d, q) for d, q, _ in labels)
    # Stage 1 separates the labels of this corpus, so brute force may take the truth.
    rows = [(d, t) for d, t, *_ in docs if truth.get(d, 1)]
    rows = brute_lines(rows)
    rows = brute_simhash_keep(rows)
    rows = [(d, t) for d, t in rows if not brute_leaks(t, [x for _, x in items])]
    library = Tokenizer.from_file(PATH)
    want = {d: np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4") for d, t in rows}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(want)
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    assert all(zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in got)


def test_stages_keep_columns_and_odd_rows(spark, sf_dir):
    odd = [(1, None, None, None, None), (None, "", "en", None, 0), (None, None, None, "s", None), (2, "x " * 40000, "en", "s", 80000), (2, "x " * 40000, "en", "s", 80000)]
    docs = spark.createDataFrame([(*r, [1]) for r in odd], DDL + ", key array<int>")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            done = stage(spark, rows, sf_dir)
            assert done.columns == docs.columns and done.count() <= len(odd)
        assert corpus_pipeline.STAGES[0][1](spark, rows, sf_dir).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() >= 0
    kept = corpus_pipeline.distinct_documents(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept) == [(1, 0), (2, 80000)]
