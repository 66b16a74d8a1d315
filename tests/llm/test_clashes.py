"""Columns of documents whose names meet those the stages use inside: kept, with their values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partwise.llm import decontaminate, line_runs

NAMES = """__raw __id __n __removed __lines __text_hash __gone __hash __doc_id raw own_hash gone gone_id gone_hash n lost lines removed
leak_id leak_hash Found_ID found_hash own_id text_bytes id_hash row key root at set text_hash fp item_id""".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clashes"))
    body = "\n".join(f"line {k} of a passage with some words in it" for k in range(4))
    leak = " ".join(f"t{k}" for k in range(20))
    rows = [(i, f"own text number {i} with words {i * 7} and {i * 13}\nsecond line {i}\n{body}" if i % 2 else f"plain {i} text {i * 3}\nof two lines {i}", "en", "s", 10) for i in range(30)]
    rows += [(40, f"before {leak} after", "en", "s", 10), (41, rows[1][1], "en", "s", 10), (None, None, None, None, None)]
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs, docs.withColumns({c: F.lit(c) for c in NAMES}), root


def _rows(df, names):
    return sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in names]).collect()))


@pytest.mark.parametrize("number", range(4))
def test_stages(spark, tables, number):
    docs, wide, root = tables
    stage = corpus_pipeline.STAGES[number][1]
    plain, done = stage(spark, docs, root), stage(spark, wide, root)
    assert done.columns == wide.columns
    assert _rows(done, docs.columns) == _rows(plain, docs.columns)
    assert all(r[c] == c for r in done.collect() for c in NAMES)


def test_operators_that_keep_columns(spark, tables):
    docs, wide, root = tables
    done = line_runs.dedup_runs(wide, "a_lines", "a_removed")
    assert done.columns == [*wide.columns, "a_lines", "a_removed"]
    assert _rows(done, docs.columns) == _rows(line_runs.dedup_runs(docs), docs.columns)
    items = spark.read.parquet(f"{root}/benchmark.parquet")
    assert decontaminate.without_leaks(wide, items).count() == docs.count() - 1


def test_short_items_remove_nothing(spark):
    docs = spark.createDataFrame([(1, "yes"), (2, "no, yes and no"), (3, "a b c d e f g h"), (4, "z")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "Yes"), (2, "a b c d e f g h"), (3, None), (4, " ")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == {(1, 1), (2, 1), (3, 2)}
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items).collect()) == [1, 2, 4]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items, min_item_words=1).collect()) == [4]
    assert decontaminate.without_leaks(docs, items, min_item_words=9).count() == 4
