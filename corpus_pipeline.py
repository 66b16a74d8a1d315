"""The corpus pipeline: documents in, packed sequences out, one operator a stage.

Each stage takes all that the one before it kept and returns the columns of
documents (the last one: pieces of sequences). Stages handle odd rows as their
operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import decontaminate, line_runs, packing, quality, simhash
from partwise.llm.common import fresh, stored, table
from partwise.session import configure


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(configure(spark), sf_dir, "labels"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; one of which nothing is left goes. n_chars is that of the new text."""
    configure(spark)
    lines, removed = fresh(docs, "lines", "removed")
    done = line_runs.dedup_runs(docs, lines, removed).filter(f"`{lines}` = 0 or `{removed}` < `{lines}`")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col(removed) > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return done.drop(lines, removed)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    configure(spark)
    return simhash.one_of_each(docs, shingle=3, distance=3)


def without_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(configure(spark), sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of 4096."""
    configure(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [
    ("quality classifier", good),
    ("line dedup", distinct_lines),
    ("SimHash near-dedup", distinct_documents),
    ("benchmark decontamination", without_tests),
    ("packing", packed),
]
#: The learned scores, similarity groups and tokenizer have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
