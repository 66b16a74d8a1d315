"""Registered queries of the operators and their DuckDB oracle SQL (where SQL can express them)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import collocations, decontaminate, html_blocks, hyperminhash, licenses, line_rules, line_runs, merkle, packing, quality, simhash, token_counts, token_store
from partwise.llm.common import table

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document written as a compressed store and read back."""
    return token_store.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=1)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), limit=4096)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items held by documents: where, how long, how many words equal. Documents without a leak have no row."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", "n_matched")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those removed as repeated runs, and a digest of the text left."""
    done = line_runs.dedup_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    left = F.coalesce("text", F.lit(""))
    return done.select(
        "doc_id", "n_lines", "n_removed_lines", F.char_length(left).cast("bigint").alias("n_chars"), F.crc32(left.cast("binary")).alias("text_crc32"),
        (F.col("n_lines") == F.col("n_removed_lines")).alias("nothing_left"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return line_rules.judge(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=2, capacity=4096)


def op11_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle-set size and near-duplicate component of every document."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), percent=80)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and folded proof of every document."""
    return merkle.audit(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lang's best collocations of two and three words."""
    return collocations.mine(table(spark, sf_dir, "documents"), least=10, share=50, top=2000)


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_token_counts": op2_token_counts,
    "op3_simhash": op3_simhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_text": op6_html_text,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_packing": op10_packing,
    "op11_hyperminhash": op11_hyperminhash,
    "op12_merkle": op12_merkle,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL: dict[str, str] = {"op7_quality_rules": line_rules.oracle_sql(), "op9_license_scan": licenses.oracle_sql(), "op12_merkle": merkle.oracle_sql(), "op13_collocations": collocations.oracle_sql()}
