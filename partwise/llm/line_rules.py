"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lowered, runs of white space to one space) and hashed.
Per host (``source``) the documents that hold a line are counted, a text that
occurs several times in a host once. A line in ENOUGH_DOCS documents of a host,
or in MIN_DOCS and MAX_SHARE of them, is taken out of them: on a small host the
share decides, on a large one the fixed count alone, so that a line is judged alike
however large its host grows. A document that keeps less than MIN_LEFT of its words
is depleted and rejected, as is one that fails the base rules (fewer than 50
words, or over half of them in repeated 3-word windows).

Counting works on hashes: a hot line leaves each map task as one row per
document, a hot host as one row per line. Texts are read once and never shuffled.

Cases: NULL text has no words and fails; NULL source is the host ''. Rows
sharing a doc_id are judged one by one. An empty table gives no rows. Extra
columns are ignored. A text is held whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import LOWER, PLAIN_WORD, column, flat, mix, slices, span_hashes, spans, stored, utf8

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_DOCS = 10
MAX_SHARE = 0.02
ENOUGH_DOCS = 30
MIN_LEFT = 0.5
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.array([chr(c) in SYMBOLS for c in range(256)])
_LOWER = LOWER.tobytes()

_MEASURED = (
    "doc_id bigint, host string, text_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, lines array<bigint>, line_words array<bigint>"
)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(row: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row the words in 3-word windows that occur twice or more in the row."""
    n = len(row)
    if n < 3:
        return np.zeros(n_rows, np.int64)
    at = np.flatnonzero(row[2:] == row[:-2])
    window = mix(hashes[at] * np.uint64(3) + mix(hashes[at + 1] * np.uint64(5) + mix(hashes[at + 2] + row[at].astype(np.uint64))))
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[at[again] + k] = True
    return np.bincount(row[covered], minlength=n_rows)


def _lines(text: bytes) -> tuple[int, list[int], list[int]]:
    """Repeated lines, and per line with a word the hash of its normal form and its words."""
    seen, dup, hashes, words = set(), 0, [], []
    for line in text.split(b"\n"):
        parts = line.split()
        if parts:
            dup += line in seen
            seen.add(line)
            hashes.append(xxhash.xxh64_intdigest(b" ".join(parts).translate(_LOWER)))
            words.append(len(parts))
    return dup, hashes, words


def measured(docs: DataFrame) -> DataFrame:
    """Per row the base counts, and its line hashes and line lengths."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text"):
                texts = column(batch, "text")
                data, offsets = flat(texts)
                start, end, row = spans(PLAIN_WORD[data], offsets)
                n = len(texts)
                points = PLAIN_WORD[data] & ((data & 0xC0) != 0x80)
                raw = texts.to_pylist()
                lines = [_lines(t) for t in raw]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "doc_id"), column(batch, "host"), pa.array(np.array([xxhash.xxh64_intdigest(t) for t in raw], np.uint64).view(np.int64)),
                        pa.array(np.bincount(row, minlength=n)), pa.array(_per_row(points, offsets)), pa.array(_per_row(_SYMBOL[data], offsets)),
                        pa.array([x[0] for x in lines], pa.int64()), pa.array(repeated_words(row, span_hashes(data, start, end), n)),
                        pa.array([np.array(x[1], np.uint64).view(np.int64) for x in lines], pa.list_(pa.int64())), pa.array([x[2] for x in lines], pa.list_(pa.int64())),
                    ],
                    [f.split()[0] for f in _MEASURED.split(", ")],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), utf8().alias("text"))
    return rows.mapInArrow(read, _MEASURED)


def frequent_lines(texts: DataFrame) -> DataFrame:
    """(host, line): lines over the limits, from one row per distinct text of a host."""
    size = texts.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    held = texts.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    return held.filter(F.col("n") >= MIN_DOCS).join(size, "host").filter((F.col("n") >= MAX_SHARE * F.col("docs")) | (F.col("n") >= ENOUGH_DOCS)).select("host", "line")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, words_left for every row."""
    rows = stored(measured(docs), "line-rules")
    # Copies of a text in a host are one text: lines are a function of text_hash.
    texts = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"), F.first("line_words").alias("line_words"))
    line = F.explode(F.arrays_zip("lines", "line_words")).alias("x")
    each = texts.select("host", "text_hash", line).select("host", "text_hash", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    lost = each.join(frequent_lines(texts), ["host", "line"]).groupBy("host", "text_hash").agg(F.sum("words").alias("lost"))
    judged = rows.drop("lines", "line_words").join(lost, ["host", "text_hash"], "left").withColumn("words_left", F.col("n_words") - F.coalesce("lost", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("words_left") >= MIN_LEFT * F.col("n_words"))).alias("kept"), "words_left",
    )


def oracle_sql() -> str:
    """The rules over ``documents`` in DuckDB SQL, on words and lines themselves."""
    word = r"[^ \t\n\x0B\f\r]+"
    return f"""
with d as (select row_number() over () r, doc_id, coalesce(source, '') host, coalesce(text, '') t from documents),
w as (select r, regexp_extract_all(t, '{word}') ws from d),
word as (select r, unnest(range(len(ws))) i, unnest(ws) a from w),
win as (select r, i, a, lead(a, 1) over (partition by r order by i) b, lead(a, 2) over (partition by r order by i) c from word),
rep as (select r, i, count(*) over (partition by r, a, b, c) n from win where c is not null),
cov as (select r, count(distinct i + k) n_repeat_words from rep, (select unnest([0, 1, 2]) k) where n > 1 group by r),
line as (select r, unnest(range(len(string_split(t, chr(10))))) line_no, unnest(string_split(t, chr(10))) l from d),
real as (select *, regexp_extract_all(l, '{word}') lw from line where regexp_matches(l, '{word}')),
dup as (select r, count(*) n_dup_lines from (select r, row_number() over (partition by r, l order by line_no) k from real) where k > 1 group by r),
txt as (select host, t, min(r) r from d group by host, t),
norm as (select txt.host, txt.t, r, line_no, len(lw) words, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') nl from real join txt using (r)),
host as (select host, count(*) docs from txt group by host),
freq as (select host, nl from (select host, nl, count(distinct r) n from norm group by host, nl) join host using (host) where n >= {MIN_DOCS} and (n >= {MAX_SHARE} * docs or n >= {ENOUGH_DOCS})),
lost as (select host, t, sum(words) lost from norm join freq using (host, nl) group by host, t)
select doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::bigint n_symbols,
    coalesce(n_dup_lines, 0)::bigint n_dup_lines, coalesce(n_repeat_words, 0)::bigint n_repeat_words,
    len(ws) < {MIN_WORDS} or 100 * coalesce(n_repeat_words, 0) > {MAX_REPEATED_PERCENT} * len(ws) base_failed,
    not (len(ws) < {MIN_WORDS} or 100 * coalesce(n_repeat_words, 0) > {MAX_REPEATED_PERCENT} * len(ws)) and len(ws) - coalesce(lost, 0) >= {MIN_LEFT} * len(ws) kept,
    (len(ws) - coalesce(lost, 0))::bigint words_left
from d join w using (r) left join cov using (r) left join dup using (r) left join lost using (host, t)
"""
