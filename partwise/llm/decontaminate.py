"""Benchmark decontamination by spaced-seed hashing.

Texts are words (letters and digits of any script, A-Z lowered). A mask is a
window over neighbouring words of which only the positions marked 1 are hashed;
a substitution at an ignored position leaves the hash unchanged. Hashes of all
windows of the test items are joined to those of all windows of the documents.
Around each hit the two word sequences are compared along its diagonal, and the
stretch that scores best (a match 1, a mismatch -2) is a leak if it has MIN_MATCH
equal words, or MIN_IDENTITY of the item's words if that is less, and MIN_IDENTITY
of its own words equal. Where the best stretch is not enough, the whole item beside
the document is: MIN_IDENTITY of its words in place are a leak too, however they are
spread. An item of fewer words than a mask spans is hashed whole and is a leak
where it stands word for word.

Items of few words stand in many documents by chance. ``leaks`` reports them;
``without_leaks`` removes a document only for items of MIN_ITEM_WORDS or more.

Document windows are hashed where the texts are read and pass a key filter of
fixed size made of the items' hashes, so what is joined is about as many rows as
there are true hits. Hits of a document come in regions with the words around
them; the check needs no second look at the text. The item side is broadcast
only below the session's measured limit, else shuffled.

Cases: NULL and empty texts have no words. Rows sharing a doc_id are told apart by their text;
identical rows give one result. Items are told apart by item_id and text. Empty
tables give no rows. Extra columns are ignored by ``leaks`` and kept by
``without_leaks``. A text is held whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import ALNUM_WORD, LOWER, column, flat, key_filter, mix, passes, rename_clashes, slices, span_hashes, spans, stored, utf8
from partwise.operators.joins import broadcast_if_small

#: Masks over 9 words that hash 6 of them (fixed values).
MASKS = ("110100111", "101110011", "111001101")
MIN_MATCH = 10
MIN_IDENTITY = 0.75
#: Words of the shortest item for which a document is removed.
MIN_ITEM_WORDS = 8
#: Words kept on either side of a region's hits; hits nearer than this share a region.
CONTEXT = 48

_LEAK = "doc_id bigint, text_hash bigint, item_id bigint, start_word bigint, n_words bigint, n_matched bigint"


def _exact(masks: tuple[str, ...], lengths: list[int]) -> dict[int, str]:
    """Masks that hash all words of a window of each length, by a number that no other mask has."""
    return {len(masks) + n: "1" * n for n in lengths}


def window_hashes(row: np.ndarray, words: np.ndarray, masks: dict[int, str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask the word indices at which a window fits into its row, and the hashes there."""
    for number, mask in masks.items():
        span = len(mask)
        if len(row) < span:
            continue
        at = np.flatnonzero(row[span - 1 :] == row[: len(row) - span + 1])
        h = np.full(len(at), number + 1, np.uint64)
        for k, picked in enumerate(mask):
            if picked == "1":
                h = mix(h + words[at + k])
        yield at, h


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = flat(column(batch, "text"))
    low = LOWER[data]
    start, end, row = spans(ALNUM_WORD[low], offsets)
    return low, start, end, row, span_hashes(low, start, end)


def _texts(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    if not len(start):
        return []
    base = int(start[0])
    raw = low[base : int(end[-1])].tobytes()
    return [raw[s - base : e - base] for s, e in zip(start.tolist(), end.tolist())]


def _item_seeds(masks: tuple[str, ...]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text"):
                low, start, end, row, words = _words(batch)
                first = np.searchsorted(row, np.arange(batch.num_rows))
                keys = column(batch, "item_key").to_numpy()
                n_words = np.bincount(row, minlength=batch.num_rows)
                span = len(masks[0])
                for exact, some in ((False, dict(enumerate(masks))), (True, _exact(masks, sorted(set(n_words[(0 < n_words) & (n_words < span)].tolist()))))):
                    for number, mask in some.items():
                        for at, h in window_hashes(row, words, {number: mask}):
                            if exact:
                                whole = n_words[row[at]] == len(mask)
                                at, h = at[whole], h[whole]
                            cols = [pa.array(h.view(np.int64)), pa.array(keys[row[at]]), pa.array(at - first[row[at]]), pa.array(np.full(len(at), exact))]
                            yield pa.RecordBatch.from_arrays(cols, ["h", "item_key", "item_at", "exact"])

    return read


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in batches:
        for batch in slices(big, "text"):
            low, start, end, row, _ = _words(batch)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
            words = [_texts(low, start[a:b], end[a:b]) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([column(batch, "item_key"), column(batch, "item_id"), pa.array(words, pa.list_(pa.binary()))], ["item_key", "item_id", "item_words"])


def _regions(masks: dict[int, str], wanted):
    """Hits of the key filter in each text, by region: its words, and the hashes with their places in it."""
    names = ["doc_id", "text_hash", "lo", "words", "h", "at"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for big in batches:
            for batch in slices(big, "text"):
                low, start, end, row, words = _words(batch)
                found = [(at[hit], h[hit]) for at, h in window_hashes(row, words, masks) if (hit := passes(bitmap, h)).any()]
                if not found:
                    continue
                at, h = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                cut = np.flatnonzero((np.diff(at) > CONTEXT) | (np.diff(row[at]) != 0)) + 1
                first = np.searchsorted(row, np.arange(batch.num_rows + 1))
                ids, hashes = (column(batch, c) for c in ("doc_id", "text_hash"))
                rows = []
                for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
                    r = int(row[at[s]])
                    lo, hi = max(int(first[r]), int(at[s]) - CONTEXT), min(int(first[r + 1]), int(at[e - 1]) + len(masks[0]) + CONTEXT)
                    rows.append((ids[r].as_py(), hashes[r].as_py(), lo - int(first[r]), _texts(low, start[lo:hi], end[lo:hi]), h[s:e].view(np.int64), at[s:e] - lo))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return read


def best_stretch(doc: list[bytes], item: list[bytes], diagonal: int) -> tuple[int, int, int]:
    """(start in doc, words, equal words) of the best-scoring stretch with doc[i + diagonal] beside item[i]."""
    lo, hi = max(0, diagonal), min(len(doc), len(item) + diagonal)
    same = np.array([doc[p] == item[p - diagonal] for p in range(lo, hi)], bool)
    total = np.concatenate(([0], np.cumsum(np.where(same, 1, -2))))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[: end + 1]))
    return lo + start, end - start, int(same[start:end].sum())


def whole_item(doc: list[bytes], item: list[bytes], diagonal: int) -> tuple[int, int, int]:
    """(start in doc, words, equal words) of the whole item beside the document; no words equal if it does not lie within."""
    if diagonal < 0 or diagonal + len(item) > len(doc):
        return max(0, diagonal), len(item), 0
    return diagonal, len(item), sum(a == b for a, b in zip(doc[diagonal:], item))


def least_match(n_item: int, span: int, min_match: int, min_identity: float) -> int:
    """Equal words that a leak of an item of ``n_item`` words has at least."""
    return n_item if n_item < span else min(min_match, int(min_identity * n_item))


def _verified(span: int, min_match: int, min_identity: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _LEAK.split(", ")]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                least = least_match(len(r["item_words"]), span, min_match, min_identity)
                for start, n, equal in (best_stretch(r["words"], r["item_words"], r["diagonal"]), whole_item(r["words"], r["item_words"], r["diagonal"])):
                    if equal >= min(least, n) and equal >= min_identity * n:
                        rows.append((r["doc_id"], r["text_hash"], r["item_id"], r["lo"] + start, n, equal))
                        break
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return read


def _keyed(docs: DataFrame) -> list:
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_match: int = MIN_MATCH, min_identity: float = MIN_IDENTITY) -> DataFrame:
    """doc_id, text_hash, item_id, start_word, n_words, n_matched: the best stretch of each item in each document that holds it."""
    spark = docs.sparkSession
    items = benchmark.select(F.xxhash64("item_id", F.coalesce("text", F.lit(""))).alias("item_key"), F.col("item_id").cast("bigint").alias("item_id"), utf8().alias("text")).dropDuplicates(["item_key"])
    seeds = stored(items.select("item_key", "text").mapInArrow(_item_seeds(masks), "h bigint, item_key bigint, item_at bigint, exact boolean"), "leak-seeds")
    item_words = stored(items.mapInArrow(_item_words, "item_key bigint, item_id bigint, item_words array<binary>"), "leak-items")
    wanted = spark.sparkContext.broadcast(key_filter(seeds, "h"))
    n = F.size("item_words")
    short = [r.n for r in item_words.filter((n > 0) & (n < len(masks[0]))).select(n.alias("n")).distinct().collect()]

    texts = docs.select(*_keyed(docs), utf8().alias("text"))
    schema = "doc_id bigint, text_hash bigint, lo bigint, words array<binary>, h array<bigint>, at array<bigint>"
    regions = texts.mapInArrow(_regions({**dict(enumerate(masks)), **_exact(masks, sorted(short))}, wanted), schema).withColumn("region", F.xxhash64("doc_id", "text_hash", "lo"))
    regions = stored(regions, "leak-regions")
    hit = regions.select("region", F.explode(F.arrays_zip("h", "at")).alias("x")).select("region", F.col("x.h").alias("h"), F.col("x.at").alias("at"))
    # An item found whole is as good at its first place in a region as at any other.
    diagonal = F.col("at") - F.col("item_at")
    diagonals = hit.join(broadcast_if_small(seeds), "h").groupBy("region", "item_key", F.when(~F.col("exact"), diagonal).alias("d")).agg(F.min(diagonal).alias("diagonal")).drop("d")
    sides = diagonals.join(regions.select("region", "doc_id", "text_hash", "lo", "words").dropDuplicates(["region"]), "region").join(broadcast_if_small(item_words), "item_key")
    found = sides.select("doc_id", "text_hash", "lo", "words", "item_id", "item_words", "diagonal").mapInArrow(_verified(len(masks[0]), min_match, min_identity), _LEAK)
    best = F.max(F.struct("n_matched", (-F.col("n_words")).alias("m"), (-F.col("start_word")).alias("s"))).alias("b")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", (-F.col("b.s")).alias("start_word"), (-F.col("b.m")).alias("n_words"), F.col("b.n_matched").alias("n_matched")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, min_item_words: int = MIN_ITEM_WORDS) -> DataFrame:
    """``docs`` without the documents that hold a leak of an item of ``min_item_words`` words or more; columns as they are."""
    # With one space around every word there is one space more than words.
    spaced = F.regexp_replace(F.concat(F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" ")), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+", " ")
    long = benchmark.select("item_id", "text").filter(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) - 1 >= min_item_words)
    found = leaks(docs, long).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct()
    found = stored(found, "leaks")
    rows = rename_clashes(docs, ["leak_id", "leak_hash"])
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("leak_id")) & (text_hash == F.col("leak_hash"))
    return rows.join(broadcast_if_small(found), same, "left_anti").toDF(*docs.columns)
