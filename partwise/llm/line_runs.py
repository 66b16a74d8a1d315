"""Line dedup by content-defined chunks of lines, grown to whole repeated runs.

Lines with a word are hashed, and rolling hashes over the last lines decide where a
chunk begins and ends, so that boundaries come back wherever the lines do, however
far a passage is shifted. There are several chunkings of a text, independent of each
other, most of them with a window of one line: whatever stands around a passage,
some chunks lie within it, however short it is.

Chunks are counted over all documents. Lines of chunks that repeat are seeds, and
each seed is grown by the lines beside it: every pair of neighbouring lines with a
seed in it is looked up. Pairs overlap, so a run is followed to its ends, also
where its seeds are some lines apart. A pair that stands earlier, by (doc_id, hash
of the text, line), loses both of its lines; the lines of its first occurrence stay.
So a run of two lines or more that stands earlier in one piece goes from its first
line to its last, and every line is left where it stands first of all.

Only places of pairs with a seed are shuffled, which a fixed-size key filter of the
repeated chunks decides where the texts are read. Equality is that of bytes: the
lines of such pairs are compared, each once a task, and lines that share a hash but
not their bytes are told apart by a second hash.

Cases: NULL text stays NULL (no lines). A NULL doc_id comes before all others.
Rows equal in doc_id and text get the same result; other rows sharing a doc_id
are told apart by their text. A document of one line is never removed. Blank
lines between the lines of a removed pair go with them, others stay. An empty
table gives no rows. All columns are kept, whatever their names. A text is held
whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from partwise.llm.common import column, fresh, key_filter, mix, passes, slices, stored, utf8

_ID = ["doc_id", "text_hash"]
_SLICE = 1 << 20
#: Lines that the rolling hash of each chunking spans.
WINDOWS = (1, 1, 1, 1, 1, 1, 2, 3)


def chunks(h: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first line, line after the last) of the chunks of each chunking, from the line hashes of texts one after the other, and
    the place of each line in its text.

    A chunk ends behind a line whose rolling hash has its lowest bit set, and begins at one whose next bit is set; so either
    end of a chunk is decided by the lines in it, or by those beside it. It ends with its text.
    """
    for number, window in enumerate(WINDOWS):
        roll = np.full(len(h), number + 1, np.uint64)
        for k in range(window):  # of the lines up to this one
            at = np.flatnonzero(place >= k) if k else slice(None)
            roll[at] = mix(roll[at] + (h[at - k] if k else h))
        ends, begins = (roll & np.uint64(1)) == 1, (roll >> np.uint64(1) & np.uint64(1)) == 1
        cut = np.flatnonzero(ends[:-1] | begins[1:] | (place[1:] == 0)) + 1
        yield np.concatenate(([0], cut)), np.concatenate((cut, [len(h)]))


def chunk_keys(h: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, end) of the distinct chunks of texts of more than one line, all chunkings together."""
    first, end = (np.concatenate(x) for x in zip(*chunks(h, place)))
    span = np.unique(first * (len(h) + 1) + end)
    first, end = np.divmod(span, len(h) + 1)
    alone = (end - first == 1) & (place[first] == 0) & (np.append(place[1:], 0)[first] == 0)
    first, end = first[~alone], end[~alone]
    # The hash of a chunk from prefix sums: a polynomial of its line hashes, by place.
    power = np.full(len(h) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    inverse = np.full(len(h) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h) * power[:-1], dtype=np.uint64)))
    return mix((total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64)), first, end


def seeded_pairs(h: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first lines of the pairs of neighbouring lines of which one is in a chunk that passes the key filter."""
    key, first, end = chunk_keys(h, place)
    hit = passes(wanted, key)
    if not hit.any():
        return np.zeros(0, np.int64)
    change = np.zeros(len(h) + 1, np.int64)
    np.add.at(change, first[hit], 1)
    np.add.at(change, end[hit], -1)
    seed = np.cumsum(change[:-1]) > 0
    return np.flatnonzero((seed[:-1] | seed[1:]) & (place[1:] > 0))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """A slice, the lines with a word of all its texts, their hashes, their texts' rows and their places there; slices without lines are left out."""
    for big in batches:
        for batch in slices(big, "text", _SLICE):
            texts = [[line for line in text.split(b"\n") if line.strip()] for text in column(batch, "text").to_pylist()]
            many = np.array([len(lines) for lines in texts], np.int64)
            if not many.any():
                continue
            lines = [line for some in texts for line in some]
            row = np.repeat(np.arange(len(texts)), many)
            place = np.arange(len(lines)) - np.repeat(np.cumsum(many) - many, many)
            yield batch, lines, np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines)), row, place


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk keys and how often a slice has them."""
    for _, _, h, _, place in _texts(batches):
        key, n = np.unique(chunk_keys(h, place)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _bodies(wanted):
    """(h, body) of the lines of pairs with a seed, each once a slice."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lines, h, _, place in _texts(batches):
            hit = seeded_pairs(h, place, wanted.value)
            at = np.union1d(hit, hit + 1).tolist()
            found = set(zip(h[at].view(np.int64).tolist(), (lines[i] for i in at)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.binary()))], ["h", "body"])

    return read


def shared_hashes(bodies: DataFrame) -> DataFrame:
    """``h`` of different bodies with one hash."""
    return bodies.distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")


def _places(wanted, shared):
    """(doc_id, text_hash, at, a, b) of pairs with a seed; a and b stand for the bytes of their lines."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lines, h, row, place in _texts(batches):
            hit = seeded_pairs(h, place, wanted.value)
            for i in np.flatnonzero(passes(shared.value, h)).tolist():
                h[i] = xxhash.xxh64_intdigest(lines[i], 7)
            sides = [pa.array(x.view(np.int64)) for x in (h[hit], h[hit + 1])]
            of = pa.array(row[hit])
            yield pa.RecordBatch.from_arrays([*(column(batch, c).take(of) for c in _ID), pa.array(place[hit].astype(np.int32)), *sides], [*_ID, "at", "a", "b"])

    return read


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, overlaps) of pairs equal to an earlier one; ``overlaps`` if that begins one line before."""
    spark = docs.sparkSession
    counts = docs.mapInArrow(_keys, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    wanted = spark.sparkContext.broadcast(key_filter(counts.filter("n > 1"), "key"))
    shared = spark.sparkContext.broadcast(key_filter(shared_hashes(docs.mapInArrow(_bodies(wanted), "h bigint, body binary")), "h"))
    places = stored(docs.mapInArrow(_places(wanted, shared), "doc_id bigint, text_hash bigint, at int, a bigint, b bigint"), "line-pairs")
    place = F.struct(*_ID, "at")
    # Written, so that the join deals both sides itself and AQE may split a very common pair.
    first = stored(places.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "line-first")
    later = places.join(first, ["a", "b"]).filter(~place.eqNullSafe(F.col("first")))
    beside = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("at") == F.col("first.at") + 1)
    return later.select(*_ID, "at", beside.alias("overlaps"))


def without_pairs(text: bytes, gone: Iterable[int]) -> tuple[bytes, int]:
    """The text without the pairs ``gone`` (2 * place, and 1 more if only the second line goes), and the lines with a word that went."""
    lines = text.split(b"\n")
    at = [i for i, line in enumerate(lines) if line.strip()]
    drop = set()
    for code in gone:
        i, overlaps = divmod(code, 2)
        drop.update([at[i + 1]] if overlaps else range(at[i], at[i + 1] + 1))
    return b"\n".join(line for i, line in enumerate(lines) if i not in drop), sum(1 for i in at if i in drop)


def _without(names: list[str], raw_name: str, gone_name: str, counts: list[str]):
    """Take the pairs listed in a column out of the text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, removed = [], [], []
            for raw, gone in zip(column(batch, raw_name), column(batch, gone_name)):
                text, codes = raw.as_py(), gone.as_py()
                total.append(0 if text is None else sum(1 for x in text.split(b"\n") if x.strip()))
                text, lost = without_pairs(text, codes) if codes else (text, 0)
                texts.append(text)
                removed.append(lost)
            cols = {counts[0]: pa.array(total, pa.int64()), counts[1]: pa.array(removed, pa.int64()), "text": pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays([cols[c] if c in cols else column(batch, c) for c in names], names)

    return read


def dedup_runs(docs: DataFrame, lines: str = "n_lines", removed: str = "n_removed_lines") -> DataFrame:
    """``docs`` with repeated runs of lines taken out of ``text``, and two more columns: lines with a word, and those removed."""
    identity = [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]
    raw, own, gone_id, gone_hash, gone, n, lost = fresh(docs, "raw", "own_hash", "gone_id", "gone_hash", "gone", "n", "lost")
    code = (F.col("at").cast("bigint") * 2 + F.col("overlaps").cast("bigint")).alias("code")
    found = repeated_pairs(docs.select(*identity, utf8().alias("text"))).select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash), code)
    found = found.groupBy(gone_id, gone_hash).agg(F.collect_set("code").alias(gone))
    rows = docs.withColumn(own, identity[1]).withColumn(raw, F.col("text").cast("binary"))
    joined = rows.drop("text").join(found, F.col("doc_id").cast("bigint").eqNullSafe(F.col(gone_id)) & (F.col(own) == F.col(gone_hash)), "left")
    joined = joined.drop(gone_id, gone_hash, own)
    out = StructType([*docs.schema.fields, StructField(n, LongType()), StructField(lost, LongType())])
    return joined.mapInArrow(_without(out.fieldNames(), raw, gone, [n, lost]), out).toDF(*docs.columns, lines, removed)
