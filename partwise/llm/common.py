"""Helpers shared by the operators: stored intermediates, text columns as bytes, flat word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, sort: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: an executor lost afterwards costs a reread, not a rerun.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'llm-' + name)}"
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: str = "text") -> Column:
    """The column's UTF-8 bytes; NULL as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """For each name one like it that ``docs`` has no column of."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def rename_clashes(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with columns of the given names moved out of the way (``name`` -> ``_name``)."""
    for name in names:
        for held in [c for c in df.columns if c.lower() == name.lower()]:
            df = df.withColumnRenamed(held, fresh(df, name)[0])
    return df


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each cut holds about ``max_bytes`` of ``column`` (one row at least)."""
    values = batch.column(batch.schema.get_field_index(column))
    if len(values) == 0:
        return
    sizes = np.diff(np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1])
    group = np.cumsum(sizes) // max_bytes
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(values)]))
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if end > begin:
            yield batch.slice(begin, end - begin)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array as one uint8 array, and the n+1 offsets of its rows."""
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


#: A-Z to a-z, every other byte as it is.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
#: Bytes of words that white space (space, tab to carriage return) ends.
PLAIN_WORD = np.array([not (c == 0x20 or 0x09 <= c <= 0x0D) for c in range(256)])
#: Bytes of words made of ASCII letters, digits and all non-ASCII characters.
ALNUM_WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of ``member`` bytes; a run ends with its row."""
    n = len(member)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    fresh = np.zeros(n + 1, bool)
    fresh[offsets[:-1]] = True
    fresh = fresh[:n]
    before = np.concatenate(([False], member[:-1]))
    after = np.concatenate((member[1:], [False]))
    next_fresh = np.concatenate((fresh[1:], [True]))
    start = np.flatnonzero(member & (~before | fresh))
    end = np.flatnonzero(member & (~after | next_fresh)) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for slot, base in ((0, _BASE), (1, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[slot] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span: prefix sums of a polynomial modulo 2**64, then mixed.

    Depends on the bytes alone, not on where they stand. Collisions are possible
    (2**-64 each); callers that need equality compare the bytes afterwards.
    """
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


#: Bits of a key filter: 8 MB, whatever the number of keys.
FILTER_BITS = 26


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Bitmap of the low FILTER_BITS bits of the longs in ``column``.

    Of fixed size: its words (2**20 at most) are put together on the executors
    and collected. A key that is not in the bitmap is surely not in ``keys``;
    callers join what passes.
    """
    low = F.col(column).bitwiseAND((1 << FILTER_BITS) - 1)
    words = keys.select(F.shiftright(low, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    found = words.toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bitmap[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which unsigned 64-bit keys may be among those of the bitmap."""
    low = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1
