"""Harmonic packing of documents into sequences of a fixed token capacity.

A piece of length n belongs to reciprocal class j = capacity // n: j of its kind
fill a bin, and every bin of class j takes exactly j pieces, whichever they are.
So workers fill bins class by class as the pieces pass, without knowing of one
another. What a worker cannot fill up at its end (under one bin a class) goes to
a further round, where the open bins of FAN workers meet class by class, until one
group is left; the last open bin of each class (at most ``open_bound`` pieces in
all, whatever the input) goes to first-fit by length.

Plain harmonic packing pads a bin of class j by up to 1 / (j + 1). Documents may
be cut, so a piece that would leave more than WASTE of its slot free is cut at
the slot size of the next class, which it then fills exactly; what remains falls
into class j * (j + 1) or higher, so a document is cut a few times at most.

Cases: NULL text is empty and holds the end id alone. Rows sharing a doc_id (or
without one) are packed one by one. An empty table gives no rows. Extra columns
are ignored. A worker holds one Arrow batch and its open bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import column, stored, utf8
from partwise.llm.wordbpe import encoder

#: Workers whose open bins meet in the next round.
FAN = 64
#: Share of its slot that a piece may leave free without being cut.
WASTE = 1 / 64

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = f"{PIECE}, sequence_id bigint, offset bigint"
_ROUND = f"{PACKED}, worker bigint"
_NAMES = [f.split()[0] for f in PIECE.split(", ")]
_SCHEMA = pa.schema([(f.split()[0], pa.int64()) for f in _ROUND.split(", ")])


def cuts(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        j = capacity // n
        slot, next_slot = capacity // j, capacity // (j + 1)
        if slot - n <= WASTE * slot or next_slot == 0 or next_slot == n:
            out.append(n)
            break
        out.append(next_slot)
        n -= next_slot
    return out


def open_bound(capacity: int) -> int:
    """Most pieces that open bins, one a class, can hold."""
    return sum({capacity // n - 1 for n in range(1, capacity + 1)})


class _Bins:
    """Open bins of one worker: one a class and group of workers before it."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id, self.bins = capacity, first_id, {}

    def add(self, piece: tuple, worker: int) -> list[tuple]:
        """The rows of the bin that the piece fills, if it does."""
        j = self.capacity // piece[2]
        held = self.bins.setdefault((worker, j), [])
        held.append(piece)
        return self.close(self.bins.pop((worker, j)), worker) if len(held) == j else []

    def close(self, held: list[tuple], worker: int) -> list[tuple]:
        at, rows = 0, []
        for piece in held:
            rows.append((*piece, self.next_id, at, worker))
            at += piece[2]
        self.next_id += 1
        return rows

    def left(self) -> list[tuple]:
        return [(*piece, None, None, worker) for (worker, _), held in self.bins.items() for piece in held]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(_SCHEMA), schema=_SCHEMA)


def _first_id(round_: int) -> int:
    """Sequence ids apart by round and worker; the same again if the task is run again."""
    return (round_ << 60) | (TaskContext.get().partitionId() << 32)


def pieces_packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """First round, where the texts are read: pieces with their sequence, or NULL if their bin stays open."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).ids, np.array([end_id], "<u4").tobytes()
        bins, worker = _Bins(capacity, _first_id(0)), TaskContext.get().partitionId()
        for batch in batches:
            out = []
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text")):
                ids = encode(text.as_py()) + end
                n, start = len(ids) // 4, 0
                for length in cuts(n, capacity):
                    out += bins.add((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n), worker)
                    start += length
            yield _rows(out)
        yield _rows(bins.left())

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")).mapInArrow(fill, _ROUND)


def _refilled(pieces: DataFrame, capacity: int, round_: int) -> DataFrame:
    """Next round: the pieces of a class left by FAN workers meet, and bins are filled as they pass."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _Bins(capacity, _first_id(round_))
        for batch in batches:
            yield _rows([row for *piece, worker in zip(*(c.to_pylist() for c in batch.columns)) for row in bins.add(tuple(piece), worker)])
        yield _rows(bins.left())

    met = pieces.select(*_NAMES, F.expr(f"worker div {FAN}").alias("worker"))
    return met.repartition(F.expr(f"{capacity} div length"), F.col("worker")).mapInArrow(fill, _ROUND)


def _first_fit(pieces: DataFrame, capacity: int) -> DataFrame:
    """Last round: at most ``open_bound`` pieces, longest first, each into the first sequence with room."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        room, out, full = np.zeros(0, np.int64), [], 0
        for piece in sorted(rows, key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[1], r[3])):
            fits = np.flatnonzero(room >= piece[2])
            if len(fits):
                at = int(fits[0])
            else:
                at = len(room)
                room = np.append(room, capacity)
            out.append((*piece, (7 << 60) | at, capacity - int(room[at]), 0))
            room[at] -= piece[2]
        yield _rows(out)

    return pieces.select(*_NAMES).coalesce(1).mapInArrow(fill, _ROUND)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Pieces of a document cover its ids once each; offsets in a sequence are gapless.
    """
    level = stored(pieces_packed(docs, tokenizer, end_id, capacity), "packing-round-0")
    out, workers, round_ = level.filter("sequence_id is not null"), level.agg(F.max("worker")).first()[0] or 0, 0
    while round_ == 0 or workers > 0:
        round_, workers = round_ + 1, workers // FAN
        level = stored(_refilled(level.filter("sequence_id is null"), capacity, round_), f"packing-round-{round_}")
        out = out.unionByName(level.filter("sequence_id is not null"))
    last = _first_fit(level.filter("sequence_id is null"), capacity)
    return out.unionByName(last).drop("worker")
