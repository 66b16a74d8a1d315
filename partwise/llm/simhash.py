"""SimHash near-duplicates by anchor-point covering.

Fingerprints: 64 bits, the majority over the XXH64 (seed 42) of all word shingles.

Anchors: the words of a covering code. Two binary Golay codes [23, 12] side by
side cover the low 46 bits; each is perfect, so every 23 bits lie within 3 of
exactly one code word, and the 2**24 pairs of code words have covering radius 6.
If x and y differ in at most t bits, a z between them differs from x in at most
t // 2 and from y in at most t - t // 2. The anchor next to z lies within
radius + t // 2 of x and radius + (t - t // 2) of y. So each distinct
fingerprint is replicated to every anchor that a change of at most t - t // 2
bits can bring next to it (about 61 for t = 3), marked near if t // 2 changes
do; every linked pair then meets at an anchor, one of the two marked near. The
threshold is split this way because replicating to radius + t on one side
makes 300 rows of each fingerprint for the same result.

Per anchor, pairs are compared by XOR on all 64 bits. A crowded anchor emits a
spanning forest of its links, not its pairs. An anchor that holds more than
CROWD fingerprints is set aside and compared in blocks, pair of blocks by pair
of blocks, so no task holds more than two blocks.

Exact copies share a fingerprint, so everything after the first aggregate works
on distinct fingerprints. Components come from star contractions.

Cases: NULL or wordless text has fingerprint zero and is linked like any other.
component_id is the smallest doc_id reachable, NULL only if no member has one.
Rows sharing a doc_id are kept one by one. An empty table gives no rows. Extra
columns are ignored. A text is held whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations
from operator import xor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import LOWER, column, fresh, rename_clashes, stored, utf8
from partwise.llm.components import components
from partwise.operators.joins import broadcast_if_small

SEED = 42
#: Distinct fingerprints of one anchor that a task compares at once.
CROWD = 8192
#: Members from which an anchor emits a spanning forest instead of its pairs.
FOREST = 6
#: Generator polynomial of the binary Golay code [23, 12] (fixed value).
GOLAY = 0b101011100011
_LOWER = LOWER.tobytes()


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority bits of the shingles of the words of ``text``, A-Z lowered."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    first, last = starts[:n].tolist(), ends[k - 1 :].tolist()
    for at in range(0, n, 1 << 15):
        part = [digest(joined[s:e], SEED) for s, e in zip(first[at : at + (1 << 15)], last[at : at + (1 << 15)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in column(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "text_hash"), pa.array(found)], ["doc_id", "text_hash", "fp"])

    return docs.select(*_keyed(), utf8().alias("text")).mapInArrow(read, "doc_id bigint, text_hash bigint, fp bigint")


def _keyed() -> list:
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def _bit_syndromes() -> list[int]:
    """Remainder of each single bit by the generator; that of a word is their XOR."""
    out = []
    for i in range(23):
        x = 1 << i
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        out.append(x)
    return out


@cache
def _leaders() -> np.ndarray:
    """Per syndrome the only pattern of at most 3 bits that has it (the code is perfect)."""
    one = _bit_syndromes()
    out = np.zeros(2048, np.int64)
    for n in range(4):
        for bits in combinations(range(23), n):
            out[reduce(xor, (one[b] for b in bits), 0)] = sum(1 << b for b in bits)
    return out


@cache
def _reach(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome the code words that at most ``limit`` changed bits bring next, as XOR with the message of
    the word now next, and the changes each needs (9 where a row has no more)."""
    one, leader = _bit_syndromes(), _leaders()
    flips = [bits for n in range(limit + 1) for bits in combinations(range(23), n)]
    pattern = np.array([sum(1 << b for b in bits) for bits in flips])
    moves = np.array([reduce(xor, (one[b] for b in bits), 0) for bits in flips])
    cost = np.array([len(bits) for bits in flips])
    here = np.arange(2048)[:, None]
    message = (leader[here] ^ pattern ^ leader[here ^ moves]) >> 11
    # Patterns are in order of their cost, so the first of equal messages is the cheapest.
    found = [np.unique(row, return_index=True) for row in message]
    width = max(len(m) for m, _ in found)
    words, costs = np.zeros((2048, width), np.int64), np.full((2048, width), 9, np.int8)
    for s, (m, at) in enumerate(found):
        words[s, : len(m)], costs[s, : len(m)] = m, cost[at]
    return words, costs


@cache
def _syndromes() -> list[np.ndarray]:
    """Syndrome of 23 bits as the XOR of three byte tables."""
    one = [*_bit_syndromes(), 0]
    bits = np.arange(256)[:, None] >> np.arange(8) & 1
    return [np.bitwise_xor.reduce(bits * np.array(one[8 * k : 8 * k + 8]), axis=1) for k in range(3)]


def _half(bits: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    words, costs = _reach(limit)
    t = _syndromes()
    s = t[0][bits & 255] ^ t[1][bits >> 8 & 255] ^ t[2][bits >> 16]
    home = (bits ^ _leaders()[s]) >> 11
    return home[:, None] ^ words[s], costs[s]


def anchors(fps: np.ndarray, far: int, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, anchor, near) of every anchor that at most ``far`` changed bits bring next to a fingerprint."""
    bits = fps.view(np.uint64).astype(np.uint64)
    mask = np.uint64((1 << 23) - 1)
    low, low_cost = _half((bits & mask).astype(np.int64), far)
    high, high_cost = _half((bits >> np.uint64(23) & mask).astype(np.int64), far)
    cost = low_cost[:, :, None] + high_cost[:, None, :]
    row, i, j = np.nonzero(cost <= far)
    return row, low[row, i] << 12 | high[row, j], cost[row, i, j] <= near


def _replicated(far: int, near: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = column(batch, "fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 1024):
                part = fps[at : at + 1024]
                row, anchor, close = anchors(part, far, near)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(part[row]), pa.array(close)], ["anchor", "fp", "near"])

    return read


def _within(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)) <= distance


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    rest, a, b = fps, [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            seed = queue.pop()
            linked = _within(rest, seed, distance)
            if linked.any():
                found = rest[linked]
                a.append(found)
                b.append(np.full(len(found), seed))
                queue.extend(found)
                rest = rest[~linked]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _compared(distance: int, crowd: int):
    """Links per anchor from rows sorted by anchor; anchors over ``crowd`` come out as they are."""
    names = ["anchor", "a", "b"]

    def out(anchor, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names)

    def links(anchor: np.ndarray, fp: np.ndarray, near: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole anchors, none over ``crowd``."""
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        sizes = np.diff(np.append(starts, len(anchor)))
        small = np.repeat(sizes < FOREST, sizes)
        a, b = [], []
        sa, sf, sn = anchor[small], fp[small], near[small]
        for k in range(1, FOREST - 1):
            hit = (sa[k:] == sa[:-k]) & (sn[k:] | sn[:-k]) & _within(sf[k:], sf[:-k], distance)
            a.append(sf[k:][hit])
            b.append(sf[:-k][hit])
        for s, n in zip(starts[sizes >= FOREST].tolist(), sizes[sizes >= FOREST].tolist()):
            x, y = forest(fp[s : s + n], distance)
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        if pairs.shape[1]:
            yield out([None] * pairs.shape[1], pairs[0], pairs[1])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)]
        crowded = None
        for batch in batches:
            new = [column(batch, c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "near")]
            held = [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            if crowded is not None:  # the rest of an anchor that was given up
                n = int(np.searchsorted(held[0], crowded, side="right"))
                if n:
                    yield out(held[0][:n], held[1][:n], [None] * n)
                    held = [x[n:] for x in held]
                if not len(held[0]):
                    continue
                crowded = None
            last = int(np.searchsorted(held[0], held[0][-1], side="left"))
            whole, held = [x[:last] for x in held], [x[last:] for x in held]
            yield from settle(whole)
            if len(held[0]) > crowd:
                crowded = held[0][0]
                yield out(held[0], held[1], [None] * len(held[0]))
                held = [x[:0] for x in held]
        yield from settle(held)

    def settle(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchor, fp, near = rows
        if not len(anchor):
            return
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        sizes = np.diff(np.append(starts, len(anchor)))
        over = np.repeat(sizes > crowd, sizes)
        if over.any():
            yield out(anchor[over], fp[over], [None] * int(over.sum()))
        if not over.all():
            yield from links(anchor[~over], fp[~over], near[~over])

    return read


def _crowded_links(rows: DataFrame, distance: int, crowd: int) -> DataFrame:
    """Links (a, b) within crowded anchors (anchor, fp): blocks of at most about ``crowd``, compared two by two."""
    counts = rows.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / F.lit(crowd // 2)).cast("int").alias("g"))
    block = rows.join(counts, "anchor").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("g")).cast("int"))
    paired = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    keyed = paired.select("anchor", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def done():
            a, b = forest(np.unique(np.concatenate(held)), distance)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

        for batch in batches:
            keys = np.stack([column(batch, c).to_numpy(zero_copy_only=False) for c in ("anchor", "i", "j")])
            fp = column(batch, "fp").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)]):
                if e > s:
                    key = tuple(keys[:, s])
                    if held and key != held_key:
                        yield done()
                        held = []
                    held_key = key
                    held.append(fp[s:e])
        if held:
            yield done()

    return keyed.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j").mapInArrow(read, "a bigint, b bigint")


def links(distinct: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """(a, b), a > b: links among the distinct fingerprints ``fp``, enough of them to keep every component."""
    if not 0 <= distance <= 6:
        raise ValueError("the anchor tables cover distances up to 6")
    near = distance // 2
    # A few bytes a fingerprint come in and about 61 rows go out, so the work is dealt out by count, not by bytes.
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = distinct.select("fp").repartition(parts, "fp").mapInArrow(_replicated(distance - near, near), "anchor int, fp bigint, near boolean")
    met = rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compared(distance, crowd), "anchor int, a bigint, b bigint")
    met = stored(met, "simhash-links")
    found = met.filter("anchor is null").select("a", "b")
    over = met.filter("anchor is not null").select("anchor", F.col("a").alias("fp"))
    if not over.isEmpty():
        found = found.unionByName(_crowded_links(over, distance, crowd))
    return found.distinct()


def _groups(docs: DataFrame, shingle: int, distance: int, crowd: int) -> DataFrame:
    """(doc_id, text_hash, fp, root): root is the same for all rows of a group."""
    fps = stored(fingerprints(docs, shingle), "simhash-fp")
    distinct = fps.select("fp").distinct()
    linked = components(links(distinct, distance, crowd).select(F.col("a").alias("hi"), F.col("b").alias("lo")))
    return fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    rows = stored(_groups(docs, shingle, distance, crowd), "simhash-groups")
    # Written, so that the join reads both sides through exchanges of its own, which a large group's rows can be split on.
    ids = stored(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash-ids")
    return rows.join(ids, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """The row of smallest doc_id of each group (of equal ids the one of smallest text hash); columns as they are."""
    rows = stored(_groups(docs, shingle, distance, crowd).groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "simhash-groups")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = rows.groupBy("root").agg(F.min(place).alias("best"))
    lost = rows.join(best, "root").filter(place != F.col("best"))
    doc_id, text_hash = _keyed()
    id_name, hash_name = fresh(docs, "own_id", "own_hash")
    keyed = docs.withColumns({id_name: doc_id, hash_name: text_hash})
    sided = lambda found: found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
    kept = rename_clashes(keyed, ["found_id", "found_hash"])
    names = kept.columns
    same = F.col(id_name).eqNullSafe(F.col("found_id")) & (F.col(hash_name) == F.col("found_hash"))
    kept = kept.join(broadcast_if_small(stored(sided(lost), "simhash-lost")), same, "left_anti")
    twice = sided(rows.filter("n > 1"))
    if not twice.isEmpty():  # rows equal in id and text: one of them
        single = kept.join(twice, same, "left_anti")
        kept = single.unionByName(kept.join(twice, same, "left_semi").dropDuplicates([id_name, hash_name]))
    return kept.select(*[F.col(f"`{c}`") for c in names if c not in (id_name, hash_name)]).toDF(*docs.columns)
