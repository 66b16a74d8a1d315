"""Near-duplicates by HyperMinHash registers, banding and verification on whole sets.

A document's set is its distinct two-word shingles. Documents of equal sets are one
from the start (by a 128-bit digest); everything after works on distinct sets.

Registers. A shingle's hash names one of BUCKETS buckets; of each bucket's smallest
hash the number of leading zeros and MANTISSA bits behind the leading one are
kept, in 16 bits. For the bands alone, an empty bucket takes the register of the
first filled one in an order of its own, so that short documents have whole bands.

Bands. Every ROWS registers are a band key (51 of them). Sets of Jaccard similarity
s share one with probability 1 - (1 - s**5)**51, which is 1 - 2e-9 at 0.8. Keys
are counted first; only sets with a repeated key are looked at again.

* A key of more than SMALL sets has a hub, the set whose own keys are the most
  crowded, and each set of such keys is paired with one hub: that of the most keys.
* A key of a few sets gives those of their pairs that these links leave in
  different components.
* When both are verified, the sets of a crowded key are in few components, and
  only sets of different ones can still miss a link. Those outside the key's main component meet
  all others, block by block, and registers say which could be linked; of these
  a spanning forest is handed on, and its components are cohorts. The members of
  a cohort meet again, block by block with their texts, and a block's links are
  found on whole sets, again as a forest over the components there were. So a
  group of copies gives rows by its size, not its square, and no link is lost.

Estimate. Of the buckets filled in either set, those with equal registers less the
expected number of collisions (sets of these sizes by chance) give the similarity;
a pair that is SIGMAS deviations under the threshold is not verified, nor one whose
sizes exclude it.

Verification compares the shingles themselves, on whole texts: a pair's text with
fewer partners travels to the one with more, whose partners are dealt to parts.

Cases: NULL, empty or wordless text has an empty set and is a component of its own.
One word is a set of one. component_id is the smallest doc_id reachable, NULL only
if no member has one. Rows sharing a doc_id are kept one by one. Empty table: no
rows. Other columns are ignored. A text is held whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import LOWER, PLAIN_WORD, as_long, column, flat, key_filter, mix, passes, slices, span_hashes, spans, stored, utf8
from partwise.llm.components import components
from partwise.operators.joins import broadcast_if_small

BUCKETS = 256
MANTISSA = 10
ROWS = 5
BANDS = BUCKETS // ROWS
#: Sets up to which a band key gives all its pairs.
SMALL = 8
#: Sets of a block, by registers and by texts.
BLOCK, TEXT_BLOCK = 1024, 512
#: Partners of a text that one task verifies at once.
PARTNERS = 256
#: Standard deviations under the threshold from which an estimate rules a pair out.
SIGMAS = 5
_REST = np.uint64((1 << 56) - 1)
#: Per bucket the order in which an empty one looks for a filled one.
_PROBES = np.argsort(np.random.default_rng(11).random((BUCKETS, BUCKETS)), axis=1)


def _shingles(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the two-word shingles of each text (lowered bytes)."""
    start, end, row = spans(PLAIN_WORD[data], offsets)
    word = span_hashes(data, start, end)
    many = np.bincount(row, minlength=len(offsets) - 1)
    ends = np.cumsum(many)
    pair = mix(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(word[1:])) if len(word) > 1 else word[:0]
    out = []
    for n, e in zip(many.tolist(), ends.tolist()):
        if n > 1:
            out.append(np.unique(pair[e - n : e - 1]))
        else:
            out.append(mix(word[e - n : e] ^ np.uint64(0xA5A5A5A5)))
    return out


def _registers(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit registers, 0 for an empty bucket: 1 + leading zeros and mantissa of each bucket's smallest hash."""
    least = np.zeros((len(sets), BUCKETS), np.uint64)
    full = np.zeros((len(sets), BUCKETS), bool)
    for i, s in enumerate(sets):
        bucket = (s >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        least[i, bucket[first]], full[i, bucket[first]] = s[first] & _REST, True
    smear = least.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        smear |= smear >> np.uint64(shift)
    length = np.bitwise_count(smear).astype(np.int64)
    drop = length - 1 - MANTISSA
    shifted = np.where(drop >= 0, least >> np.maximum(drop, 0).astype(np.uint64), least << np.maximum(-drop, 0).astype(np.uint64))
    value = (56 - length) * (1 << MANTISSA) + (shifted & np.uint64((1 << MANTISSA) - 1)).astype(np.int64) + 1
    return np.where(full, value, 0).astype(np.uint16)


def _band_keys(registers: np.ndarray) -> np.ndarray:
    """BANDS keys of each row of registers; none of a row without any."""
    filled = registers.copy()
    empty_row, empty = np.nonzero(registers == 0)
    for width in (8, BUCKETS):
        probe = _PROBES[empty, :width]
        hit = registers[empty_row[:, None], probe] != 0
        found = hit.any(axis=1)
        at = hit.argmax(axis=1)
        filled[empty_row[found], empty[found]] = registers[empty_row[found], probe[found, at[found]]]
        empty_row, empty = empty_row[~found], empty[~found]
    cut = filled[:, : BANDS * ROWS].reshape(len(filled), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for k in range(ROWS):
        key = mix(key ^ (cut[:, :, k] + np.uint64(k << 20)))
    return key


def _read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cut in slices(batch, "text"):
            raw, offsets = flat(column(cut, "text"))
            sets = _shingles(LOWER[raw], offsets)
            digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            registers = [r.tobytes() for r in _registers(sets)]
            cols = [column(cut, "doc_id"), column(cut, "text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(registers, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "n", "digest", "registers"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), utf8().alias("text"))


def _matrix(batch: pa.RecordBatch, name: str = "registers") -> np.ndarray:
    raw, _ = flat(column(batch, name))
    return raw.view(np.uint16).reshape(-1, BUCKETS)


def _read_bands(wanted=None):
    """(key, set, n) of the bands; of those whose key passes, if a filter is given."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                cut = batch.slice(at, 256)
                key = _band_keys(_matrix(cut)).ravel()
                number, n = (np.repeat(column(cut, c).to_numpy(), BANDS) for c in ("set", "n"))
                if wanted is not None:
                    hit = passes(wanted.value, key)
                    key, number, n = key[hit], number[hit], n[hit]
                yield pa.RecordBatch.from_arrays([pa.array(as_long(key)), pa.array(number), pa.array(n)], ["key", "set", "n"])

    return read


_PAIR = "a bigint, b bigint"


def _small_pairs(percent: int):
    """Pairs (a > b) of equal key from rows sorted by key, whose keys have SMALL rows at most."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate((h, column(batch, c).to_numpy())) for h, c in zip(held, ("key", "set", "n"))]
            key, number, n = held
            found = []
            # A row meets the SMALL - 1 before it; those of the batches before are held over.
            for k in range(1, SMALL):
                ok = (key[k:] == key[:-k]) & (100 * np.minimum(n[k:], n[:-k]) >= percent * np.maximum(n[k:], n[:-k]))
                found.append(np.stack([np.maximum(number[k:], number[:-k])[ok], np.minimum(number[k:], number[:-k])[ok]]))
            a, b = np.unique(np.concatenate(found, axis=1), axis=1)
            held = [h[max(0, len(h) - SMALL + 1) :] for h in held]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return read


@cache
def _cell_chances() -> tuple[np.ndarray, np.ndarray]:
    """Over the binary logarithm of the elements a bucket has of both sets, the chance, by element of either, of one cell."""
    place = np.linspace(-40, 40, 8001)
    both, total = 2.0**place, np.zeros(8001)
    for zeros in range(40):
        low = 2.0 ** -(zeros + 1)
        total += low / (1 << MANTISSA) * (np.exp(-both * low) - np.exp(-both * 2 * low))
    return place, total


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected number of equal registers of sets of n and m elements that share none: within each power of two of the hash
    range, smallest hashes at exponential places fall into the same of 2**MANTISSA cells."""
    n, m = np.maximum(n / BUCKETS, 1e-9), np.maximum(m / BUCKETS, 1e-9)
    return BUCKETS * n * m / (n + m) * np.interp(np.log2(n + m), *_cell_chances())


def similar(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, whether a pair may reach ``percent``) for rows of registers a and b of sets of n and m elements."""
    equal = ((a == b) & (a != 0)).sum(axis=-1)
    filled = np.maximum(((a != 0) | (b != 0)).sum(axis=-1), 1)
    estimate = (equal - expected_collisions(n, m)) / filled
    possible = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return estimate, possible & (estimate >= _least(filled, percent))


def _least(filled: np.ndarray, percent: int) -> np.ndarray:
    s = percent / 100
    return s - SIGMAS * np.sqrt(s * (1 - s) / filled) - 1 / filled


def like(one: np.ndarray, n: int, others: np.ndarray, m: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, estimates) of the others that ``similar`` finds possible beside one. Most are ruled out by their sizes and
    by their equal registers alone, as collisions only lower an estimate."""
    at = np.flatnonzero(100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    # No register has the value that stands for an empty bucket here; counted as bits, 64 at once.
    same = np.packbits(others[at] == np.where(one == 0, np.uint16(0xFFFF), one), axis=1)
    equal = np.bitwise_count(same.view(np.uint64)).sum(axis=1)
    filled = np.count_nonzero(one)  # at least
    at = at[equal >= _least(np.maximum(filled, 1), percent) * filled]
    estimate, ok = similar(one[None], others[at], np.full(len(at), n), m[at], percent)
    return at[ok], estimate[ok]


def _estimated(percent: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                n, m = column(batch, "n_a").to_numpy(), column(batch, "n_b").to_numpy()
                _, ok = similar(_matrix(batch, "reg_a"), _matrix(batch, "reg_b"), n, m, percent)
                yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b")], ["a", "b"]).filter(pa.array(ok))

    return read


def likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose registers allow ``percent``."""
    side = lambda x: sets.select(F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"reg_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_estimated(percent), _PAIR)


def _text_set(text: bytes) -> set:
    words = text.lower().split()
    return set(zip(words, words[1:])) if len(words) > 1 else {(w,) for w in words}


def _verified(percent: int):
    """Links among rows sorted by (hub, part, leaf): a hub's own text (leaf NULL) and then its partners'."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, set()
        for batch in batches:
            a, b = [], []
            for h, leaf, text in zip(*(column(batch, c).to_pylist() for c in ("hub", "leaf", "text"))):
                if leaf is None:
                    hub, own = h, _text_set(text)
                    continue
                assert h == hub
                other = _text_set(text)
                both = len(own & other)
                if 100 * both >= percent * (len(own) + len(other) - both):
                    a.append(max(h, leaf))
                    b.append(min(h, leaf))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return read


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts' whole sets have ``percent`` of their union in common."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set")).groupBy("set").agg(F.count(F.lit(1)).alias("links"))
    ends = stored(ends, "minhash-ends")
    texts = _texts(docs, sets, ends)
    links = lambda x: ends.select(F.col("set").alias(x), F.col("links").alias(f"links_{x}"))
    sided = pairs.join(links("a"), "a").join(links("b"), "b")
    first = F.col("links_a") >= F.col("links_b")
    sided = sided.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("leaf"),
        F.greatest("links_a", "links_b").alias("links"),
    )
    parts = F.ceil(F.col("links") / PARTNERS)
    sided = stored(sided.withColumn("part", F.pmod(F.xxhash64("leaf"), parts)), "minhash-sided")
    # A leaf of very many hubs and a hub of very many parts are split by adaptive execution: the text side has one row a set.
    leaves = sided.join(texts.withColumnRenamed("set", "leaf"), "leaf").select("hub", "part", "leaf", "text")
    hubs = sided.select("hub", "part").distinct().join(texts.withColumnRenamed("set", "hub"), "hub")
    rows = leaves.unionByName(hubs.select("hub", "part", F.lit(None).cast("bigint").alias("leaf"), "text"))
    dealt = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("leaf").asc_nulls_first())
    return stored(dealt.mapInArrow(_verified(percent), _PAIR), "minhash-links")


_SPOT = ["key", "i", "j"]


def _by_block(find, more: list[str]):
    """Pairs (a > b) that ``find`` has for each block of rows sorted by (key, i, j), a block at a time; find gets the block's
    columns, with ``more`` as Arrow arrays."""
    plain = [*_SPOT, "set", "n", "root", "outside"]

    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        rows = {c: whole.column(c).to_numpy() for c in plain} | {c: whole.column(c).chunk(0) for c in more}
        a, b = find(rows)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, spot = [], None
        for batch in batches:
            if not len(batch):
                continue
            at = np.stack([column(batch, c).to_numpy() for c in _SPOT], axis=1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                if spot is not None and tuple(at[s]) != spot:
                    yield out(held)
                    held = []
                spot = tuple(at[s])
                held.append(batch.slice(s, e - s))
        if held:
            yield out(held)

    return read


def _joined(label: np.ndarray, own: int, others: np.ndarray) -> np.ndarray:
    """One of the places ``others`` for each label among them that is not ``own``; those labels become ``own``."""
    found, first = np.unique(label[others], return_index=True)
    first = first[found != own]
    label[np.isin(label, found)] = own
    return others[first]


def _possible(percent: int):
    """A spanning forest of the pairs of different components that the registers allow, those outside the main one against all."""

    def find(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        raw, _ = flat(rows["registers"])
        registers, n, root = raw.view(np.uint16).reshape(-1, BUCKETS), rows["n"], rows["root"]
        label = np.unique(rows["set"], return_inverse=True)[1]
        y = np.flatnonzero(~rows["outside"])
        a, b = [], []
        for i in np.flatnonzero(rows["outside"]).tolist():
            apart = y[root[y] != root[i]]
            hit, _ = like(registers[i], n[i], registers[apart], n[apart], percent)
            if len(hit):
                found = rows["set"][_joined(label, label[i], apart[hit])]
                a.append(np.full(len(found), rows["set"][i]))
                b.append(found)
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *a]), np.concatenate([empty, *b])

    return _by_block(find, ["registers"])


def _linked(percent: int):
    """Links on whole sets that connect the components of a block, those outside the main one against all."""

    def find(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        sets = []
        for cut in slices(pa.RecordBatch.from_arrays([rows["text"]], ["text"]), "text"):
            raw, offsets = flat(column(cut, "text"))
            sets += _shingles(LOWER[raw], offsets)
        size = np.array([len(s) for s in sets])
        code = np.unique(np.concatenate(sets), return_inverse=True)[1]
        cut = np.concatenate(([0], np.cumsum(size)))
        y = np.flatnonzero(~rows["outside"])
        theirs = np.concatenate([code[cut[k] : cut[k + 1]] for k in y.tolist()]) if len(y) else code[:0]
        starts = np.concatenate(([0], np.cumsum(size[y])[:-1])) if len(y) else cut[:0]
        label, mark = np.unique(rows["root"], return_inverse=True)[1], np.zeros(int(code.max(initial=0)) + 1, np.int32)
        text = lambda k: rows["text"][int(k)].as_py()
        a, b = [], []
        for i in np.flatnonzero(rows["outside"]).tolist():
            if not len(y) or not (label[y] != label[i]).any():
                continue
            own = code[cut[i] : cut[i + 1]]
            mark[own] = 1
            both = np.add.reduceat(mark[theirs], starts)
            mark[own] = 0
            hit = y[(100 * both >= percent * (size[i] + size[y] - both)) & (label[y] != label[i])]
            while len(hit):
                # Hashes said so; the words themselves decide.
                k = int(hit[0])
                one, other = _text_set(text(i)), _text_set(text(k))
                if 100 * len(one & other) >= percent * len(one | other):
                    a.append(rows["set"][i])
                    b.append(rows["set"][k])
                    label[label == label[k]] = label[i]
                    hit = hit[label[hit] != label[i]]
                else:
                    hit = hit[1:]
        return np.array(a, np.int64), np.array(b, np.int64)

    return _by_block(find, ["text"])


def _dealt(members: DataFrame, size: int) -> DataFrame:
    """(key, i, j, set, root, outside): the members (key, set, root) of each key in blocks of about ``size``, so that each one
    outside the key's main component meets every one. Keys of one component are left out."""
    main = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("many")).groupBy("key")
    main = main.agg(F.max_by("root", F.struct("many", "root")).alias("main"), F.sum("many").alias("all"), F.max("many").alias("most"))
    main = stored(main.filter("most < all").select("key", "main", F.ceil(F.col("all") / size).alias("blocks"), F.ceil((F.col("all") - F.col("most")) / size).alias("others")), "minhash-main")
    rows = members.join(main, "key")
    place = lambda blocks: F.pmod(F.xxhash64("set"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))
    outside = rows.filter("root != main").select("key", "set", "root", place("others").alias("i"), every("blocks").alias("j"), F.lit(True).alias("outside"))
    inside = rows.select("key", "set", "root", every("others").alias("i"), place("blocks").alias("j"), F.lit(False).alias("outside"))
    return outside.unionByName(inside)


def _roots(found: DataFrame) -> DataFrame:
    """(set, root) of every set in a link (a, b)."""
    return stored(components(found.select(F.col("a").alias("hi"), F.col("b").alias("lo"))).withColumnRenamed("node", "set"), "minhash-roots")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are in different components."""
    for end in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("set").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return pairs.filter("coalesce(root_a, a) != coalesce(root_b, b)").select("a", "b")


def _with_hubs(crowded: DataFrame) -> DataFrame:
    """A pair (a > b) for each set of crowded keys (key, set, many): with the hub of most of its keys. One pair a set, however
    many keys it has and however large they are."""
    rank = crowded.groupBy("set").agg(F.sum("many").alias("rank"))
    hubs = crowded.join(rank, "set").groupBy("key").agg(F.max_by("set", F.struct("rank", "set")).alias("hub"))
    shared = crowded.join(hubs, "key").filter("set != hub").groupBy("set", "hub").agg(F.count(F.lit(1)).alias("keys"))
    best = shared.groupBy("set").agg(F.max_by("hub", F.struct("keys", "hub")).alias("hub"))
    return best.select(F.greatest("set", "hub").alias("a"), F.least("set", "hub").alias("b")).distinct()


def crowd_links(docs: DataFrame, crowded: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that the components of ``found`` miss among sets that share a crowded key (key, set)."""
    roots = _roots(found)
    labelled = lambda members: members.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    met = _dealt(stored(labelled(crowded), "minhash-crowd"), BLOCK).join(sets.select("set", "n", "registers"), "set")
    met = met.repartition(*_SPOT).sortWithinPartitions(*_SPOT).select(*_SPOT, "set", "n", "root", "outside", "registers")
    possible = stored(met.mapInArrow(_possible(percent), _PAIR).distinct(), "minhash-possible")
    if possible.isEmpty():
        return possible
    cohorts = _roots(possible).withColumnRenamed("root", "key")
    met = _dealt(stored(labelled(cohorts), "minhash-cohorts"), TEXT_BLOCK).join(_texts(docs, sets, cohorts), "set").withColumn("n", F.lit(0).cast("bigint"))
    met = met.repartition(*_SPOT).sortWithinPartitions(*_SPOT).select(*_SPOT, "set", "n", "root", "outside", "text")
    return stored(met.mapInArrow(_linked(percent), _PAIR), "minhash-links")


def _texts(docs: DataFrame, sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(set, text) of the sets named in nodes: the text of one of its documents."""
    places = stored(sets.join(nodes, "set", "left_semi").select("set", "place.doc_id", "place.text_hash"), "minhash-places")
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(places, "text_hash"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted.value, column(batch, "text_hash").to_numpy().view(np.uint64))))

    found = _keyed(docs).mapInArrow(read, "doc_id bigint, text_hash bigint, text binary")
    same = found["doc_id"].eqNullSafe(places["doc_id"]) & (found["text_hash"] == places["text_hash"])
    # Rows equal in doc_id and text are one here.
    return stored(found.join(places, same).groupBy("set").agg(F.min("text").alias("text")), "minhash-texts")


def links(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) that connect all sets of similarity ``percent`` that share a band key."""
    spark = docs.sparkSession
    bands = sets.select("set", "n", "registers")
    schema = "key bigint, set bigint, n bigint"
    keys = bands.mapInArrow(_read_bands(), schema).groupBy("key").agg(F.count(F.lit(1)).alias("many"))
    keys = stored(keys.filter("many > 1"), "minhash-keys")
    wanted = spark.sparkContext.broadcast(key_filter(keys, "key"))
    rows = stored(bands.mapInArrow(_read_bands(wanted), schema).join(keys, "key"), "minhash-bands")
    few = rows.filter(F.col("many") <= SMALL).select("key", "set", "n")
    pairs = few.repartition("key").sortWithinPartitions("key").mapInArrow(_small_pairs(percent), _PAIR).distinct()
    confirmed = lambda pairs: verified(stored(likely(pairs, sets, percent), "minhash-pairs"), docs, sets, percent)
    crowded = rows.filter(F.col("many") > SMALL).select("key", "set", "many")
    if crowded.isEmpty():
        return confirmed(pairs)
    found = confirmed(_with_hubs(crowded))
    found = found.unionByName(confirmed(_apart(pairs, _roots(found))))
    return found.unionByName(crowd_links(docs, crowded.select("key", "set"), found, sets, percent))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; links have ``percent`` of the union of the sets in common."""
    rows = stored(_keyed(docs).mapInArrow(_read_sets, "doc_id bigint, text_hash bigint, n bigint, digest binary, registers binary"), "minhash-rows")
    place = F.struct("doc_id", "text_hash")
    sets = rows.filter("n > 0").groupBy("digest", "n").agg(F.min(place).alias("place"), F.min("doc_id").alias("least"), F.first("registers").alias("registers"))
    sets = stored(sets.withColumn("set", F.monotonically_increasing_id()), "minhash-sets")
    found = links(docs, sets, percent)
    roots = components(found.select(F.col("a").alias("hi"), F.col("b").alias("lo"))).withColumnRenamed("node", "set")
    labelled = stored(sets.select("set", "digest", "least").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "minhash-labelled")
    ids = stored(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "minhash-ids")
    ids = stored(labelled.join(ids, "root").select("digest", "component_id"), "minhash-ids")
    done = rows.select("doc_id", "n", "digest").join(broadcast_if_small(ids), "digest", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return done.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
