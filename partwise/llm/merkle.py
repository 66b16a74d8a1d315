"""Merkle manifest of a corpus with proofs by pointer jumping.

Every row is a leaf: the hash of its fields. Per lang the leaves, ascending by
doc_id, form a binary tree, whose top is the lang's subroot; the subroots, by
lang, form a tree of the same kind, whose top is the root. A node without a
partner is hashed alone.

Places. Rows are range-partitioned in order, and a row's place in its lang is its
number in its partition plus the rows of the lang in the partitions before. No
lang passes through one task.

Trees. Ten levels a round: rows are dealt by runs of 1,024 neighbours, whose part
of the tree a task computes. A node comes out with its segment, the one sibling
on the way to its parent: the jump of distance 1.

Proofs. Each round joins the nodes with themselves: the segment of a node up to
distance d is followed by that of its ancestor at distance d, which doubles the
distance. A node can be an end of the doubled jump only if its level is a
multiple of 2d, so the other levels are left out, and after the last round every
leaf holds the siblings of its whole path. An ancestor at distance d is shared by
at most 2**d nodes. Where the ancestors of a round are few, so that this could be
many, they are broadcast: their exact number is known, and BROADCAST_BYTES bounds
them. The proof of a leaf is its path to the subroot and the subroot's to the root.

Cases: NULL fields are leaves' ``-``. NULL lang is a tree of its own and the first;
a NULL doc_id is the first of its lang. Rows sharing a doc_id are leaves of their
own, by leaf hash. Empty table: no rows, no root. Other columns are left out of
the leaf. A text is held whole in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.common import column, stored
from partwise.operators.joins import broadcast_if_small

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Levels of the tree that a task computes at once.
LEVELS = 10
#: Most bytes of ancestors that a round may broadcast.
BROADCAST_BYTES = 8 << 20
#: Where the sibling of a segment stands: none, before, after.
ALONE, BEFORE, AFTER = b"\0", b"\1", b"\2"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 (binary) of the fields, each ``-`` if NULL, else its UTF-8 length, ``:`` and itself."""
    return F.unhex(F.sha2(F.concat(*[_field(f) for f in fields]).cast("binary"), 256))


def _numbered(rows: DataFrame, name: str, tree: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place (from 0) by ``order`` within the rows of equal ``tree`` (None: all rows), and ``size``, how many those are."""
    keys = [tree] if tree else []
    # A number of their own tells equal rows apart, so that a range can end between them.
    rows = stored(rows.withColumn("serial", F.monotonically_increasing_id()), name)
    by = [*keys, *order, "serial"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("serial").withColumn("at", F.monotonically_increasing_id())
    ranged = stored(ranged, name).withColumn("part", F.shiftright("at", 33))
    # One row a partition and tree that has rows in it.
    runs = ranged.groupBy("part", *keys).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", *keys, "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(*keys)).alias("size"))
    runs = broadcast_if_small(stored(runs, name))
    placed = ranged.join(runs, ["part", *keys])
    return placed.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def _sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


_NODE = "tree bigint, size bigint, level int, idx bigint, hash binary, seg binary"


def _climb(base: int):
    """From nodes of level ``base``, sorted by (tree, idx) and dealt by runs of 2**LEVELS: those and the nodes above with
    their segments, up to LEVELS levels higher or the top, whose nodes come with their hash."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        tree, size, level, idx, digest, seg = zip(*rows) if rows else ([],) * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip((tree, size, level, idx, digest, seg), kinds)], ["tree", "size", "level", "idx", "hash", "seg"])

    def subtree(tree: int, size: int, first: int, digests: list[bytes]) -> list[tuple]:
        rows, now, at, level = [], [d.hex().encode() for d in digests], first, base
        top = min(base + LEVELS, (size - 1).bit_length())
        while level < top:
            parents = []
            for i in range(0, len(now), 2):
                if i + 1 < len(now):
                    left, right = now[i], now[i + 1]
                    rows.append((tree, size, level, at + i, None, AFTER + bytes.fromhex(right.decode())))
                    rows.append((tree, size, level, at + i + 1, None, BEFORE + bytes.fromhex(left.decode())))
                    parents.append(_sha(left + right))
                else:
                    rows.append((tree, size, level, at + i, None, ALONE))
                    parents.append(_sha(now[i]))
            now, at, level = parents, at >> 1, level + 1
        return rows + [(tree, size, level, at + i, bytes.fromhex(h.decode()), None) for i, h in enumerate(now)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digests = None, []
        for batch in batches:
            rows = []
            for tree, size, idx, digest in zip(*(column(batch, c).to_pylist() for c in ("tree", "size", "idx", "hash"))):
                run = (tree, size, idx >> LEVELS)
                if run != held:
                    if held is not None:
                        rows += subtree(held[0], held[1], held[2] << LEVELS, digests)
                    held, digests = run, []
                digests.append(digest)
            yield out(rows)
        if held is not None:
            yield out(subtree(held[0], held[1], held[2] << LEVELS, digests))

    return read


def build(leaves: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """From leaves (tree, size, pos, leaf), in trees of at most ``height`` levels over the leaves: the tops (tree, hash),
    and the segments (tree, level, idx, seg) of all nodes below them."""
    now = leaves.select("tree", "size", F.col("pos").alias("idx"), F.col("leaf").alias("hash"))
    tops, segments = None, None
    for base in range(0, max(height, 1), LEVELS):
        runs = now.repartition("tree", F.shiftright("idx", LEVELS)).sortWithinPartitions("tree", "idx")
        made = stored(runs.mapInArrow(_climb(base), _NODE), "merkle-nodes")
        one = F.expr("shiftright(size - 1, level) = 0")  # the level has one node
        done = made.filter(F.col("hash").isNotNull() & one).select("tree", "hash")
        part = made.filter("seg is not null").select("tree", "level", "idx", "seg")
        tops = done if tops is None else tops.unionByName(done)
        segments = part if segments is None else segments.unionByName(part)
        now = made.filter(F.col("hash").isNotNull() & ~one).select("tree", "size", "idx", "hash")
    return tops, segments


def _ancestors(sizes: DataFrame, height: int) -> dict[int, int]:
    """Per distance d the number of nodes whose level is an odd multiple of d, all trees together; from (size) a tree."""
    steps = [1 << k for k in range(max(height - 1, 0).bit_length())]
    if not steps:
        return {}
    nodes = lambda level: F.expr(f"case when shiftright(size - 1, {level}) > 0 then shiftright(size - 1, {level}) + 1 else 0 end")
    found = sizes.agg(*[sum((F.sum(nodes(level)) for level in range(d, height, 2 * d)), F.lit(0)).alias(f"d{d}") for d in steps]).first()
    return {d: int(found[f"d{d}"] or 0) for d in steps}


def proofs(segments: DataFrame, sizes: DataFrame, height: int) -> DataFrame:
    """(tree, pos, path) of every leaf below another node: its segments up to the top of its tree, by pointer jumping."""
    many, d = _ancestors(sizes, height), 1
    while d < height:
        held = segments.filter(F.col("level") % (2 * d) == 0)
        far = segments.filter(F.col("level") % (2 * d) == d)
        far = far.select("tree", (F.col("level") - d).alias("level"), F.col("idx").alias("up"), F.col("seg").alias("more"))
        if many[d] * (33 * d + 64) <= BROADCAST_BYTES:
            far = F.broadcast(far)
        jumped = held.withColumn("up", F.shiftright("idx", d)).join(far, ["tree", "level", "up"], "left")
        segments = stored(jumped.select("tree", "level", "idx", F.concat("seg", F.coalesce("more", F.lit(b""))).alias("seg")), "merkle-jump")
        d *= 2
    return segments.filter("level = 0").select("tree", F.col("idx").alias("pos"), F.col("seg").alias("path"))


def _height(sizes: DataFrame) -> int:
    """Levels above the leaves of the largest tree; -1 if there is none."""
    largest = sizes.agg(F.max("size")).first()[0]
    return -1 if largest is None else (int(largest) - 1).bit_length()


def manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """doc_id, lang, pos, leaf, other, path, subroot, root (binary) of every row.

    ``path`` is a chain of segments from the leaf to the root: a byte (no sibling,
    before, after), and the sibling's 32 bytes if there is one. ``other`` is the
    leaf with ``altered`` for n_chars, if that is given and not NULL.
    """
    kept = [F.col(c) for c in FIELDS]
    other = [altered if c == "n_chars" else F.col(c) for c in FIELDS]
    leaf = [leaf_hash(kept).alias("leaf"), (F.lit(None).cast("binary") if altered is None else F.when(altered.isNotNull(), leaf_hash(other))).alias("other")]
    # The byte in front keeps the order of the UTF-8 bytes and puts NULL first.
    key = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("+"), F.col("lang")))
    rows = _numbered(docs.select("doc_id", "lang", key.alias("key"), *leaf), "merkle-leaves", "key", ["doc_id", "leaf"])
    rows = stored(rows, "merkle-places")
    langs = rows.groupBy("key").agg(F.first("size").alias("leaves"))
    langs = stored(_numbered(langs, "merkle-langs", None, ["key"]).select("key", F.col("pos").alias("tree"), "leaves", F.col("size").alias("n_langs")), "merkle-langs")

    placed = stored(rows.join(broadcast_if_small(langs.select("key", "tree")), "key").drop("key"), "merkle-trees")
    sizes = langs.select(F.col("leaves").alias("size"))
    height = _height(sizes)
    tops, segments = build(placed, height)
    paths = proofs(segments, sizes, height)

    subroots = stored(langs.join(tops, "tree").select(F.lit(0).cast("bigint").alias("tree"), F.col("n_langs").alias("size"), F.col("tree").alias("pos"), F.col("hash").alias("leaf")), "merkle-subroots")
    sizes = subroots.select("size").limit(1)
    height = _height(sizes)
    top, segments = build(subroots, height)
    rest = proofs(segments, sizes, height)
    root = top.select("hash").first()
    root = F.lit(None if root is None else bytes(root[0])).cast("binary").alias("root")
    above = subroots.select("pos", F.col("leaf").alias("subroot")).join(rest.select("pos", F.col("path").alias("rest")), "pos", "left")
    above = stored(above.select(F.col("pos").alias("tree"), "subroot", F.coalesce("rest", F.lit(b"")).alias("rest")), "merkle-above")

    whole = placed.join(paths, ["tree", "pos"], "left").join(broadcast_if_small(above), "tree")
    path = F.concat(F.coalesce("path", F.lit(b"")), F.col("rest")).alias("path")
    return whole.select("doc_id", "lang", "pos", "leaf", "other", path, "subroot", root)


def steps(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(where, sibling as hex) of each segment of a path, from the leaf up."""
    at = 0
    while at < len(path):
        where = path[at : at + 1]
        at += 1
        if where == ALONE:
            yield where, b""
        else:
            yield where, path[at : at + 32].hex().encode()
            at += 32


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root (hex) that a leaf (hex) and its path lead to."""
    for where, sibling in steps(path):
        leaf = _sha(sibling + leaf if where == BEFORE else leaf + sibling)
    return leaf


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf, other, path, subroot, root = (column(batch, c).to_pylist() for c in ("leaf", "other", "path", "subroot", "root"))
        proof = [_sha(b"".join(s for _, s in steps(p))).decode() for p in path]
        folded = [fold((a if b is None else b).hex().encode(), p).decode() for a, b, p in zip(leaf, other, path)]
        root = [r.hex() for r in root]
        texts = [[x.hex() for x in leaf], [x.hex() for x in subroot], root, proof, folded]
        verified = pa.array(np.array([f == r for f, r in zip(folded, root)], bool))
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), *[pa.array(t, pa.string()) for t in texts], verified],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def verify(found: DataFrame) -> DataFrame:
    """Fold every row's leaf (``other``, where there is one) along its path and compare with the root; hashes as hex."""
    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    rows = found.select(F.col("doc_id").cast("bigint").alias("doc_id"), "leaf", "other", "path", "subroot", "root")
    return rows.mapInArrow(_checked, schema)


def audit(docs: DataFrame, divisor: int = 7) -> DataFrame:
    """The manifest's proofs of ``docs``, where rows whose crc32(doc_id) ``divisor`` divides have had 1 added to n_chars."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == 0
    return verify(manifest(docs, F.when(tampered, F.col("n_chars") + 1)))


def oracle_sql(divisor: int = 7) -> str:
    """The audit in DuckDB: levels, proofs and crc32 by recursion."""
    field = lambda c: f"case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || cast({c} as varchar) end"
    leaf = " || ".join(field(c) for c in FIELDS)
    other = " || ".join(field("n_chars + 1" if c == "n_chars" else c) for c in FIELDS)
    return f"""
with recursive
bits(b, k, v) as (
  select b, 0, b from range(256) r(b)
  union all
  select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
crc_table as (select b, v from bits where k = 8),
ids as (select distinct doc_id, cast(doc_id as varchar) as s from documents where doc_id is not null),
crc(doc_id, s, i, c) as (
  select doc_id, s, 0, 4294967295::bigint from ids
  union all
  select crc.doc_id, s, i + 1, xor(t.v, c >> 8) from crc join crc_table t on t.b = xor(c, ord(s[i + 1])) & 255 where i < length(s)),
tampered as (select doc_id from crc where i = length(s) and xor(c, 4294967295) % {divisor} = 0),
hashed as (
  select doc_id, case when lang is null then '' else '+' || lang end as key, sha256({leaf}) as leaf,
    case when n_chars is not null and doc_id in (select doc_id from tampered) then sha256({other}) end as other
  from documents),
leaves as (
  select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by key) as size,
    row_number() over () as r
  from hashed),
nodes(key, lvl, idx, cnt, h) as (
  select key, 0, pos, size, leaf from leaves
  union all
  select key, lvl + 1, idx // 2, (any_value(cnt) + 1) // 2, sha256(string_agg(h, '' order by idx)) from nodes where cnt > 1 group by key, lvl, idx // 2),
tops as (select key, h, row_number() over (order by key) - 1 as pos, count(*) over () as size, lvl from nodes where cnt = 1),
above(lvl, idx, cnt, h) as (
  select 0, pos, size, h from tops
  union all
  select lvl + 1, idx // 2, (any_value(cnt) + 1) // 2, sha256(string_agg(h, '' order by idx)) from above where cnt > 1 group by lvl, idx // 2),
steps as (
  select l.r, n.lvl as step, n.idx % 2 as odd, s.h as sibling
  from leaves l join nodes n on n.key = l.key and n.idx = l.pos >> n.lvl and n.cnt > 1
  left join nodes s on s.key = n.key and s.lvl = n.lvl and s.idx = xor(n.idx, 1)
  union all
  select l.r, t.lvl + n.lvl, n.idx % 2, s.h
  from leaves l join tops t on t.key = l.key join above n on n.idx = t.pos >> n.lvl and n.cnt > 1
  left join above s on s.lvl = n.lvl and s.idx = xor(n.idx, 1)),
proof as (select r, sha256(coalesce(string_agg(sibling, '' order by step), '')) as p, count(*) as n from steps group by r),
folds(r, step, h) as (
  select r, 0, coalesce(other, leaf) from leaves
  union all
  select f.r, f.step + 1, sha256(case when s.sibling is null then f.h when s.odd = 1 then s.sibling || f.h else f.h || s.sibling end)
  from folds f join steps s on s.r = f.r and s.step = f.step)
select l.doc_id, l.leaf, t.h as subroot, a.h as root, coalesce(p.p, sha256('')) as proof_sha256, f.h as folded_root, f.h = a.h as verified
from leaves l join tops t on t.key = l.key join above a on a.cnt = 1
left join proof p on p.r = l.r join folds f on f.r = l.r and f.step = coalesce(p.n, 0)
"""
