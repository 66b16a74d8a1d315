"""Token-ID output: one zstandard frame per document under a shared dictionary, in doc_id order.

Layout of a store (all Parquet, written by Spark's committing writer, so a lost
executor leaves no half file):

* ``dictionary``: dict_hash, body. The dictionary trained on serialized id arrays.
* ``blocks``: one row per block of neighbouring documents: file number, block
  number, first and last doc_id, dictionary hash, bytes per id, the offset
  index (doc_ids, token counts, frame offsets) and the frames themselves.
* ``starts``: token position of the first document of each file.

A short document is read by pruning blocks on first/last doc_id, taking its
offset from the index and decompressing its own frame only (``lookup``).

Cases: NULL text is the empty text and holds the end id alone. Rows that share
a doc_id are all kept, ordered by (token count, frame); a NULL doc_id comes first.
An empty table gives an empty store. Extra columns are ignored. Memory per task
is one Arrow batch, the ids of ENCODED_BYTES of its texts and one block (about
1 MB); of each, one document if larger.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm.common import column, slices, utf8
from partwise.llm.wordbpe import encoder
from partwise.session import shared_dir

#: Documents whose ids the dictionary is trained on, at most, and ids taken of each.
DICTIONARY_DOCS = 2000
DICTIONARY_IDS = 2048
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4096
#: Bytes of text whose distinct chunks are found together.
ENCODED_BYTES = 16 << 20

_BLOCKS = (
    "file int, block int, first_id bigint, last_id bigint, dict_hash bigint, width int, "
    "file_start bigint, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>, offsets array<bigint>, frames binary"
)
_TOKENS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _width(path: str) -> int:
    return 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4


def _pack(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids


def _unpack(raw: bytes, width: int) -> bytes:
    return np.frombuffer(raw, "<u2").astype("<u4").tobytes() if width == 2 else raw


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, n_docs: int) -> bytes:
    """Dictionary over a bounded random sample: DICTIONARY_DOCS documents, DICTIONARY_IDS ids of each."""
    sample = docs if n_docs <= DICTIONARY_DOCS else docs.sample(1.5 * DICTIONARY_DOCS / n_docs, seed=42)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, end = _width(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            heads = [_pack((encoder(tokenizer).ids(t) + end)[: 4 * DICTIONARY_IDS], width) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"ids": pa.array(heads, pa.binary())})

    rows = sample.select(utf8().alias("text")).limit(DICTIONARY_DOCS).mapInArrow(serialized, "ids binary").collect()
    samples = [bytes(r.ids) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples for training: their own bytes serve
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(body: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(body) if len(body) >= 8 else None


def dictionary_hash(body: bytes) -> int:
    return zlib.crc32(body)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, files: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write the store under ``path``.

    Texts never move: they are encoded where they are read, and only the
    compressed frames are dealt into doc_id ranges. Range bounds come from
    approximate quantiles of doc_id alone.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / files for i in range(1, files)]
    n_docs, bounds = docs.select(F.count(F.lit(1)), F.percentile_approx("doc_id", cuts or [0.5], 10000)).first()
    bounds = sorted(set(bounds or [])) if cuts else []
    body = train_dictionary(docs, tokenizer, end_id, n_docs)
    dict_hash = dictionary_hash(body)
    spark.createDataFrame([(dict_hash, body)], "dict_hash bigint, body binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, end = _width(tokenizer), np.array([end_id], "<u4").tobytes()
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(body)).compress
        end, encode, edges = _pack(end, width), encoder(tokenizer).batch, np.array(bounds, np.int64)
        for batch in batches:
            for cut in slices(batch, "text", ENCODED_BYTES):
                ids, offsets = encode(column(cut, "text"))
                packed, places = memoryview(_pack(ids.tobytes(), width)), (offsets * width).tolist()
                out = [squeeze(b"".join((packed[s:e], end))) for s, e in zip(places[:-1], places[1:])]
                doc_ids = column(cut, "doc_id")
                keys = np.array([np.iinfo(np.int64).min if x is None else x for x in doc_ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(edges, keys, side="left").astype(np.int32)), doc_ids, pa.array(np.diff(offsets) + 1), pa.array(out, pa.binary())],
                    ["file", "doc_id", "n_tokens", "frame"],
                )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, held, file, number, before = _width(tokenizer), [], None, 0, 0
        names = [f.split()[0] for f in _BLOCKS.split(", ")]

        def close():
            sizes = np.cumsum([0, *(len(r[2]) for r in held)])
            ids = [r[0] for r in held]
            known = [i for i in ids if i is not None]
            row = [file, number, min(known, default=None), max(known, default=None), dict_hash, width, before, sum(r[1] for r in held), ids, [r[1] for r in held], sizes.tolist(), b"".join(r[2] for r in held)]
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=_ARROW_BLOCKS)

        size = 0
        for batch in batches:
            for f, doc_id, n, frame in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and (f != file or size >= BLOCK_BYTES or len(held) >= BLOCK_DOCS):
                    yield close()
                    before = before + sum(r[1] for r in held) if f == file else 0
                    number, held, size = number + 1 if f == file else 0, [], 0
                file = f
                held.append((doc_id, n, frame))
                size += len(frame)
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")).mapInArrow(frames, "file int, doc_id bigint, n_tokens bigint, frame binary")
    dealt = rows.repartitionById(files, F.col("file")).sortWithinPartitions("file", "doc_id", "n_tokens", "frame")
    dealt.mapInArrow(blocks, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")

    # One row per file reaches the driver.
    totals = spark.read.parquet(f"{path}/blocks").groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    before, starts = 0, []
    for r in totals:
        starts.append((r.file, before))
        before += r.n
    spark.createDataFrame(starts, "file int, start bigint").coalesce(1).write.parquet(f"{path}/starts")


_ARROW_BLOCKS = pa.schema(
    [
        ("file", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("dict_hash", pa.int64()),
        ("width", pa.int32()), ("file_start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())), ("frames", pa.binary()),
    ]
)


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, dict[int, bytes]]:
    """Blocks with their first token's position, and the dictionaries (each at most DICTIONARY_BYTES)."""
    dictionaries = {r.dict_hash: bytes(r.body) for r in spark.read.parquet(f"{path}/dictionary").collect()}
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    starts = spark.read.schema("file int, start bigint").parquet(f"{path}/starts")  # one row per file
    return blocks.join(F.broadcast(starts), "file").withColumn("first_start", F.col("start") + F.col("file_start")), dictionaries


def _decoded(dictionaries: dict[int, bytes], wanted: frozenset | None = None, digest: bool = False):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = {h: zstandard.ZstdDecompressor(dict_data=_dictionary(b)) for h, b in dictionaries.items()}
        for batch in batches:
            for row in range(batch.num_rows):
                hash_, width, ids, counts, offsets, frames, start = (column(batch, c)[row].as_py() for c in ("dict_hash", "width", "doc_ids", "counts", "offsets", "frames", "first_start"))
                starts = (np.cumsum([0, *counts]) + start).tolist()
                keep = [i for i, d in enumerate(ids) if wanted is None or d in wanted]
                out = [_unpack(readers[hash_].decompress(frames[offsets[i] : offsets[i + 1]]), width) for i in keep]
                kept = [pa.array([x[i] for i in keep], pa.int64()) for x in (ids, starts)]
                n = pa.array([len(x) // 4 for x in out], pa.int64())
                if digest:
                    yield pa.RecordBatch.from_arrays([*kept, n, pa.array([zlib.crc32(x) for x in out], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                else:
                    yield pa.RecordBatch.from_arrays([*kept, n, pa.array(out, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return read


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a store: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    blocks, dictionaries = _opened(spark, path)
    return blocks.mapInArrow(_decoded(dictionaries), _TOKENS)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_store`` with the crc32 of each document's ids in their place."""
    blocks, dictionaries = _opened(spark, path)
    return blocks.mapInArrow(_decoded(dictionaries, digest=True), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The given documents only: blocks are pruned by doc_id range, other frames stay compressed."""
    blocks, dictionaries = _opened(spark, path)
    ranges = F.lit(False)
    for d in doc_ids:
        ranges = ranges | F.lit(d).between(F.col("first_id"), F.col("last_id"))
    return blocks.filter(ranges).mapInArrow(_decoded(dictionaries, frozenset(doc_ids)), _TOKENS)


def token_digests(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write a store in the shared folder and read it back."""
    path = shared_dir(docs.sparkSession, "llm-token-store")
    write_store(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
