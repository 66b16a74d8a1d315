"""Token counts of whole texts by a sentencepiece BPE model; huge documents by overlapping chunks.

Documents up to CHUNK characters are encoded as they are. A longer one is cut
into chunks that overlap, every chunk is encoded on its own (with offsets), and
neighbours are spliced at a common token boundary in their overlap that is
proven stable: the two characters around it stand side by side in no piece of
the vocabulary. No merge ever joins them, in whatever context, so the tokens on
either side are those of the whole text. A seam without such a boundary sends
its document back with twice the overlap, and at last to be encoded whole.

The count is additive: the tokens of all chunks, less those that lie beyond the
splice on either side of each seam. So one document spreads over many tasks and
nothing is gathered but sums.

The proof needs a BPE model whose normaliser keeps characters as they are;
documents of other models are encoded whole.

Cases: NULL text is empty (0 bytes, 0 tokens). Rows that share a doc_id are
counted one by one. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import column, slices, stored, utf8

#: Characters of a chunk, and of the first overlap tried.
CHUNK = 32_768
OVERLAP = 256
SPACE = "▁"

_KEY = ["doc_id", "text_hash"]


class _Model:
    def __init__(self, path: str):
        self.encode = sentencepiece.SentencePieceProcessor(model_file=path)
        vocabulary = [self.encode.id_to_piece(i) for i in range(self.encode.vocab_size())]
        self.joined = {piece[i : i + 2] for piece in vocabulary for i in range(len(piece) - 1)}

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", SPACE) not in self.joined


_MODELS: dict[str, _Model] = {}


def _model(path: str) -> _Model:
    if path not in _MODELS:
        _MODELS[path] = _Model(path)
    return _MODELS[path]


def spliceable(path: str) -> bool:
    """Whether the model file keeps the conditions of the proof."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    n, t = proto.normalizer_spec, proto.trainer_spec
    return t.model_type == t.BPE and not n.precompiled_charsmap and not n.normalization_rule_tsv and not n.remove_extra_whitespaces and n.escape_whitespaces and not t.treat_whitespace_as_suffix and t.byte_fallback


def _count_whole(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _model(path).encode.encode
        for big in batches:
            for batch in slices(big, "text"):
                texts = [t.decode("utf-8", "replace") for t in column(batch, "text").to_pylist()]
                counts = [len(x) for x in encode(texts, num_threads=1)]
                rest = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in rest), pa.array(counts, pa.int64())], [*rest, "n_tokens"])

    return count


def _chunks(size: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_KEY, "chunk", "chunks", "begin", "body"]
        for batch in batches:
            for doc_id, text_hash, raw in zip(*(column(batch, c) for c in (*_KEY, "text"))):
                text = raw.as_py().decode("utf-8", "replace")
                n = max(1, -(-(len(text) - overlap) // size))
                for i in range(n):
                    body = text[i * size : (i + 1) * size + overlap] if i < n - 1 else text[i * size :]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((doc_id.as_py(), pa.int64()), (text_hash.as_py(), pa.int64()), (i, pa.int64()), (n, pa.int64()), (i * size, pa.int64()), (body, pa.string()))], names)

    return cut


def _ends(encode: sentencepiece.SentencePieceProcessor, body: str) -> np.ndarray:
    """Character at which each piece ends (the library's offsets are bytes)."""
    pieces = encode.encode(body, return_type="proto").pieces
    starts = (np.frombuffer(body.encode(), np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(starts)))[np.array([p.end for p in pieces], np.int64)]


def _seams(path: str, overlap: int):
    """Per chunk a row with its tokens; per stable boundary in an overlap the tokens beyond it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            for doc_id, text_hash, i, n, begin, body in zip(*(c.to_pylist() for c in batch.columns)):
                ends = _ends(model.encode, body)
                rows = [(i, None, len(ends), None, None)]
                bounds = np.flatnonzero(np.diff(ends, append=-1) != 0)  # a boundary holds all pieces that end at it
                for k in bounds.tolist():
                    at = int(ends[k])
                    left_seam, right_seam = i > 0 and 0 < at < overlap, i < n - 1 and len(body) - overlap < at < len(body)
                    if (left_seam or right_seam) and model.stable(body, at):
                        if left_seam:
                            rows.append((i - 1, begin + at, None, None, k + 1))
                        if right_seam:
                            rows.append((i, begin + at, None, len(ends) - k - 1, None))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(rows), pa.int64()), pa.array([text_hash] * len(rows), pa.int64()), pa.array([n] * len(rows), pa.int64()), *(pa.array(c, pa.int64()) for c in cols)], [*_KEY, "chunks", "seam", "at", "total", "beyond", "before"])

    return read


def _spliced(docs: DataFrame, path: str, size: int, overlap: int) -> DataFrame:
    """(doc_id, text_hash, n_tokens, whole): whole is false where a seam found no splice."""
    chunks = docs.select(*_KEY, utf8().alias("text")).mapInArrow(_chunks(size, overlap), "doc_id bigint, text_hash bigint, chunk bigint, chunks bigint, begin bigint, body string")
    spread = chunks.repartition(F.col("doc_id"), F.col("text_hash"), F.col("chunk"))
    rows = stored(spread.mapInArrow(_seams(path, overlap), "doc_id bigint, text_hash bigint, chunks bigint, seam bigint, at bigint, total bigint, beyond bigint, before bigint"), "count-seams")
    # Repeated rows give the same rows again: max() takes them once.
    points = rows.groupBy(*_KEY, "chunks", "seam", "at").agg(F.max("total").alias("total"), F.max("beyond").alias("beyond"), F.max("before").alias("before"))
    drop = F.col("beyond") + F.col("before")
    seams = points.groupBy(*_KEY, "chunks", "seam").agg(F.max("total").alias("total"), F.min_by(drop, F.when(drop.isNotNull(), F.col("at"))).alias("drop"))
    return seams.groupBy(*_KEY).agg(
        (F.sum("total") - F.coalesce(F.sum("drop"), F.lit(0))).alias("n_tokens"),
        (F.count("drop") == F.max("chunks") - 1).alias("whole"),
    )


def huge_counts(huge: DataFrame, path: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, text_hash, n_tokens) of documents longer than ``size``."""
    keys, done, pending = huge.select(*_KEY, "text"), [], None
    while overlap < size:
        todo = keys if pending is None else keys.join(pending, [keys[k].eqNullSafe(pending[k]) for k in _KEY], "left_semi")
        got = stored(_spliced(todo, path, size, overlap), "count-spliced")
        done.append(got.filter("whole").select(*_KEY, "n_tokens"))
        pending = got.filter("not whole").select(*_KEY)
        if pending.isEmpty():
            break
        overlap *= 2
    else:
        left = keys if pending is None else keys.join(pending, [keys[k].eqNullSafe(pending[k]) for k in _KEY], "left_semi")
        done.append(left.select(*_KEY, utf8().alias("text")).mapInArrow(_count_whole(path), "doc_id bigint, text_hash bigint, n_tokens bigint").distinct())
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    if not spliceable(path):
        size = np.iinfo(np.int32).max
    long = F.char_length("text") > size
    small = rows.filter(~long).select("doc_id", "n_bytes", utf8().alias("text")).mapInArrow(_count_whole(path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    huge = rows.filter(long).withColumn("text_hash", F.xxhash64("doc_id", "text"))
    counts = huge_counts(huge, path, size, overlap)
    keyed = huge.select("doc_id", "n_bytes", "text_hash")
    joined = keyed.join(counts.withColumnRenamed("doc_id", "_id"), [keyed.doc_id.eqNullSafe(F.col("_id")), keyed.text_hash == counts.text_hash]).select("doc_id", "n_bytes", "n_tokens")
    return small.unionByName(joined).withColumn("over_limit", F.col("n_tokens") > limit)
