"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

1. Every text is turned into STATISTICS numbers (lengths, shares of kinds of
   characters, repetition). Nothing else is an input of a score.
2. Labelled documents whose crc32(doc_id) mod 4 is 0 or 1 fit: statistics are
   standardised, N_FEATURES cosines with random directions approximate a
   Gaussian kernel, and the normal equations are summed by partition (at most
   FIT_PARTITIONS matrices of (N_FEATURES + 1)**2 numbers reach the driver).
3. Those with remainder 3 calibrate: their raw scores are counted in BINS bins,
   and pool-adjacent-violators makes the rate of label 1 rise with the score.
4. Remainder 2 is held out and never read with its label.

All labelled rows are used; labels of one doc_id are averaged.

Cases: NULL and empty texts have statistics zero and a score like any other.
NULL labels are no labels; a NULL doc_id has none and isn't held out. Without
labels to fit or calibrate every score is 0.5. Rows sharing a doc_id are scored
one by one. An empty table gives no rows. Extra columns are ignored by ``score``
and kept by ``accepted``. A text is held whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import LOWER, PLAIN_WORD, column, flat, fresh, key_filter, mix, passes, slices, span_hashes, spans, stored, utf8
from partwise.llm.line_rules import repeated_words

STATISTICS = 20
N_FEATURES = 192
RIDGE = 1e-3
SEED = 42
FIT_PARTITIONS = 32
BINS = 1000
THRESHOLD = 0.7


def _share(flags: np.ndarray, offsets: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(of, 1)


def _kind(chars: str) -> np.ndarray:
    return np.array([chr(c) in chars for c in range(256)])


_UPPER, _DIGIT, _MARKS, _SYMBOL = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _kind("0123456789"), _kind(".,;:?"), _kind("#*$%&<>~^=+")
_LETTER = np.array([65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC0 for c in range(256)])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS numbers for each text (bytes)."""
    data, offsets = flat(texts)
    n = len(texts)
    start, end, row = spans(PLAIN_WORD[data], offsets)
    hashes = span_hashes(LOWER[data], start, end)
    point = (data & 0xC0) != 0x80
    chars = _share(point, offsets, np.ones(n))
    words = np.bincount(row, minlength=n).astype(float)
    points = np.concatenate(([0], np.cumsum(point, dtype=np.int64)))
    length = (points[end] - points[start]).astype(float)
    per_word = lambda x: np.bincount(row, weights=x, minlength=n) / np.maximum(words, 1)
    mean = per_word(length)
    own = mix(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(own, return_index=True)
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    longest = np.zeros(n)
    np.maximum.at(longest, row, length)
    first_upper = _UPPER[data[start]] if len(start) else np.zeros(0)
    columns = [
        np.log1p(words), np.log1p(chars), mean, np.sqrt(np.maximum(per_word(length**2) - mean**2, 0)), np.log1p(longest),
        _share(_UPPER[data], offsets, chars), _share(_DIGIT[data], offsets, chars), _share(_LETTER[data], offsets, chars),
        _share(data >= 0xC0, offsets, chars), _share(_SYMBOL[data], offsets, words), _share(data == ord("!"), offsets, words),
        _share(data == ord("|"), offsets, words), _share(_MARKS[data], offsets, words), _share(data == ord("\n"), offsets, words),
        repeated_words(row, hashes, n) / np.maximum(words, 1), np.bincount(row[first], minlength=n) / np.maximum(words, 1),
        per_word(again.astype(float)), per_word((length <= 3).astype(float)), per_word((length == 1).astype(float)), per_word(first_upper.astype(float)),
    ]
    out = np.stack(columns, axis=1)
    out[:, 5:] = np.sqrt(np.minimum(out[:, 5:], 4))
    return out


def described(docs: DataFrame, wanted=None) -> DataFrame:
    """(doc_id, text_hash, x): the statistics of every row, or of those whose doc_id's hash passes a key filter."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            if wanted is not None:
                big = big.filter(pa.array(passes(wanted.value, column(big, "id_hash").to_numpy().view(np.uint64))))
            for batch in slices(big, "text"):
                x = statistics(column(batch, "text")).astype(np.float32)
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, STATISTICS, dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "text_hash"), values], ["doc_id", "text_hash", "x"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.xxhash64(F.col("doc_id").cast("bigint")).alias("id_hash"), utf8().alias("text"))
    return rows.mapInArrow(read, "doc_id bigint, text_hash bigint, x array<float>")


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    return column(batch, name).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS).astype(np.float64)


class Model:
    """Standardisation, random directions, ridge weights and the calibration steps; a few hundred kB at most."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(0, 1 / np.sqrt(STATISTICS), (STATISTICS, N_FEATURES))
        self.phases = rng.uniform(0, 2 * np.pi, N_FEATURES)
        self.weights = np.zeros(N_FEATURES + 1)
        self.raw, self.rate = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        cosines = np.sqrt(2 / N_FEATURES) * np.cos(z @ self.directions + self.phases)
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)

    def raw_score(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw_score(x), self.raw, self.rate)


def pool(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic rates of neighbouring bins (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for s, c in zip(sums.tolist(), counts.tolist()):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), s / c) for s, c, n in blocks])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled rows that are not held out."""
    truth = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.avg("quality").alias("y"))
    known = stored(rows.select("doc_id", "x").join(truth, "doc_id").withColumn("part", remainder(F.col("doc_id"))).filter("part != 2"), "quality-known")
    fitting = known.filter("part < 2")
    moments = fitting.select([F.element_at("x", i + 1).cast("double").alias(f"x{i}") for i in range(STATISTICS)])
    got = moments.agg(*[F.avg(c).alias(f"m_{c}") for c in moments.columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in moments.columns]).first()
    if got[0] is None:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS))
    mean, scale = np.array(got[:STATISTICS]), np.array(got[STATISTICS:])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((N_FEATURES + 1, N_FEATURES + 1)), np.zeros(N_FEATURES + 1)
        for batch in batches:
            if batch.num_rows:
                f = model.features(_matrix(batch))
                a += f.T @ f
                b += f.T @ column(batch, "y").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], ["a", "b"])

    sums = fitting.select("x", "y").coalesce(FIT_PARTITIONS).mapInArrow(normal, "a binary, b binary").collect()
    a = sum(np.frombuffer(r.a).reshape(N_FEATURES + 1, -1) for r in sums)
    b = sum(np.frombuffer(r.b) for r in sums)
    model.weights = np.linalg.solve(a + RIDGE * max(1.0, a[-1, -1]) * np.eye(len(b)), b)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw_score(_matrix(batch))), column(batch, "y")], ["raw", "y"])

    scored = known.filter("part = 3").select("x", "y").mapInArrow(raw, "raw double, y double")
    bins = scored.groupBy(F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "raw")) * BINS).alias("bin")).agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    if bins:
        model.raw = np.array([(r.bin + 0.5) / BINS for r in bins])
        model.rate = np.clip(pool(np.array([r.y for r in bins]), np.array([r.n for r in bins])), 0, 1)
    return model


def _scored(model: Model):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "text_hash"), pa.array(model.score(_matrix(batch)))], ["doc_id", "text_hash", "score"])

    return read


def _scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = stored(described(docs), "quality-statistics")
    return rows.mapInArrow(_scored(fit(rows, labels)), "doc_id bigint, text_hash bigint, score double")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    return _scores(docs, labels).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; columns as they are, whatever their names.

    The model needs the statistics of labelled rows only; those of all others are
    computed once, where they are scored and kept.
    """
    ids = F.xxhash64(F.col("doc_id").cast("bigint"))
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(labels.select(ids.alias("key")), "key"))
    (text,) = fresh(docs, "text_bytes")
    model = fit(stored(described(docs, wanted), "quality-statistics"), labels)
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, text):
                good = model.score(statistics(column(batch, text))) >= threshold
                found = batch.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays([column(found, c) for c in names], names)

    return docs.withColumn(text, utf8()).mapInArrow(keep, docs.schema)
