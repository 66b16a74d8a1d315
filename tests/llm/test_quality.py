"""Quality classifier: held-out accuracy, statistics by brute force, isotonic fit, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from partwise.llm import quality


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b"One two two THREE!!", "é à ü".encode(), b"a | b | c ### 12", b"same same same same\nsame"]
    together = quality.statistics(pa.array(texts, pa.binary()))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], quality.statistics(pa.array([t], pa.binary()))[0])
    assert together.shape == (5, quality.STATISTICS) and not together[0].any()
    assert np.isclose(together[1][0], np.log1p(4)) and np.isclose(together[1][2], 16 / 4)


def test_pool():
    got = quality.pool(np.array([0.0, 2.0, 1.0, 3.0, 4.0]), np.array([4.0, 4.0, 4.0, 4.0, 4.0]))
    assert np.allclose(got, [0, 0.375, 0.375, 0.75, 1.0])


def rows_of(n):
    rng = np.random.default_rng(4)
    out = []
    for i in range(n):
        words = rng.choice(["lorem", "ipsum,", "dolor", "Sit", "amet.", "of", "the"], 60).tolist()
        good = i % 4 != 0
        out.append((i, " ".join(words if good else [w.upper() + "!!" for w in words]), int(good)))
    return out


def test_held_out_accuracy(spark):
    rows = rows_of(600)
    docs = spark.createDataFrame([(d, t, "x") for d, t, _ in rows] + [(None, None, "x"), (9000, "", "x"), (5, rows[5][1], "x")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(d, y if zlib.crc32(str(d).encode()) % 4 != 2 else 1 - y, 0) for d, _, y in rows] + [(3, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = quality.score(docs, labels).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = {d: y for d, _, y in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in [*truth, 9000] if zlib.crc32(str(d).encode()) % 4 == 2}
    # Held-out labels were turned round: had they been read, this would fail.
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]) == 1
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)


@pytest.mark.parametrize("labelled", [[], [(1, 1)]])
def test_few_labels(spark, labelled):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int")
    assert quality.score(docs, labels).count() == 2
    assert quality.score(docs.limit(0), labels).count() == 0
