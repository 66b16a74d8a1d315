"""Pairwise moments: states of any split merge to the same; correlations as numpy's on pairwise-complete rows."""

from __future__ import annotations

import numpy as np
import pytest

from partwise.operators import moments
from partwise.plans import reports


def _values(rng, n, k):
    x = rng.normal(size=(n, k)) * 10.0 ** rng.integers(-3, 6, k) + 10.0 ** rng.integers(-2, 7, k)
    x[:, 1] = x[:, 0] * 2 - x[:, 1] * 1e-6
    x[:, 2] = 0.1  # constant
    x[rng.random((n, k)) < 0.2] = np.nan
    return x


def _plain(x, pairs):
    out = []
    for i, j in pairs:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        a, b = x[both, i], x[both, j]
        out.append(np.corrcoef(a, b)[0, 1] if len(a) > 1 and a.min() < a.max() and b.min() < b.max() else np.nan)
    return np.array(out)


def test_any_split_merges_to_the_same():
    rng = np.random.default_rng(1)
    x = _values(rng, 997, 5)
    pairs = moments.pairs_of(list("abcde"))
    want = _plain(x, pairs)
    for parts in (1, 2, 9, 500):
        state = moments.empty(len(pairs))
        for cut in np.array_split(x, parts):
            state = moments.merge(state, moments.of_rows(cut, pairs))
        assert np.allclose(moments.correlation(state), want, atol=1e-9, equal_nan=True)
    assert np.isnan(want[[2, 6, 9, 10, 11]]).all()  # all pairs of the constant column


def test_large_offsets_keep_their_digits():
    rng = np.random.default_rng(2)
    a = rng.normal(size=2000)
    x = np.stack([1e9 + a, 1e9 - a + rng.normal(size=2000) * 0.5], axis=1)
    pairs = moments.pairs_of(["a", "b"])
    state = moments.empty(3)
    for cut in np.array_split(x, 40):
        state = moments.merge(state, moments.of_rows(cut, pairs))
    assert abs(moments.correlation(state)[1] - np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 1e-6


@pytest.mark.parametrize("parts", [1, 40])
def test_matrix_over_many_tasks(spark, parts):
    rng = np.random.default_rng(3)
    x = _values(rng, 600, 4)
    rows = [tuple(None if np.isnan(v) and n % 2 else float(v) for v in r) for n, r in enumerate(x)]
    gold = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(parts)
    names = ["a", "b", "c", "d"]
    want = {}
    for (i, j), r in zip(moments.pairs_of(names), _plain(x, moments.pairs_of(names))):
        want[names[i], names[j]] = want[names[j], names[i]] = None if np.isnan(r) else round(r, 3)
    got = {(r.row_variable, r.column_variable): r.correlation for r in reports.correlation_matrix(gold, tuple(names)).collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and (got[k] is None or abs(got[k] - want[k]) < 1.5e-3) for k in want)


def test_one_row_a_task_is_shuffled(spark):
    gold = spark.range(0, 100000, 1, 7).selectExpr("cast(id as double) as a", "cast(id % 17 as double) as b")
    df = reports.correlation_matrix(gold, ("a", "b"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    shuffles = []

    def walk(node):
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            shuffles.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    assert shuffles and max(shuffles) <= 7  # rows of Gold: 100,000 in 7 tasks
