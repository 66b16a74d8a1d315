"""Pairwise moments of many columns as one mergeable aggregate.

For every pair of columns, over the rows where both are present: the count, the
means, the sums of squared deviations and of their products, and the ranges. A task
makes one such state of all its rows, a batch at a time and centred on the batch's
own means, and states are merged pairwise, so one row a task is shuffled, whatever
the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a state: count, means, squared deviations, products, least and largest of either column.
N, MEAN_X, MEAN_Y, DEV_X, DEV_Y, PRODUCT, LEAST_X, MOST_X, LEAST_Y, MOST_Y = range(10)
#: Tasks that merge the states of all others before the last one does.
FAN = 32
_STATE = "state binary"


def pairs_of(columns: tuple[str, ...] | list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]


def empty(n: int) -> np.ndarray:
    state = np.zeros((10, n))
    state[[LEAST_X, LEAST_Y]], state[[MOST_X, MOST_Y]] = np.inf, -np.inf
    return state


def of_rows(values: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
    """State of a matrix of rows; NaN is missing."""
    state, present = empty(len(pairs)), ~np.isnan(values)
    for k, (i, j) in enumerate(pairs):
        both = present[:, i] & present[:, j]
        x, y = values[both, i], values[both, j]
        if len(x):
            mx, my = x.mean(), y.mean()
            dx, dy = x - mx, y - my
            state[:, k] = len(x), mx, my, dx @ dx, dy @ dy, dx @ dy, x.min(), x.max(), y.min(), y.max()
    return state


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """State of the rows of both."""
    n = a[N] + b[N]
    share = np.divide(b[N], n, out=np.zeros_like(n), where=n > 0)
    dx, dy, weight = b[MEAN_X] - a[MEAN_X], b[MEAN_Y] - a[MEAN_Y], a[N] * share
    return np.stack(
        [
            n, a[MEAN_X] + dx * share, a[MEAN_Y] + dy * share,
            a[DEV_X] + b[DEV_X] + dx * dx * weight, a[DEV_Y] + b[DEV_Y] + dy * dy * weight, a[PRODUCT] + b[PRODUCT] + dx * dy * weight,
            np.minimum(a[LEAST_X], b[LEAST_X]), np.maximum(a[MOST_X], b[MOST_X]),
            np.minimum(a[LEAST_Y], b[LEAST_Y]), np.maximum(a[MOST_Y], b[MOST_Y]),
        ]
    )


def correlation(state: np.ndarray) -> np.ndarray:
    """Pearson's r of every pair; NaN where no row counts or a side is constant (told by its range, so rounding has no part in it)."""
    varied = (state[N] > 0) & (state[LEAST_X] < state[MOST_X]) & (state[LEAST_Y] < state[MOST_Y])
    below = np.sqrt(state[DEV_X]) * np.sqrt(state[DEV_Y])
    return np.divide(state[PRODUCT], below, out=np.full(len(below), np.nan), where=varied & (below > 0))


def _states(pairs: list[tuple[int, int]]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if len(batch):
                values = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
                new = of_rows(values, pairs)
                state = new if state is None else merge(state, new)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([state.tobytes()], pa.binary())], ["state"])

    return read


def _merged(n: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for held in batch.column(0):
                new = np.frombuffer(held.as_py()).reshape(10, n)
                state = new if state is None else merge(state, new)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([state.tobytes()], pa.binary())], ["state"])

    return read


def _correlations(names: list[tuple[str, str]]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _merged(len(names))(batches):
            r = correlation(np.frombuffer(batch.column(0)[0].as_py()).reshape(10, len(names)))
            first, second = zip(*names)
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), pa.array(r, from_pandas=True)], ["a", "b", "r"])

    return read


def correlations(rows: DataFrame) -> DataFrame:
    """(a, b, r) of every pair of the columns of ``rows`` (doubles; NULL and NaN are missing), each once; no row for no rows."""
    columns = rows.columns
    pairs = pairs_of(columns)
    names = [(columns[i], columns[j]) for i, j in pairs]
    states = rows.mapInArrow(_states(pairs), _STATE)
    states = states.repartition(FAN).mapInArrow(_merged(len(pairs)), _STATE)
    return states.repartition(1).mapInArrow(_correlations(names), "a string, b string, r double").filter(F.col("a").isNotNull())
