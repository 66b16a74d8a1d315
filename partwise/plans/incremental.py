"""Loads that keep the rollups' state: each day's job reads that day's measurements only.

``land`` publishes a load's Bronze files and, in the same commit, the state of
its measurements (:mod:`partwise.operators.state`). ``rollups`` merges the states of
all current loads. A state notes the Bronze version that it was made of; where that
is not the current one (a load that came in without its state, or files of other
writers), the rows themselves are aggregated, so the result never lags behind.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from partwise.operators.joins import union_all
from partwise.operators.state import STATE_SCHEMA, measures, merged, partial
from partwise.session import lake_root
from partwise.sources import bronze, sinks
from partwise.sources.publish import Snapshot
from partwise.sources.schemas import ddl


def state_entry(source: str, day: str) -> str:
    return f"state/{source}/{bronze.LOAD_DAY}={day}"


def _rows(spark: SparkSession, folders: list[str], source: str) -> DataFrame:
    return bronze.typed(spark.read.schema(ddl(source)).parquet(*folders), source)


def land(spark: SparkSession, frames: dict[str, DataFrame], root: str | None, load_day: dt.date | str) -> DataFrame:
    """Publish the extracts and the state of their measurements as the load of ``load_day``; returns the manifest."""
    lake, day = bronze.store(spark, root), sinks.iso(load_day)
    records = sinks.written(frames, lake.base, day)

    def summed(source: str) -> dict[str, dict]:
        of, folder = records[bronze.load_entry(source, day)]["path"], lake.fresh(state_entry(source, day))
        partial(_rows(spark, [f"{lake.base}/{of}"], source), measures()[source]).write.parquet(f"{lake.base}/{folder}")
        return {state_entry(source, day): {"path": folder, "of": of}}

    measured = [source for source in measures() if source in frames]
    with ThreadPoolExecutor(max_workers=max(1, len(measured))) as pool:
        states = list(pool.map(summed, measured))
    for state in states:
        records |= state
    lake.commit(records)
    return sinks.manifest(spark, lake.base, list(frames), day)


def read_state(spark: SparkSession, root: str | None, source: str, snapshot: Snapshot | None = None) -> DataFrame:
    """The states of all current loads of a source, one row a load and part."""
    root = lake_root(spark, root)
    lake, measure = bronze.store(spark, root), measures()[source]
    now = snapshot or lake.current()
    kept, without = [], []
    for day, folder in bronze.load_folders(spark, root, source, now).items():
        state = now.entries.get(state_entry(source, day))
        current = state is not None and f"{lake.base}/{state['of']}" == folder
        (kept if current else without).append(f"{lake.base}/{state['path']}" if current else folder)
    parts = [spark.read.schema(STATE_SCHEMA).parquet(*kept)] if kept else []
    if without:
        parts.append(partial(_rows(spark, without, source), measure))
    dated = bronze.read_dated(spark, root, source)
    if dated is not None:
        parts.append(partial(dated, measure))
    return union_all(parts) if parts else spark.createDataFrame([], STATE_SCHEMA)


def rollups(spark: SparkSession, root: str | None = None, snapshot: Snapshot | None = None) -> dict[str, DataFrame]:
    """The measurement rollups over all loads, by model name, from their states."""
    snapshot = snapshot or bronze.store(spark, root).current()
    return {m.model: merged(read_state(spark, root, source, snapshot), m) for source, m in measures().items()}
