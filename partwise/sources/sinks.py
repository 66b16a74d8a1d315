"""Landing extracts as Bronze Parquet by load day, and the load manifest.

Layout: ``<root>/bronze/<source>/load_day=<YYYY-MM-DD>/version=<id>/part-*.parquet``,
and the commit log of the lake (:mod:`partwise.sources.publish`), which names each
load day's current version. The load day is where an extract lands, nothing else:
every row keeps its own production_date inside the file, so late rows stay late
rows and certificates keep their cert_date. A load replaces exactly its load day,
for all its sources at once and only when everything is written; loading the day
again, or with an empty extract, leaves every other day alone.

Known columns are cast to their declared types before the write (extra ones are
kept as they come), so files of this layout have one schema for all time and
are read without looking at footers. Rows are range-partitioned by key: files
hold ranges of keys, point lookups skip files and row groups, and a day holding
many rows is written by many tasks. Rows are counted while they are written; the counts
are part of the commit, so the manifest reads no data.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from partwise.sources.bronze import LOAD_DAY, declared, load_entry, store
from partwise.sources.schemas import SOURCES

SORT_KEY = {
    "process_parameters": "part_id",
    "cmm_inspection": "part_id",
    "torque_audit": "part_id",
    "supplier_material_certs": "batch_id",
}
MANIFEST_SCHEMA = "source string, load_day date, rows bigint, relative_path string"


def iso(day: dt.date | str) -> str:
    return dt.date.fromisoformat(str(day)[:10]).isoformat()


def _write(frame: DataFrame, source: str, root: str | None, day: str) -> dict[str, dict]:
    """Write one extract to a fresh folder; the record that makes it current."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}")
    lake, entry, key = store(frame.sparkSession, root), load_entry(source, day), SORT_KEY[source]
    folder = lake.fresh(entry)
    # Counted behind the exchange: the exchange samples what is before it, and those rows would count twice.
    counted = Observation()
    rows = declared(frame, source).repartitionByRange(F.col(key)).sortWithinPartitions(key)
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{lake.base}/{folder}")
    return {entry: {"path": folder, "rows": int(counted.get["rows"]), "source": source, "load_day": day}}


def write_bronze(frame: DataFrame, source: str, root: str | None, load_day: dt.date | str) -> str:
    """Publish one extract as the load of ``load_day``, in place of what that day held; returns its folder."""
    lake = store(frame.sparkSession, root)
    record = _write(frame, source, root, iso(load_day))
    lake.commit(record)
    return f"{lake.base}/{next(iter(record.values()))['path']}"


def manifest(spark: SparkSession, root: str | None, sources: list[str] | None = None, load_day: dt.date | str | None = None) -> DataFrame:
    """(source, load_day, rows, relative_path) of the loads that are current, from their commit; of the given sources and day, or all.

    No data is read, and it is there for every later session. An empty extract has its row, with 0.
    """
    day = None if load_day is None else iso(load_day)
    rows = [
        (r["source"], dt.date.fromisoformat(r["load_day"]), r["rows"], load_entry(r["source"], r["load_day"]))
        for entry, r in sorted(store(spark, root).current().entries.items())
        if entry.startswith("bronze/") and day in (None, r["load_day"]) and (sources is None or r["source"] in sources)
    ]
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def written(frames: dict[str, DataFrame], root: str | None, day: str) -> dict[str, dict]:
    """Write extracts to fresh folders; the records that make them current."""
    records: dict[str, dict] = {}
    # Sources are independent: submitted together, the last tasks of one leave no executor idle.
    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        for record in pool.map(lambda item: _write(item[1], item[0], root, day), frames.items()):
            records |= record
    return records


def load_sources(spark: SparkSession, frames: dict[str, DataFrame], root: str | None, load_day: dt.date | str) -> DataFrame:
    """Publish the given extracts as the load of ``load_day``, in one commit, and return its manifest."""
    day = iso(load_day)
    store(spark, root).commit(written(frames, root, day))
    return manifest(spark, root, list(frames), day)
