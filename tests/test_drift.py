"""Drifted dated folders: Spark scans by schema, split and pruned; drift inside a folder."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd
from test_io import _process_frame, _write_day

from partwise.sources import bronze as B

SOURCE = "process_parameters"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_split_and_pruned(spark, scratch):
    for n, speed in enumerate((1, 2.5, 3, 4.5, 5)):
        day = f"2026-06-{10 + n}"
        _write_day(scratch, SOURCE, day, _process_frame(day, [f"P{n}-{k}" for k in range(20000)], [speed] * 20000))
    df = B.read_bronze(spark, scratch, SOURCE)
    plan = _plan(df.select("part_id", "spindle_speed"))
    assert plan.count("FileScan parquet") == 2 and "MapInArrow" not in plan
    assert plan.count("ReadSchema: struct<part_id:string,spindle_speed:") == 2
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        assert B.read_bronze(spark, scratch, SOURCE).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    got = {(r.part_id[:2], r.spindle_speed, r.production_date) for r in df.collect()}
    assert got == {(f"P{n}", speed, dt.date(2026, 6, 10 + n)) for n, speed in enumerate((1.0, 2.5, 3.0, 4.5, 5.0))} and df.count() == 100000


def test_drift_inside_a_folder_and_odd_types(spark, scratch):
    day = "2026-06-10"
    _write_day(scratch, SOURCE, day, _process_frame(day, ["A"], [1]))
    folder = os.path.join(scratch, "bronze", SOURCE, day)
    _process_frame(day, ["B"], ["2.5"]).assign(note=1).to_parquet(f"{folder}/second.parquet", index=False)
    _process_frame(day, ["C"], [3.5]).assign(note="x", production_date=pd.to_datetime([day]).astype("datetime64[ns]")).to_parquet(f"{folder}/third.parquet", index=False)
    _write_day(scratch, SOURCE, "2026-06-11", _process_frame("2026-06-11", ["D"], [None]).drop(columns=["shift"]))
    os.makedirs(os.path.join(scratch, "bronze", SOURCE, "2026-06-12"))
    got = {r.part_id: (r.spindle_speed, str(r.production_date), r["shift"], r.process_ts.minute) for r in B.read_bronze(spark, scratch, SOURCE).collect()}
    assert got == {"A": (1.0, day, "A", 30), "B": (2.5, day, "A", 30), "C": (3.5, day, "A", 30), "D": (None, "2026-06-11", None, 30)}


def test_nanosecond_timestamps_are_exact(spark, scratch):
    day = "2026-06-10"
    stamps = [pd.Timestamp(f"{day} 05:30:01") + pd.Timedelta(microseconds=k * 7919) for k in range(300)]
    _write_day(scratch, SOURCE, day, _process_frame(day, [f"A{k}" for k in range(300)], [1] * 300).assign(process_ts=stamps))
    _write_day(scratch, SOURCE, "2026-06-11", _process_frame("2026-06-11", ["B"], [1.5]))
    got = {r.part_id: r.process_ts for r in B.read_bronze(spark, scratch, SOURCE).collect()}
    assert all(got[f"A{k}"] == stamp.to_pydatetime() for k, stamp in enumerate(stamps))
