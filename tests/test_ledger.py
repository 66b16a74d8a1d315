"""Ledger of drifted schemas: few jobs to learn, none to know."""

from __future__ import annotations

import os

import pandas as pd
from test_io import _process_frame, _write_day

from partwise.sources import bronze as B
from partwise.sources.ledger import Ledger, dated_files
from partwise.sources.schemas import SOURCE_SCHEMAS

SOURCE = "process_parameters"
KNOWN = {name for name, _ in SOURCE_SCHEMAS[SOURCE]}


def _jobs(spark, group, fn):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = fn()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")


def _learned(spark, root):
    return list(Ledger(spark, f"{root}/_schemas/{SOURCE}").types(dated_files(spark, B.source_path(root, SOURCE)), KNOWN))


def test_a_year_of_alternating_writers(spark, scratch):
    first, second = _process_frame("2026-06-09", ["P"], [1]), _process_frame("2026-06-09", ["P"], [1.5]).assign(note="x")
    days = [d.date().isoformat() for d in pd.date_range("2025-01-01", periods=365)]
    for n, day in enumerate(days):
        _write_day(scratch, SOURCE, day, second if n % 2 else first)
    df, jobs = _jobs(spark, "learn", lambda: B.read_bronze(spark, scratch, SOURCE))
    # Per list of over 32 folders Spark lists their files by a job: one merge that fails, one a writer, and the two scans.
    assert jobs <= 8
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    again, jobs = _jobs(spark, "know", lambda: B.read_bronze(spark, scratch, SOURCE))
    assert jobs <= 2  # the scans list their files; no footer is read
    assert again.count() == 365 and again.filter("spindle_speed = 1.5").count() == 182
    # One more day is one folder to learn.
    _write_day(scratch, SOURCE, "2026-01-01", second)
    more, jobs = _jobs(spark, "new", lambda: B.read_bronze(spark, scratch, SOURCE))
    assert jobs <= 3 and more.count() == 366


def test_replaced_files_are_learned_again(spark, scratch):
    day = "2026-06-10"
    _write_day(scratch, SOURCE, day, _process_frame(day, ["A"], [1]))
    assert [t["spindle_speed"].simpleString() for _, t in _learned(spark, scratch)] == ["bigint"]
    _write_day(scratch, SOURCE, day, _process_frame(day, ["A", "B"], [1.5, 2.5]))
    assert [t["spindle_speed"].simpleString() for _, t in _learned(spark, scratch)] == ["double"]
    assert {r.part_id: r.spindle_speed for r in B.read_bronze(spark, scratch, SOURCE).collect()} == {"A": 1.5, "B": 2.5}
    folder = os.path.join(scratch, "bronze", SOURCE, day)
    _process_frame(day, ["C"], [7]).to_parquet(f"{folder}/later.parquet", index=False)
    assert sorted(r.spindle_speed for r in B.read_bronze(spark, scratch, SOURCE).collect()) == [1.5, 2.5, 7.0]


def test_folders_that_vanish_are_forgotten(spark, scratch):
    for day in ("2026-06-10", "2026-06-11"):
        _write_day(scratch, SOURCE, day, _process_frame(day, [day], [1]))
    _learned(spark, scratch)
    folder = os.path.join(scratch, "bronze", SOURCE, "2026-06-10")
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    _write_day(scratch, SOURCE, "2026-06-12", _process_frame("2026-06-12", ["x"], [1.5]))
    _learned(spark, scratch)
    ledger = Ledger(spark, f"{scratch}/_schemas/{SOURCE}")
    assert set(ledger.store.current().entries) == {"2026-06-11", "2026-06-12"} and len(ledger.store.numbers()) == 1
