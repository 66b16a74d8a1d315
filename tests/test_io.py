"""Bronze reading (layouts, drift, nanosecond timestamps) and daily writes."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd
from conftest import RAW_DDL, cert_row, cmm_row, process_row, torque_row

from partwise.sources import bronze as B
from partwise.sources import sinks


def _write_day(root, source, day, frame):
    folder = os.path.join(root, "bronze", source, day)
    os.makedirs(folder, exist_ok=True)
    frame.to_parquet(os.path.join(folder, f"{source}_{day.replace('-', '')}.parquet"), index=False)


def _process_frame(day, parts, spindle):
    return pd.DataFrame(
        {
            "process_ts": pd.to_datetime([f"{day} 05:30:01"] * len(parts)),
            "production_date": [day] * len(parts),
            "part_id": parts,
            "part_model": ["M"] * len(parts),
            "line_id": ["LINE-A"] * len(parts),
            "shift": ["A"] * len(parts),
            "machine_id": ["CNC-01"] * len(parts),
            "batch_id": ["B1"] * len(parts),
            "spindle_speed": spindle,
            "feed_rate": [600.0] * len(parts),
            "coolant_temp": [27.0] * len(parts),
            "cycle_time": [90.0] * len(parts),
        }
    )


def test_daily_layout_with_type_drift_extra_and_missing_columns(spark, scratch):
    # Day 1: spindle_speed as int64; day 2: double plus an extra column;
    # day 3: no cycle_time column. Timestamps are pandas nanoseconds.
    _write_day(scratch, "process_parameters", "2026-06-09", _process_frame("2026-06-09", ["P1"], [10500]))
    extra = _process_frame("2026-06-10", ["P2"], [10500.5]).assign(operator="x")
    _write_day(scratch, "process_parameters", "2026-06-10", extra)
    missing = _process_frame("2026-06-11", ["P3"], [11000.0]).drop(columns=["cycle_time"])
    _write_day(scratch, "process_parameters", "2026-06-11", missing)

    df = B.read_bronze(spark, scratch, "process_parameters")
    assert [c for c, _ in df.dtypes][:3] == ["process_ts", "production_date", "part_id"]
    assert dict(df.dtypes)["spindle_speed"] == "double"
    assert dict(df.dtypes)["process_ts"] == "timestamp_ntz"
    assert "operator" not in df.columns
    rows = {r["part_id"]: r for r in df.collect()}
    assert rows["P1"]["spindle_speed"] == 10500.0
    assert rows["P2"]["spindle_speed"] == 10500.5
    assert rows["P3"]["cycle_time"] is None
    assert rows["P1"]["process_ts"] == dt.datetime(2026, 6, 9, 5, 30, 1)
    assert rows["P2"]["production_date"] == dt.date(2026, 6, 10)


def test_daily_layout_compatible_drift_uses_merged_read(spark, scratch):
    _write_day(scratch, "process_parameters", "2026-06-10", _process_frame("2026-06-10", ["P1"], [1.0]))
    _write_day(
        scratch, "process_parameters", "2026-06-11", _process_frame("2026-06-11", ["P2"], [2.0]).drop(columns=["shift"])
    )
    rows = {r["part_id"]: r for r in B.read_bronze(spark, scratch, "process_parameters").collect()}
    assert rows["P1"]["shift"] == "A" and rows["P2"]["shift"] is None


def _process(spark, parts, day="2026-06-10"):
    return spark.createDataFrame([process_row(p, day=day) for p in parts], RAW_DDL["process_parameters"])


def _certs(spark, batches):
    return spark.createDataFrame([cert_row(b) for b in batches], RAW_DDL["supplier_material_certs"])


def _parts(spark, root):
    return sorted((r["part_id"], str(r["production_date"])) for r in B.read_bronze(spark, root, "process_parameters").collect())


def test_rerun_replaces_exactly_its_load_day(spark, scratch):
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["A1", "A2"])}, scratch, "2026-06-10")
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["B1"], "2026-06-11")}, scratch, "2026-06-11")
    manifest = sinks.load_sources(spark, {"process_parameters": _process(spark, ["B2", "B3"], "2026-06-11")}, scratch, "2026-06-11")
    assert [tuple(r) for r in manifest.collect()] == [
        ("process_parameters", dt.date(2026, 6, 11), 2, "bronze/process_parameters/load_day=2026-06-11")
    ]
    assert [p for p, _ in _parts(spark, scratch)] == ["A1", "A2", "B2", "B3"]
    empty = sinks.load_sources(spark, {"process_parameters": _process(spark, []), "supplier_material_certs": _certs(spark, [])}, scratch, "2026-06-11")
    assert {r["source"]: r["rows"] for r in empty.collect()} == {"process_parameters": 0, "supplier_material_certs": 0}
    assert [p for p, _ in _parts(spark, scratch)] == ["A1", "A2"]


def test_late_rows_keep_their_day_and_wipe_nothing(spark, scratch):
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["A", "C"], "2026-06-10")}, scratch, "2026-06-10")
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["late"], "2026-06-10")}, scratch, "2026-06-11")
    assert _parts(spark, scratch) == [("A", "2026-06-10"), ("C", "2026-06-10"), ("late", "2026-06-10")]


def test_certificates_of_overlapping_dates_survive_the_next_load(spark, scratch):
    sinks.load_sources(spark, {"supplier_material_certs": _certs(spark, ["B1", "B2"])}, scratch, "2026-06-10")
    sinks.load_sources(spark, {"supplier_material_certs": _certs(spark, ["B3"])}, scratch, "2026-06-11")
    got = B.read_bronze(spark, scratch, "supplier_material_certs")
    assert sorted(r["batch_id"] for r in got.collect()) == ["B1", "B2", "B3"]
    assert "load_day" not in got.columns


def test_rows_without_a_day_are_written_and_counted(spark, scratch):
    frame = spark.createDataFrame([process_row("A", day=None), process_row("B")], RAW_DDL["process_parameters"])
    manifest = sinks.load_sources(spark, {"process_parameters": frame}, scratch, "2026-06-10")
    assert manifest.collect()[0]["rows"] == 2
    assert _parts(spark, scratch) == [("A", "None"), ("B", "2026-06-11")]


def test_both_layouts_under_one_root(spark, scratch):
    _write_day(scratch, "process_parameters", "2026-06-09", _process_frame("2026-06-09", ["P1"], [10500]))
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["P2"])}, scratch, "2026-06-10")
    for merge in (True, False):
        got = {r["part_id"]: r["spindle_speed"] for r in B.read_bronze(spark, scratch, "process_parameters", merge).collect()}
        assert got == {"P1": 10500.0, "P2": 10500.0}


def test_one_footer_read_still_asks_for_all_declared_columns(spark, scratch):
    _write_day(scratch, "process_parameters", "2026-06-10", _process_frame("2026-06-10", ["P1"], [1.0]).drop(columns=["shift"]))
    _write_day(scratch, "process_parameters", "2026-06-11", _process_frame("2026-06-11", ["P2"], [2.0]))
    rows = {r["part_id"]: r["shift"] for r in B.read_bronze(spark, scratch, "process_parameters", merge_schema=False).collect()}
    assert rows == {"P1": None, "P2": "A"}


def test_extra_columns_stay_in_the_files(spark, scratch):
    sinks.write_bronze(_process(spark, ["P1"]).selectExpr("*", "'x' as note"), "process_parameters", scratch, "2026-06-10")
    assert spark.read.parquet(f"{scratch}/bronze/process_parameters/load_day=2026-06-10").first()["note"] == "x"


def test_load_and_rebuild_gold_from_files(spark, scratch):
    from partwise.plans.layers import from_bronze

    frames = {
        "process_parameters": spark.createDataFrame([process_row("P1"), process_row("P2")], RAW_DDL["process_parameters"]),
        "cmm_inspection": spark.createDataFrame([cmm_row("P1"), cmm_row("P2", verdict="fail")], RAW_DDL["cmm_inspection"]),
        "torque_audit": spark.createDataFrame([torque_row("P1"), torque_row("P2")], RAW_DDL["torque_audit"]),
        "supplier_material_certs": spark.createDataFrame([cert_row()], RAW_DDL["supplier_material_certs"]),
    }
    sinks.load_sources(spark, frames, scratch, "2026-06-11")
    gold = {r["part_id"]: r for r in from_bronze(spark, scratch).gold.collect()}
    assert gold["P1"]["defect_root_cause"] == "none"
    assert gold["P2"]["defect_root_cause"] == "dimension"


def test_views_and_layer_tables(spark, scratch):
    from conftest import layers_of

    from partwise.plans.layers import register_views, save_tables

    layers = layers_of(
        spark, process=[process_row("P1")], cmm=[cmm_row("P1")], torque=[torque_row("P1")], certs=[cert_row()]
    )
    names = register_views(layers, prefix="t_")
    assert "t_mart_part_quality_summary" in names and len(names) == 10
    assert spark.sql("select defect_root_cause from t_mart_part_quality_summary").collect()[0][0] == "none"
    saved = save_tables(spark, layers, scratch)
    assert saved[-1] == "gold.mart_part_quality_summary"
    assert spark.table("silver.silver_cmm_quality").count() == 1
    assert os.path.isdir(os.path.join(scratch, "gold", "mart_part_quality_summary"))


def test_materialize_writes_each_layer_and_matches_lazy_gold(spark, scratch):
    from conftest import frames

    from partwise.plans.layers import build_layers, materialize, typed_sources

    typed = typed_sources(
        frames(
            spark,
            process=[process_row("P1"), process_row("P2", batch="NONE")],
            cmm=[cmm_row("P1", verdict="FAIL"), cmm_row("P2")],
            torque=[torque_row("P1")],
            certs=[cert_row()],
        )
    )
    stored = materialize(spark, typed, scratch)
    for layer, name in [("silver", "silver_cmm_quality"), ("silver", "silver_part_quality_flags"),
                        ("gold", "mart_part_quality_summary")]:
        assert os.path.isdir(os.path.join(scratch, layer, name))
    lazy = build_layers(typed)
    assert sorted(map(tuple, stored.gold.collect())) == sorted(map(tuple, lazy.gold.collect()))
    assert sorted(map(tuple, stored.flags.collect())) == sorted(map(tuple, lazy.flags.collect()))
    assert stored.material_quality.count() == 2


def test_daily_run_lands_rebuilds_and_checks(spark, scratch):
    import pytest

    from partwise.operators.checks import DataQualityError
    from partwise.plans.daily import run_daily

    def day_frames(day, parts, verdict="PASS"):
        return {
            "process_parameters": spark.createDataFrame(
                [process_row(p, day=day) for p in parts], RAW_DDL["process_parameters"]
            ),
            "cmm_inspection": spark.createDataFrame(
                [cmm_row(p, verdict=verdict) for p in parts], RAW_DDL["cmm_inspection"]
            ),
            "torque_audit": spark.createDataFrame([torque_row(p) for p in parts], RAW_DDL["torque_audit"]),
            "supplier_material_certs": spark.createDataFrame([cert_row()], RAW_DDL["supplier_material_certs"]),
        }

    first = run_daily(spark, day_frames("2026-06-10", ["A1", "A2"]), scratch, "2026-06-10")
    assert {r["source"] for r in first.manifest.collect()} == {
        "process_parameters", "cmm_inspection", "torque_audit", "supplier_material_certs"
    }
    assert first.layers.gold.count() == 2
    # Day two lands the same certificate batch again under its own day, which
    # duplicates the batch key: the gate stops the build.
    with pytest.raises(DataQualityError):
        run_daily(spark, day_frames("2026-06-11", ["B1"]), scratch, "2026-06-11")
    # Rerunning day two with an empty certificate extract replaces the day's
    # certificates, so the build goes through.
    frames = day_frames("2026-06-11", ["B1"], verdict="FAIL")
    frames["supplier_material_certs"] = spark.createDataFrame([], RAW_DDL["supplier_material_certs"])
    second = run_daily(spark, frames, scratch, "2026-06-11")
    counts = {r["source"]: r["rows"] for r in second.manifest.collect()}
    assert counts == {
        "process_parameters": 1, "cmm_inspection": 1, "torque_audit": 1, "supplier_material_certs": 0
    }
    gold = {r["part_id"]: r["defect_root_cause"] for r in second.layers.gold.collect()}
    assert gold == {"A1": "none", "A2": "none", "B1": "dimension"}
    results = second.checks.collect()
    assert len(results) == 90
    assert all(r["status"] == "pass" for r in results if r["test_name"] == "unique")
