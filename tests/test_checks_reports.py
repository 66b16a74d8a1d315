"""Data-quality checks, verdict audit and reports on hand rows."""

from __future__ import annotations

import pytest
from conftest import cert_row, cmm_row, layers_of, process_row, torque_row

from partwise.operators import checks as C
from partwise.operators import verdicts as V
from partwise.plans import reports


def _results(df):
    return {(r["model"], r["column_name"], r["test_name"]): r for r in df.collect()}


def test_check_inventory_counts():
    kinds = [c.kind for c in C.CHECKS]
    assert len(C.CHECKS) == 90
    assert kinds.count(C.NOT_NULL) == 42
    assert kinds.count(C.BETWEEN) == 29
    assert kinds.count(C.UNIQUE) == 8
    assert kinds.count(C.RELATIONSHIPS) == 7
    assert kinds.count(C.ACCEPTED) == 4
    assert len({c.check_id for c in C.CHECKS}) == 90


def test_range_check_ends_are_valid_and_null_fails(spark):
    df = spark.createDataFrame([(8000.0,), (14000.0,), (None,), (7999.0,), (14000.5,)], "spindle_speed double")
    spec = (C.Check("t", "spindle_speed", C.BETWEEN, min_value=8000.0, max_value=14000.0),)
    r = C.run_checks({"t": df}, spec).collect()[0]
    assert r["failures"] == 3 and r["status"] == "fail"


def test_unique_counts_keys_and_rows_ignoring_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("c",), (None,), (None,)], "k string")
    r = C.run_checks({"t": df}, (C.Check("t", "k", C.UNIQUE),)).collect()[0]
    assert (r["failures"], r["failing_rows"]) == (2, 5)


def test_accepted_values_counts_distinct_bad_values_not_null(spark):
    df = spark.createDataFrame([("PASS",), ("FAIL",), ("X",), ("X",), ("Y",), (None,)], "v string")
    r = C.run_checks({"t": df}, (C.Check("t", "v", C.ACCEPTED, values=("PASS", "FAIL")),)).collect()[0]
    assert (r["failures"], r["failing_rows"]) == (2, 3)


def test_relationships_count_orphan_child_rows(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    spec = (C.Check("c", "k", C.RELATIONSHIPS, to_model="p", to_field="k"),)
    r = C.run_checks({"c": child, "p": parent}, spec).collect()[0]
    assert r["failures"] == 3


def test_suite_on_hand_rows(spark):
    layers = layers_of(
        spark,
        process=[process_row("P1"), process_row("P2", batch="MISSING"), process_row("P2")],
        cmm=[cmm_row("P1", tol=0.0), cmm_row("ORPHAN")],
        torque=[torque_row("P1", verdict="maybe")],
        certs=[cert_row()],
    )
    res = _results(C.run_checks(layers.tables()))
    assert len(res) == 90
    assert res[("bronze_process_parameters", "part_id", "unique")]["failures"] == 1
    assert res[("bronze_process_parameters", "batch_id", "relationships")]["failures"] == 1
    assert res[("bronze_cmm_inspection", "part_id", "relationships")]["failures"] == 1
    assert res[("bronze_cmm_inspection", "tolerance", "measurement_between")]["failures"] == 1
    assert res[("bronze_torque_audit", "pass_fail", "accepted_values")]["failures"] == 1
    # NULL hardness fails the Gold range check for the part without a certificate.
    assert res[("mart_part_quality_summary", "hardness", "measurement_between")]["failures"] == 1
    assert res[("mart_part_quality_summary", "defect_root_cause", "accepted_values")]["failures"] == 0


def test_unique_gate_raises_on_duplicate_parts(spark):
    layers = layers_of(spark, process=[process_row("P1"), process_row("P1")], certs=[cert_row()])
    with pytest.raises(C.DataQualityError):
        C.assert_unique_keys(layers.tables())
    clean = layers_of(spark, process=[process_row("P1")], certs=[cert_row()])
    C.assert_unique_keys(clean.tables())


def test_verdict_audit(spark):
    layers = layers_of(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1", "in", measured=50.01, verdict="FAIL"), cmm_row("P1", "out", measured=50.5, verdict="PASS")],
        torque=[torque_row("P1", "ok", actual=65.0), torque_row("P1", "low", actual=60.0, verdict="PASS")],
        certs=[cert_row("B1", hardness=170.0)],
    )
    b = layers.bronze
    audit = {
        (r["source"], r["item_id"]): (r["declared_verdict"], r["recomputed_verdict"])
        for r in V.verdict_audit(b["cmm_inspection"], b["torque_audit"], b["supplier_material_certs"]).collect()
    }
    assert audit == {
        ("cmm_inspection", "in"): ("FAIL", "PASS"),
        ("cmm_inspection", "out"): ("PASS", "FAIL"),
        ("torque_audit", "low"): ("PASS", "FAIL"),
        ("supplier_material_certs", None): ("PASS", "FAIL"),
    }
    limits = {r["joint_id"]: r["limits_consistent"] for r in V.torque_verdicts(b["torque_audit"]).collect()}
    assert limits == {"ok": True, "low": True}


def _report_layers(spark):
    return layers_of(
        spark,
        process=[
            process_row("A", machine="CNC-01", day="2026-06-10"),
            process_row("B", machine="CNC-02", day="2026-06-10", coolant=40.0),
            process_row("C", machine="CNC-01", day="2026-06-11", batch="NONE"),
            process_row("D", machine="CNC-02", day="2026-06-11"),
        ],
        cmm=[
            cmm_row("A", "x", verdict="FAIL"),
            cmm_row("A", "y", verdict="FAIL"),
            cmm_row("B", "x", verdict="FAIL"),
            cmm_row("C"),
            cmm_row("D"),
        ],
        torque=[torque_row(p) for p in "ABCD"],
        certs=[cert_row()],
    )


def test_headline_and_trend(spark):
    gold = _report_layers(spark).gold
    h = reports.headline_metrics(gold).collect()[0]
    assert (h["total_parts"], h["defect_parts"]) == (4, 3)
    assert h["defect_rate"] == 0.75
    assert h["avg_quality_score"] == pytest.approx((80 + 86 + 75 + 100) / 4)
    empty = reports.headline_metrics(gold.filter("false")).collect()[0]
    assert (empty["total_parts"], empty["defect_rate"], empty["avg_quality_score"]) == (0, 0.0, 0.0)
    trend = [(str(r["production_date"]), r["defect_rate"], r["parts"]) for r in reports.daily_defect_trend(gold).collect()]
    assert trend == [("2026-06-10", 1.0, 2), ("2026-06-11", 0.5, 2)]


def test_failing_dimensions_and_filters(spark):
    gold = _report_layers(spark).gold
    dims = [(r["dimension_name"], r["failing_parts"]) for r in reports.failing_dimensions(gold).collect()]
    assert dims == [("x", 2), ("y", 1)]
    one = reports.filter_summary(gold, "2026-06-11", "2026-06-11", machine="CNC-02")
    assert [r["part_id"] for r in one.collect()] == ["D"]
    # A single date bound is ignored, as with an incomplete range picker.
    assert reports.filter_summary(gold, start="2026-06-11").count() == 4
    opts = [(r["filter_name"], r["option_value"]) for r in reports.filter_options(gold).collect()]
    assert ("machine_id", "CNC-01") in opts and ("defect_root_cause", "material") in opts


def test_correlation_constant_column_is_null(spark):
    gold = _report_layers(spark).gold
    cells = {(r["row_variable"], r["column_variable"]): r["correlation"] for r in reports.correlation_matrix(gold).collect()}
    assert len(cells) == 100
    assert cells[("spindle_speed", "defect_flag")] is None  # spindle speed is constant here
    assert cells[("coolant_temp", "coolant_temp")] == 1.0
    assert cells[("feed_rate", "coolant_temp")] == cells[("coolant_temp", "feed_rate")]


def test_part_trace_defaults_to_smallest_defective_part(spark):
    layers = _report_layers(spark)
    trace = reports.part_trace(layers.gold, layers.bronze)
    assert [r["part_id"] for r in trace["summary"].collect()] == ["A"]
    assert [r["dimension_name"] for r in trace["cmm"].collect()] == ["x", "y"]
    assert [r["batch_id"] for r in trace["cert"].collect()] == ["B1"]
    explicit = reports.part_trace(layers.gold, layers.bronze, part_id="C")
    assert explicit["cert"].count() == 0 and explicit["process"].count() == 1
    fields = reports.summary_fields(trace["summary"]).collect()
    assert len(fields) == 30 and fields[0]["field"] == "production_date"


def test_broadcast_only_below_size_limit(spark):
    from partwise.operators.joins import broadcast_if_small, estimated_bytes

    certs = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    size = estimated_bytes(certs)
    assert size is not None and size > 0

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(certs, limit=size + 1))
    assert not hinted(broadcast_if_small(certs, limit=size - 1))
    assert not hinted(broadcast_if_small(certs, limit=0))


def test_signed_round_keeps_negative_zero(spark):
    import math

    expr = reports.signed_round("x", 3)
    got = [r[0] for r in spark.sql(f"select {expr} from values (-0.0004D), (0.0004D), (-0.0006D), (0.1235D) t(x)").collect()]
    assert [math.copysign(1.0, v) for v in got[:2]] == [-1.0, 1.0]
    assert got[0] == 0.0 and got[2] == -0.001 and got[3] == 0.124


def test_correlation_treats_nan_as_missing(spark):
    import math

    import pandas as pd

    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (4.0, float("nan")), (5.0, 10.2), (6.0, 11.8), (7.0, 14.1), (None, 3.0)]
    gold = spark.createDataFrame(rows, "a double, b double")
    got = {(r.row_variable, r.column_variable): r.correlation for r in reports.correlation_matrix(gold, ("a", "b")).collect()}
    want = pd.DataFrame(rows, columns=["a", "b"]).astype(float).corr().round(3)
    assert all(math.isclose(got[x, y], want.loc[x, y]) for x in "ab" for y in "ab")
    assert {r.correlation for r in reports.correlation_matrix(gold.limit(0), ("a", "b")).collect()} == {None}
