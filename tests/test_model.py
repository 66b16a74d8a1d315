"""Hand rows through Bronze -> Silver -> Gold, one branch per case."""

from __future__ import annotations

from conftest import cert_row, cmm_row, gold_by_part, layers_of, process_row, torque_row


def test_clean_part_scores_100(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1")],
        torque=[torque_row("P1")],
        certs=[cert_row()],
    )["P1"]
    assert g["defect_root_cause"] == "none"
    assert g["defect_flag"] is False
    assert g["composite_quality_score"] == 100
    assert g["material_failure_reason"] == "in_spec"
    assert g["failing_dimension_names"] == "" and g["failing_joint_ids"] == ""


def test_same_dimension_failing_twice_is_listed_once_and_counted_twice(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1", "bore", verdict="FAIL"), cmm_row("P1", "bore", verdict="FAIL")],
        torque=[torque_row("P1")],
        certs=[cert_row()],
    )["P1"]
    assert g["failing_dimension_names"] == "bore"
    assert g["failed_dimension_count"] == 2
    assert g["inspected_dimension_count"] == 2
    assert g["composite_quality_score"] == 80


def test_failing_names_are_sorted_by_bytes(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1", d, verdict="FAIL") for d in ("b", "a", "B")],
        torque=[torque_row("P1")],
        certs=[cert_row()],
    )["P1"]
    assert g["failing_dimension_names"] == "B, a, b"


def test_two_failing_joints(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1")],
        torque=[torque_row("P1", "J2", verdict="FAIL"), torque_row("P1", "J1", verdict="FAIL"), torque_row("P1", "J3")],
        certs=[cert_row()],
    )["P1"]
    assert g["failing_joint_ids"] == "J1, J2"
    assert g["failed_joint_count"] == 2
    assert g["composite_quality_score"] == 70
    assert g["defect_root_cause"] == "torque"


def test_score_is_clamped_at_zero(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1", f"d{i}", verdict="FAIL") for i in range(8)],
        torque=[torque_row("P1", "J1", verdict="FAIL"), torque_row("P1", "J2", verdict="FAIL")],
        certs=[cert_row()],
    )["P1"]
    assert g["composite_quality_score"] == 0


def test_process_risk_thresholds_are_strict(spark):
    parts = gold_by_part(
        spark,
        process=[
            process_row("A", coolant=34.0, feed=710.0),
            process_row("B", coolant=34.1, feed=600.0),
            process_row("C", coolant=30.0, feed=710.1),
        ],
        cmm=[cmm_row(p) for p in "ABC"],
        torque=[torque_row(p) for p in "ABC"],
        certs=[cert_row()],
    )
    assert parts["A"]["composite_quality_score"] == 100
    assert parts["B"]["composite_quality_score"] == 96
    assert parts["C"]["composite_quality_score"] == 97
    # Risk lowers the score but is not a defect.
    assert parts["B"]["defect_flag"] is False


def test_root_cause_priority_dimension_first(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1", batch="BAD")],
        cmm=[cmm_row("P1", verdict="FAIL")],
        torque=[torque_row("P1", verdict="FAIL")],
        certs=[cert_row("BAD", hardness=170.0)],
    )["P1"]
    assert g["defect_root_cause"] == "dimension"
    assert g["composite_quality_score"] == 100 - 10 - 15 - 25


def test_missing_cmm_with_torque_failure_is_torque(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        torque=[torque_row("P1", verdict="FAIL")],
        certs=[cert_row()],
    )["P1"]
    assert g["defect_root_cause"] == "torque" and g["defect_flag"] is True
    assert g["inspected_dimension_count"] == 0
    assert g["max_dimension_tolerance_utilization"] is None


def test_missing_cmm_otherwise_good_is_unknown(spark):
    g = gold_by_part(spark, process=[process_row("P1")], torque=[torque_row("P1")], certs=[cert_row()])["P1"]
    assert g["defect_root_cause"] == "unknown" and g["defect_flag"] is True
    assert g["composite_quality_score"] == 100


def test_missing_certificate_is_material(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1", batch="NOPE")],
        cmm=[cmm_row("P1")],
        torque=[torque_row("P1")],
        certs=[cert_row("B1")],
    )["P1"]
    assert g["defect_root_cause"] == "material"
    assert g["material_failure_reason"] == "missing_cert"
    assert g["supplier_id"] is None
    assert g["composite_quality_score"] == 75


def test_material_reasons_and_inclusive_limits(spark):
    batches = {
        "H180": (180.0, 670.0, "in_spec"),
        "H230": (230.0, 670.0, "in_spec"),
        "HLOW": (179.9, 670.0, "hardness_low"),
        "HHIGH": (230.1, 670.0, "hardness_high"),
        "TLOW": (205.0, 579.0, "tensile_low"),
        "THIGH": (205.0, 761.0, "tensile_high"),
        "HNULL": (None, 670.0, "in_spec"),
        "HNAN": (float("nan"), 670.0, "hardness_high"),
    }
    layers = layers_of(
        spark,
        process=[process_row(b, batch=b) for b in batches],
        cmm=[cmm_row(b) for b in batches],
        torque=[torque_row(b) for b in batches],
        certs=[cert_row(b, h, t) for b, (h, t, _) in batches.items()],
    )
    got = {r["part_id"]: r["material_failure_reason"] for r in layers.material_quality.collect()}
    assert got == {b: reason for b, (_, _, reason) in batches.items()}


def test_zero_tolerance_gives_null_utilization(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1", "a", measured=50.01, tol=0.0), cmm_row("P1", "b", measured=50.02, tol=0.0)],
        torque=[torque_row("P1")],
        certs=[cert_row()],
    )["P1"]
    assert g["max_dimension_tolerance_utilization"] is None


def test_utilization_and_torque_error_rounding(spark):
    g = gold_by_part(
        spark,
        process=[process_row("P1")],
        cmm=[cmm_row("P1", "a", measured=50.02, tol=0.03)],
        torque=[torque_row("P1", actual=66.3)],
        certs=[cert_row()],
    )["P1"]
    assert g["max_dimension_tolerance_utilization"] == 0.667
    assert g["max_torque_error_pct"] == 0.02


def test_pass_fail_is_upper_cased_not_trimmed(spark):
    parts = gold_by_part(
        spark,
        process=[process_row("L"), process_row("N"), process_row("S")],
        cmm=[cmm_row("L", verdict="fail"), cmm_row("N", verdict=None), cmm_row("S", verdict=" FAIL")],
        torque=[torque_row(p) for p in "LNS"],
        certs=[cert_row()],
    )
    assert parts["L"]["failed_dimension_count"] == 1
    assert parts["N"]["failed_dimension_count"] == 0 and parts["N"]["any_dimension_out_of_tolerance"] is False
    assert parts["S"]["failed_dimension_count"] == 0


def test_null_keys_are_dropped(spark):
    layers = layers_of(
        spark,
        process=[process_row("P1"), process_row(None), process_row("P2", batch=None)],
        cmm=[cmm_row("P1"), cmm_row(None), cmm_row("P1", dim=None)],
        torque=[torque_row("P1"), torque_row(None), torque_row("P1", joint=None)],
        certs=[cert_row()],
    )
    assert [r["part_id"] for r in layers.gold.collect()] == ["P1"]
    cmm = layers.cmm_quality.collect()
    assert len(cmm) == 1 and cmm[0]["inspected_dimension_count"] == 1
    assert layers.torque_quality.collect()[0]["audited_joint_count"] == 1


def test_flags_match_gold(spark):
    layers = layers_of(
        spark,
        process=[process_row("P1"), process_row("P2", batch="X")],
        cmm=[cmm_row("P1", verdict="FAIL"), cmm_row("P2")],
        torque=[torque_row("P1")],
        certs=[cert_row()],
    )
    flags = {r["part_id"]: (r["defect_flag"], r["defect_root_cause"]) for r in layers.flags.collect()}
    assert flags == {"P1": (True, "dimension"), "P2": (True, "material")}
