from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from partwise.session import build_session  # noqa: E402
from partwise.sources.schemas import SOURCE_SCHEMAS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        shuffle_partitions=4,
        app_name="partwise-tests",
        extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="partwise-test-warehouse-")},
    )
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="partwise-test-")


# Raw extract columns as the files hold them (dates as text).
RAW_DDL = {
    "process_parameters": "process_ts timestamp_ntz, production_date string, part_id string, part_model string, "
    "line_id string, shift string, machine_id string, batch_id string, spindle_speed double, "
    "feed_rate double, coolant_temp double, cycle_time double",
    "cmm_inspection": "inspection_ts timestamp_ntz, production_date string, part_id string, dimension_name string, "
    "measured_value double, nominal double, tolerance double, lower_spec_limit double, "
    "upper_spec_limit double, pass_fail string",
    "torque_audit": "audit_ts timestamp_ntz, production_date string, part_id string, joint_id string, "
    "target_torque double, actual_torque double, angle double, torque_lower_limit double, "
    "torque_upper_limit double, angle_lower_limit double, angle_upper_limit double, pass_fail string",
    "supplier_material_certs": "batch_id string, supplier_id string, hardness double, tensile_strength double, "
    "cert_date string, hardness_min_spec double, hardness_max_spec double, tensile_min_spec double, "
    "tensile_max_spec double, material_deviation boolean",
}
assert set(RAW_DDL) == set(SOURCE_SCHEMAS)


def process_row(part, batch="B1", coolant=27.0, feed=600.0, machine="CNC-01", day="2026-06-11"):
    import datetime as dt

    return (dt.datetime(2026, 6, 11, 6, 0), day, part, "M", "LINE-A", "A", machine, batch, 10500.0, feed, coolant, 90.0)


def cmm_row(part, dim="bore", measured=50.0, tol=0.03, verdict="PASS", nominal=50.0):
    import datetime as dt

    return (
        dt.datetime(2026, 6, 11, 7, 0), "2026-06-11", part, dim, measured, nominal, tol,
        None if tol is None else nominal - tol, None if tol is None else nominal + tol, verdict,
    )


def torque_row(part, joint="J1", actual=65.0, verdict="PASS", angle=70.0):
    import datetime as dt

    return (dt.datetime(2026, 6, 11, 9, 0), "2026-06-11", part, joint, 65.0, actual, angle, 61.75, 68.25, 62.0, 78.0, verdict)


def cert_row(batch="B1", hardness=205.0, tensile=670.0):
    return (batch, "SUP-101", hardness, tensile, "2026-06-01", 180.0, 230.0, 580.0, 760.0, False)


def frames(spark, process=(), cmm=(), torque=(), certs=()):
    data = {
        "process_parameters": process,
        "cmm_inspection": cmm,
        "torque_audit": torque,
        "supplier_material_certs": certs,
    }
    return {name: spark.createDataFrame(list(rows), RAW_DDL[name]) for name, rows in data.items()}


def layers_of(spark, **kwargs):
    from partwise.plans.layers import build_layers, typed_sources

    return build_layers(typed_sources(frames(spark, **kwargs)))


def gold_by_part(spark, **kwargs):
    return {r["part_id"]: r for r in layers_of(spark, **kwargs).gold.collect()}
