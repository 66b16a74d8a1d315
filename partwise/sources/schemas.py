"""Typed schemas of the four daily source extracts.

Each entry lists (column, Spark type) in the order Bronze presents them. The
order and types define the Bronze relations; a file may hold more, fewer or
differently typed columns and is projected onto these.
"""

from __future__ import annotations

SOURCE_SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "process_parameters": [
        ("process_ts", "timestamp_ntz"),
        ("production_date", "date"),
        ("part_id", "string"),
        ("part_model", "string"),
        ("line_id", "string"),
        ("shift", "string"),
        ("machine_id", "string"),
        ("batch_id", "string"),
        ("spindle_speed", "double"),
        ("feed_rate", "double"),
        ("coolant_temp", "double"),
        ("cycle_time", "double"),
    ],
    "cmm_inspection": [
        ("inspection_ts", "timestamp_ntz"),
        ("production_date", "date"),
        ("part_id", "string"),
        ("dimension_name", "string"),
        ("measured_value", "double"),
        ("nominal", "double"),
        ("tolerance", "double"),
        ("lower_spec_limit", "double"),
        ("upper_spec_limit", "double"),
        ("pass_fail", "string"),
    ],
    "torque_audit": [
        ("audit_ts", "timestamp_ntz"),
        ("production_date", "date"),
        ("part_id", "string"),
        ("joint_id", "string"),
        ("target_torque", "double"),
        ("actual_torque", "double"),
        ("angle", "double"),
        ("torque_lower_limit", "double"),
        ("torque_upper_limit", "double"),
        ("angle_lower_limit", "double"),
        ("angle_upper_limit", "double"),
        ("pass_fail", "string"),
    ],
    "supplier_material_certs": [
        ("batch_id", "string"),
        ("supplier_id", "string"),
        ("hardness", "double"),
        ("tensile_strength", "double"),
        ("cert_date", "date"),
        ("hardness_min_spec", "double"),
        ("hardness_max_spec", "double"),
        ("tensile_min_spec", "double"),
        ("tensile_max_spec", "double"),
        ("material_deviation", "boolean"),
    ],
}

SOURCES = tuple(SOURCE_SCHEMAS)

# Columns whose text is upper-cased by the typed projection.
UPPERCASED = {"cmm_inspection": ("pass_fail",), "torque_audit": ("pass_fail",)}

# Bronze relation names as the model layer calls them.
BRONZE_MODEL = {
    "process_parameters": "bronze_process_parameters",
    "cmm_inspection": "bronze_cmm_inspection",
    "torque_audit": "bronze_torque_audit",
    "supplier_material_certs": "bronze_supplier_material_certs",
}


def ddl(source: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in SOURCE_SCHEMAS[source])
