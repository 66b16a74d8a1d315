"""Column expressions of the quality model.

All are built-in Spark expressions, so they compile into whole-stage codegen;
none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partwise.functions import rules as R


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_to(numerator: Column, denominator: str | Column) -> Column:
    """``numerator / nullif(denominator, 0)``: NULL instead of a division error."""
    d = col(denominator)
    return numerator / F.nullif(d, F.lit(0.0))


def tolerance_utilization(measured="measured_value", nominal="nominal", tolerance="tolerance") -> Column:
    """Share of the tolerance band used: |measured - nominal| / tolerance."""
    return ratio_to(F.abs(col(measured) - col(nominal)), tolerance)


def torque_error_ratio(actual="actual_torque", target="target_torque") -> Column:
    """|actual - target| / target, a fraction (the model calls it ``_pct``)."""
    return ratio_to(F.abs(col(actual) - col(target)), target)


def sorted_distinct_join(value: Column, sep: str = R.LIST_SEPARATOR) -> Column:
    """Aggregate: distinct non-NULL values sorted by bytes and joined; NULL if none.

    ``collect_set`` merges partially on the map side, and the set of one group
    is bounded by the distinct values of that group (dimension or joint names
    of one part), not by its row count.
    """
    values = F.collect_set(value)
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), sep))


def outside(value: Column, low: Column, high: Column) -> Column:
    """value < low or value > high, with SQL NULL semantics (NULL if unknown)."""
    return (value < low) | (value > high)


def material_reason(has_cert: Column) -> Column:
    """First failing material rule; a NULL comparison falls to the next rule."""
    h, t = F.col("hardness"), F.col("tensile_strength")
    return (
        F.when(~has_cert, F.lit(R.MISSING_CERT))
        .when(h < F.col("hardness_min_spec"), F.lit(R.HARDNESS_LOW))
        .when(h > F.col("hardness_max_spec"), F.lit(R.HARDNESS_HIGH))
        .when(t < F.col("tensile_min_spec"), F.lit(R.TENSILE_LOW))
        .when(t > F.col("tensile_max_spec"), F.lit(R.TENSILE_HIGH))
        .otherwise(F.lit(R.IN_SPEC))
    )


def material_deviation(has_cert: Column) -> Column:
    h, t = F.col("hardness"), F.col("tensile_strength")
    return (
        F.when(~has_cert, F.lit(True))
        .when(outside(h, F.col("hardness_min_spec"), F.col("hardness_max_spec")), F.lit(True))
        .when(outside(t, F.col("tensile_min_spec"), F.col("tensile_max_spec")), F.lit(True))
        .otherwise(F.lit(False))
    )


def root_cause(any_dim: Column, any_torque: Column, any_material: Column, missing: Column) -> Column:
    return (
        F.when(any_dim, F.lit(R.CAUSE_DIMENSION))
        .when(any_torque, F.lit(R.CAUSE_TORQUE))
        .when(any_material, F.lit(R.CAUSE_MATERIAL))
        .when(missing, F.lit(R.CAUSE_UNKNOWN))
        .otherwise(F.lit(R.CAUSE_NONE))
    )


def risk_flag(value: str, above: float) -> Column:
    """1 when value > threshold, else 0 (NULL counts as no risk)."""
    return F.when(F.col(value) > F.lit(above), F.lit(1)).otherwise(F.lit(0))


def composite_score(
    failed_dims="failed_dimension_count",
    failed_joints="failed_joint_count",
    material="any_material_deviation",
    coolant_risk="coolant_process_risk",
    feed_risk="feed_process_risk",
) -> Column:
    raw = (
        F.lit(R.SCORE_START)
        - col(failed_dims) * R.PENALTY_PER_FAILED_DIMENSION
        - col(failed_joints) * R.PENALTY_PER_FAILED_JOINT
        - F.when(col(material), F.lit(R.PENALTY_MATERIAL_DEVIATION)).otherwise(F.lit(0))
        - col(coolant_risk) * R.PENALTY_COOLANT_RISK
        - col(feed_risk) * R.PENALTY_FEED_RISK
    )
    return F.least(F.lit(R.SCORE_MAX), F.greatest(F.lit(R.SCORE_MIN), raw)).cast("int")
