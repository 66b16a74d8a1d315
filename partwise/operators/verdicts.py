"""Verdict audit: recompute each source's pass/fail rule and compare.

The source systems store limits and a verdict per row. These operators
recompute both from the stored measurements:

* CMM: limits are nominal +/- tolerance; PASS iff lower <= measured <= upper.
* Torque: limits are 0.95 and 1.05 times the target torque; PASS iff the
  torque and the angle are inside their stored limits (the target angle is not
  stored, so the stored angle limits are used).
* Material: deviation iff hardness or tensile strength is outside its spec.

A NULL measurement makes the recomputed verdict FAIL (no comparison holds),
a NULL spec makes the material deviation false, as in the source rule. The
sources judge unrounded values and store rounded ones, so rows on a limit may
legitimately differ. All operators are row-wise projections: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions import rules as R

# Absolute slack when comparing stored limits with recomputed ones.
LIMIT_EPSILON = 1e-6


def _verdict(ok: Column) -> Column:
    return F.when(ok, F.lit(R.PASS)).otherwise(F.lit(R.FAIL))


def _close(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a - b) <= F.lit(LIMIT_EPSILON), F.lit(False))


def cmm_verdicts(cmm: DataFrame) -> DataFrame:
    m, lo, hi = F.col("measured_value"), F.col("lower_spec_limit"), F.col("upper_spec_limit")
    exp_lo = F.col("nominal") - F.col("tolerance")
    exp_hi = F.col("nominal") + F.col("tolerance")
    recomputed = _verdict(m.between(lo, hi))
    return cmm.select(
        "part_id",
        "dimension_name",
        "measured_value",
        "lower_spec_limit",
        "upper_spec_limit",
        exp_lo.alias("expected_lower_limit"),
        exp_hi.alias("expected_upper_limit"),
        (_close(lo, exp_lo) & _close(hi, exp_hi)).alias("limits_consistent"),
        F.col("pass_fail").alias("declared_pass_fail"),
        recomputed.alias("recomputed_pass_fail"),
        F.col("pass_fail").eqNullSafe(recomputed).alias("verdict_consistent"),
    )


def torque_verdicts(torque: DataFrame) -> DataFrame:
    t, a = F.col("actual_torque"), F.col("angle")
    lo, hi = F.col("torque_lower_limit"), F.col("torque_upper_limit")
    exp_lo = F.col("target_torque") * F.lit(R.TORQUE_LOWER_FACTOR)
    exp_hi = F.col("target_torque") * F.lit(R.TORQUE_UPPER_FACTOR)
    angle_width_ok = _close(F.col("angle_upper_limit") - F.col("angle_lower_limit"), F.lit(2 * R.ANGLE_HALF_WIDTH))
    recomputed = _verdict(t.between(lo, hi) & a.between(F.col("angle_lower_limit"), F.col("angle_upper_limit")))
    return torque.select(
        "part_id",
        "joint_id",
        "actual_torque",
        "angle",
        "torque_lower_limit",
        "torque_upper_limit",
        exp_lo.alias("expected_torque_lower_limit"),
        exp_hi.alias("expected_torque_upper_limit"),
        (_close(lo, exp_lo) & _close(hi, exp_hi) & angle_width_ok).alias("limits_consistent"),
        F.col("pass_fail").alias("declared_pass_fail"),
        recomputed.alias("recomputed_pass_fail"),
        F.col("pass_fail").eqNullSafe(recomputed).alias("verdict_consistent"),
    )


def material_verdicts(certs: DataFrame) -> DataFrame:
    h, s = F.col("hardness"), F.col("tensile_strength")
    out_h = (h < F.col("hardness_min_spec")) | (h > F.col("hardness_max_spec"))
    out_s = (s < F.col("tensile_min_spec")) | (s > F.col("tensile_max_spec"))
    recomputed = F.coalesce(out_h, F.lit(False)) | F.coalesce(out_s, F.lit(False))
    return certs.select(
        "batch_id",
        "supplier_id",
        "hardness",
        "tensile_strength",
        F.col("material_deviation").alias("declared_deviation"),
        recomputed.alias("recomputed_deviation"),
        F.col("material_deviation").eqNullSafe(recomputed).alias("verdict_consistent"),
    )


def verdict_audit(cmm: DataFrame, torque: DataFrame, certs: DataFrame) -> DataFrame:
    """Rows whose stored verdict differs from the recomputed one, all sources:
    (source, record_id, item_id, declared_verdict, recomputed_verdict)."""

    def as_verdict(flag: Column) -> Column:
        return F.when(flag, F.lit(R.FAIL)).when(~flag, F.lit(R.PASS))

    c = cmm_verdicts(cmm).filter(~F.col("verdict_consistent")).select(
        F.lit("cmm_inspection").alias("source"),
        F.col("part_id").alias("record_id"),
        F.col("dimension_name").alias("item_id"),
        F.col("declared_pass_fail").alias("declared_verdict"),
        F.col("recomputed_pass_fail").alias("recomputed_verdict"),
    )
    t = torque_verdicts(torque).filter(~F.col("verdict_consistent")).select(
        F.lit("torque_audit").alias("source"),
        F.col("part_id").alias("record_id"),
        F.col("joint_id").alias("item_id"),
        F.col("declared_pass_fail").alias("declared_verdict"),
        F.col("recomputed_pass_fail").alias("recomputed_verdict"),
    )
    m = material_verdicts(certs).filter(~F.col("verdict_consistent")).select(
        F.lit("supplier_material_certs").alias("source"),
        F.col("batch_id").alias("record_id"),
        F.lit(None).cast("string").alias("item_id"),
        as_verdict(F.col("declared_deviation")).alias("declared_verdict"),
        as_verdict(F.col("recomputed_deviation")).alias("recomputed_verdict"),
    )
    return c.unionByName(t).unionByName(m)
