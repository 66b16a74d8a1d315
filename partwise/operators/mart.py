"""Part-grain flags and the Gold part quality summary.

One join pass builds both: the population is joined left with the CMM and
torque rollups on ``part_id``, then with its batch's certificate. The rollups
come out of their aggregation already hash-partitioned by ``part_id`` (or are
read from tables bucketed by it), so the sort-merge joins need at most one
shuffle of the population and none of the rollups. Flags and Gold are
projections of the same joined frame; no second join to a flags relation is
needed.

Keys are expected unique (one process row per part, one certificate per
batch); :func:`partwise.operators.checks.assert_unique_keys` is the gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.functions import quality as Q
from partwise.functions import rules as R
from partwise.operators.material import with_material
from partwise.operators.rollups import POPULATION_COLUMNS

FLAG_COLUMNS = [
    "part_id",
    "production_date",
    "any_dimension_out_of_tolerance",
    "any_torque_failure",
    "any_material_deviation",
    "defect_flag",
    "defect_root_cause",
]

GOLD_COLUMNS = [
    "part_id",
    "production_date",
    "process_ts",
    "part_model",
    "line_id",
    "shift",
    "machine_id",
    "batch_id",
    "supplier_id",
    "spindle_speed",
    "feed_rate",
    "coolant_temp",
    "cycle_time",
    "inspected_dimension_count",
    "failed_dimension_count",
    "any_dimension_out_of_tolerance",
    "max_dimension_tolerance_utilization",
    "failing_dimension_names",
    "audited_joint_count",
    "failed_joint_count",
    "any_torque_failure",
    "max_torque_error_pct",
    "failing_joint_ids",
    "hardness",
    "tensile_strength",
    "cert_date",
    "any_material_deviation",
    "material_failure_reason",
    "defect_flag",
    "defect_root_cause",
    "composite_quality_score",
]


def scored_parts(
    population: DataFrame,
    cmm_roll: DataFrame,
    torque_roll: DataFrame,
    certs: DataFrame,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Every part with its rollups, certificate, flags, cause and score.

    The part-grain joins on ``part_id`` come first, the certificate lookup on
    ``batch_id`` last: all inputs of the first joins are partitioned (or
    bucketed) by ``part_id``, and a lookup between them would move the
    population to ``batch_id`` and back.
    """
    cmm = cmm_roll.drop("production_date").withColumn("_has_cmm", F.lit(True))
    torque = torque_roll.drop("production_date").withColumn("_has_torque", F.lit(True))
    by_part = population.join(cmm, "part_id", "left").join(torque, "part_id", "left")
    joined = with_material(by_part, certs, broadcast_limit)

    any_dim = F.coalesce(F.col("any_dimension_out_of_tolerance"), F.lit(False))
    any_torque = F.coalesce(F.col("any_torque_failure"), F.lit(False))
    any_mat = F.coalesce(F.col("any_material_deviation"), F.lit(False))
    # A part without CMM rows or without torque rows cannot be cleared.
    missing = F.col("_has_cmm").isNull() | F.col("_has_torque").isNull()

    filled = joined.select(
        *[F.col(c) for c in POPULATION_COLUMNS],
        F.col("supplier_id"),
        F.coalesce(F.col("inspected_dimension_count"), F.lit(0).cast("long")).alias("inspected_dimension_count"),
        F.coalesce(F.col("failed_dimension_count"), F.lit(0).cast("long")).alias("failed_dimension_count"),
        any_dim.alias("any_dimension_out_of_tolerance"),
        F.col("max_dimension_tolerance_utilization"),
        F.coalesce(F.col("failing_dimension_names"), F.lit("")).alias("failing_dimension_names"),
        F.coalesce(F.col("audited_joint_count"), F.lit(0).cast("long")).alias("audited_joint_count"),
        F.coalesce(F.col("failed_joint_count"), F.lit(0).cast("long")).alias("failed_joint_count"),
        any_torque.alias("any_torque_failure"),
        F.col("max_torque_error_pct"),
        F.coalesce(F.col("failing_joint_ids"), F.lit("")).alias("failing_joint_ids"),
        F.col("hardness"),
        F.col("tensile_strength"),
        F.col("cert_date"),
        any_mat.alias("any_material_deviation"),
        F.coalesce(F.col("material_failure_reason"), F.lit(R.UNKNOWN_REASON)).alias("material_failure_reason"),
        (missing | any_dim | any_torque | any_mat).alias("defect_flag"),
        Q.root_cause(any_dim, any_torque, any_mat, missing).alias("defect_root_cause"),
        Q.risk_flag("coolant_temp", R.COOLANT_RISK_ABOVE).alias("coolant_process_risk"),
        Q.risk_flag("feed_rate", R.FEED_RISK_ABOVE).alias("feed_process_risk"),
    )
    return filled.withColumn("composite_quality_score", Q.composite_score())


def quality_flags(scored: DataFrame) -> DataFrame:
    return scored.select(*FLAG_COLUMNS)


def part_quality_summary(scored: DataFrame) -> DataFrame:
    return scored.select(*GOLD_COLUMNS)
