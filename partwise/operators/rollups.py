"""Silver rollups: the part population and per-part CMM and torque outcomes.

Each rollup is a ``groupBy(part_id)`` that Spark aggregates partially on the
map side, so the shuffle carries at most one row per part and map task,
however many rows one part has. The output stays hash-partitioned by
``part_id``, which the part-grain joins in :mod:`partwise.operators.mart`
reuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions import quality as Q
from partwise.functions import rules as R

POPULATION_COLUMNS = [
    "part_id",
    "production_date",
    "process_ts",
    "part_model",
    "line_id",
    "shift",
    "machine_id",
    "batch_id",
    "spindle_speed",
    "feed_rate",
    "coolant_temp",
    "cycle_time",
]


def part_population(process: DataFrame) -> DataFrame:
    """Parts with a key and a material batch, from the typed process log."""
    return process.filter(F.col("part_id").isNotNull() & F.col("batch_id").isNotNull()).select(
        *POPULATION_COLUMNS
    )


def _verdict_rollup(
    rows: DataFrame,
    item: str,
    ratio: Column,
    digits: int,
    count_name: str,
    failed_name: str,
    any_name: str,
    max_name: str,
    list_name: str,
) -> DataFrame:
    failed = F.col("pass_fail") == F.lit(R.FAIL)
    keyed = rows.filter(F.col("part_id").isNotNull() & F.col(item).isNotNull())
    # One pass: failing names are collected beside the counts. Sets stay empty
    # for parts without a failure and hold one part's names otherwise.
    return (
        keyed.groupBy("part_id")
        .agg(
            F.min("production_date").alias("production_date"),
            F.count(F.lit(1)).alias(count_name),
            F.count_if(failed).alias(failed_name),
            F.round(F.max(ratio), digits).alias(max_name),
            Q.sorted_distinct_join(F.when(failed, F.col(item))).alias(list_name),
        )
        .select("part_id", "production_date", count_name, failed_name, (F.col(failed_name) > 0).alias(any_name), max_name, list_name)
    )


def cmm_rollup(cmm: DataFrame) -> DataFrame:
    """Per part: dimensions inspected and failed, worst tolerance use, failing names."""
    return _verdict_rollup(
        cmm,
        item="dimension_name",
        ratio=Q.tolerance_utilization(),
        digits=R.UTILIZATION_DIGITS,
        count_name="inspected_dimension_count",
        failed_name="failed_dimension_count",
        any_name="any_dimension_out_of_tolerance",
        max_name="max_dimension_tolerance_utilization",
        list_name="failing_dimension_names",
    )


def torque_rollup(torque: DataFrame) -> DataFrame:
    """Per part: joints audited and failed, worst torque error, failing joint ids."""
    return _verdict_rollup(
        torque,
        item="joint_id",
        ratio=Q.torque_error_ratio(),
        digits=R.TORQUE_ERROR_DIGITS,
        count_name="audited_joint_count",
        failed_name="failed_joint_count",
        any_name="any_torque_failure",
        max_name="max_torque_error_pct",
        list_name="failing_joint_ids",
    )
