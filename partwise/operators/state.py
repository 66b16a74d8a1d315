"""Mergeable state of the measurement rollups.

The rollup of a part is made of a least day, counts, a largest ratio and a set of
failing names, and each of these can be put together from parts. So the rows of one
load give one small state row a part, and the states of all loads give the rollup:
a day's job aggregates that day's rows only, and a load that is replaced takes its
state with it. (Changing a merged rollup in place could not take rows back.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions import quality as Q
from partwise.functions import rules as R

STATE_SCHEMA = "part_id string, first_day date, seen bigint, bad bigint, worst double, bad_items array<string>"


@dataclass(frozen=True)
class Measure:
    """What a rollup counts: rows by ``item``, ``ratio`` to ``digits``; ``names`` are the rollup's columns."""

    model: str
    item: str
    ratio: Column
    digits: int
    names: tuple[str, str, str, str, str]


def measures() -> dict[str, Measure]:
    """Per source of measurements its rollup."""
    return {
        "cmm_inspection": Measure(
            "silver_cmm_quality", "dimension_name", Q.tolerance_utilization(), R.UTILIZATION_DIGITS,
            ("inspected_dimension_count", "failed_dimension_count", "any_dimension_out_of_tolerance",
             "max_dimension_tolerance_utilization", "failing_dimension_names"),
        ),
        "torque_audit": Measure(
            "silver_torque_quality", "joint_id", Q.torque_error_ratio(), R.TORQUE_ERROR_DIGITS,
            ("audited_joint_count", "failed_joint_count", "any_torque_failure", "max_torque_error_pct", "failing_joint_ids"),
        ),
    }


def partial(rows: DataFrame, measure: Measure) -> DataFrame:
    """The state of typed measurement rows: one row a part, ratios not rounded yet."""
    failed = F.col("pass_fail") == F.lit(R.FAIL)
    keyed = rows.filter(F.col("part_id").isNotNull() & F.col(measure.item).isNotNull())
    return keyed.groupBy("part_id").agg(
        F.min("production_date").alias("first_day"),
        F.count(F.lit(1)).alias("seen"),
        F.count_if(failed).alias("bad"),
        F.max(measure.ratio).alias("worst"),
        F.collect_set(F.when(failed, F.col(measure.item))).alias("bad_items"),
    )


def merged(state: DataFrame, measure: Measure) -> DataFrame:
    """The rollup that the rows behind ``state`` (of any number of loads) have."""
    seen, failed, any_failed, worst, listed = measure.names
    # Few distinct sets a part: a part's items are bounded, and most sets are empty.
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("bad_items"))))
    return (
        state.groupBy("part_id")
        .agg(
            F.min("first_day").alias("production_date"),
            F.sum("seen").alias(seen),
            F.sum("bad").alias(failed),
            F.round(F.max("worst"), measure.digits).alias(worst),
            items.alias("items"),
        )
        .select(
            "part_id", "production_date", seen, failed, (F.col(failed) > 0).alias(any_failed), worst,
            F.when(F.size("items") > 0, F.array_join("items", R.LIST_SEPARATOR)).alias(listed),
        )
    )
