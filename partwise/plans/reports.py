"""Reports over the Gold summary: filters, headline, trend, dimensions,
correlation and the trace of one part.

All reports are aggregations that Spark computes partially on the executors;
only their small results reach the driver when the caller collects them.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.functions import rules as R
from partwise.operators.moments import correlations


# ---------------------------------------------------------------- filters
def filter_summary(
    gold: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    machine: str | None = None,
    root_cause: str | None = None,
) -> DataFrame:
    """Gold rows in [start, end] (both ends, only when both are given), on one
    machine and with one root cause; ``None`` means all."""
    out = gold
    if start is not None and end is not None:
        out = out.filter(F.col("production_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if machine is not None:
        out = out.filter(F.col("machine_id") == F.lit(machine))
    if root_cause is not None:
        out = out.filter(F.col("defect_root_cause") == F.lit(root_cause))
    return out


def summary_ordered(gold: DataFrame) -> DataFrame:
    """Gold in presentation order: production_date, part_id, NULLs last.

    Sort only what is presented; the range-partitioned sort is a full shuffle.
    """
    return gold.orderBy(F.asc_nulls_last("production_date"), F.asc_nulls_last("part_id"))


def date_bounds(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.min("production_date").alias("min_production_date"),
        F.max("production_date").alias("max_production_date"),
    )


def filter_options(gold: DataFrame) -> DataFrame:
    """Distinct non-NULL machines and root causes, as (filter_name, option_value)."""

    both = ", ".join(f"named_struct('filter_name', '{c}', 'option_value', cast(`{c}` as string))" for c in ("machine_id", "defect_root_cause"))
    return gold.selectExpr(f"inline(array({both}))").filter("option_value is not null").distinct().orderBy("filter_name", "option_value")


# ---------------------------------------------------------------- metrics
def headline_metrics(gold: DataFrame) -> DataFrame:
    """Parts, defective parts, defect rate (0 if none) and mean score (0 if none)."""
    total = F.count(F.lit(1))
    defects = F.count_if(F.col("defect_flag"))
    return gold.agg(
        total.alias("total_parts"),
        defects.alias("defect_parts"),
        F.when(total > 0, defects / total).otherwise(F.lit(0.0)).alias("defect_rate"),
        F.coalesce(F.avg("composite_quality_score"), F.lit(0.0)).alias("avg_quality_score"),
    )


def daily_defect_trend(gold: DataFrame) -> DataFrame:
    """Per production day: defect rate, parts and the rate in percent."""
    return (
        gold.filter(F.col("production_date").isNotNull())
        .groupBy("production_date")
        .agg(
            F.avg(F.col("defect_flag").cast("int")).alias("defect_rate"),
            F.count("part_id").alias("parts"),
        )
        .withColumn("defect_rate_pct", F.col("defect_rate") * F.lit(100.0))
        .orderBy("production_date")
    )


def failing_dimensions(gold: DataFrame) -> DataFrame:
    """Parts failing each dimension, most frequent first (ties by name)."""
    names = F.coalesce(F.col("failing_dimension_names"), F.lit(""))
    return (
        gold.filter(names != F.lit(""))
        .select("part_id", F.explode(F.split(names, re.escape(R.LIST_SEPARATOR))).alias("dimension_name"))
        .groupBy("dimension_name")
        .agg(F.count_distinct("part_id").alias("failing_parts"))
        .orderBy(F.desc("failing_parts"), "dimension_name")
    )


# ---------------------------------------------------------------- correlation
def correlation_pairs(columns=R.CORRELATION_COLUMNS) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i:]]


def signed_round(expr: str, digits: int) -> str:
    """``round`` that keeps the sign of a negative value rounding to zero.

    Spark's ``round`` turns -0.0004 into 0.0; the report's engine and pandas
    give -0.0, which is what the matrix shows.
    """
    return f"case when round({expr}, {digits}) = 0 and {expr} < 0 then -0.0D else round({expr}, {digits}) end"


def correlation_matrix(gold: DataFrame, columns=R.CORRELATION_COLUMNS, digits=R.CORRELATION_DIGITS) -> DataFrame:
    """Long-form Pearson matrix (row_variable, column_variable, correlation).

    One pass over Gold, which hands on one matrix of moments a task
    (:mod:`partwise.operators.moments`). Rows count where both values are present
    (NULL and NaN are missing); the result is NULL where a side is constant or no
    row counts.
    """
    types = dict(gold.dtypes)

    def as_double(c: str) -> str:
        inner = f"cast(`{c}` as int)" if types.get(c) == "boolean" else f"`{c}`"
        return f"cast({inner} as double) as `{c}`"

    r = correlations(gold.selectExpr(*[as_double(c) for c in columns]))
    # All pairs, also those without a row: a table of len(columns) ** 2 rows.
    names = gold.sparkSession.createDataFrame([(x, y, a, b) for a, b in correlation_pairs(columns) for x, y in sorted({(a, b), (b, a)})], "row_variable string, column_variable string, a string, b string")
    return names.join(r, ["a", "b"], "left").selectExpr("row_variable", "column_variable", f"{signed_round('r', digits)} as correlation")


# ---------------------------------------------------------------- part trace
def default_trace_part(gold: DataFrame) -> DataFrame:
    """One row: the smallest defective part_id, else the smallest part_id."""
    return gold.agg(
        F.coalesce(F.min(F.when(F.col("defect_flag"), F.col("part_id"))), F.min("part_id")).alias("part_id")
    ).filter(F.col("part_id").isNotNull())


def part_options(gold: DataFrame) -> DataFrame:
    """Parts that a trace can be asked for, in order."""
    return gold.select("part_id").orderBy(F.asc_nulls_last("part_id"))


def part_trace(
    gold: DataFrame,
    bronze: dict[str, DataFrame],
    part_id: str | None = None,
) -> dict[str, DataFrame]:
    """Gold row of one part plus its CMM, torque and process rows and the
    certificate of its batch.

    Without ``part_id`` the default part (smallest defective, else smallest)
    is found by one aggregate over Gold and only that key is fetched. Every
    lookup is then a literal predicate that reaches the Parquet scans, where
    key-sorted files let it skip row groups; a join against a one-row frame
    would scan every file.
    """
    if part_id is None:
        row = default_trace_part(gold).first()
        part_id = row["part_id"] if row else None
    key = F.col("part_id") == F.lit(part_id)
    summary = gold.filter(key)
    # Gold has one row per part; its batch key is fetched for a literal lookup.
    row = summary.select("batch_id").first()
    cert = bronze["supplier_material_certs"].filter(F.col("batch_id") == F.lit(row["batch_id"] if row else None))
    return {
        "summary": summary,
        "cmm": bronze["cmm_inspection"].filter(key).orderBy(F.asc_nulls_last("dimension_name")),
        "torque": bronze["torque_audit"].filter(key).orderBy(F.asc_nulls_last("joint_id")),
        "process": bronze["process_parameters"].filter(key),
        "cert": cert,
    }


def summary_fields(summary_row: DataFrame) -> DataFrame:
    """The Gold row(s) as (part_id, field, value) text pairs, in column order."""
    fields = [c for c in summary_row.columns if c != "part_id"]
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
            for i, c in enumerate(fields)
        ]
    )
    return summary_row.select("part_id", F.explode(pairs).alias("p")).select("part_id", "p.position", "p.field", "p.value")
