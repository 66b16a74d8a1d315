"""Report queries (registered on import), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partwise.functions import rules as R
from partwise.plans import reports
from partwise.plans.catalog import register
from partwise.plans.layers import from_testdata
from partwise.plans.oracle import with_models

GOLD = "mart_part_quality_summary"

# Dashboard filter used by the registered filtered-summary query: two full
# years, one machine, every root cause.
FILTER_START, FILTER_END, FILTER_MACHINE = "1995-01-01", "1996-12-31", "CNC-03"


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_testdata(spark, sf_dir).gold


@register(
    "filtered_summary",
    with_models(
        f"select * from {GOLD} where production_date between date '{FILTER_START}' "
        f"and date '{FILTER_END}' and machine_id = '{FILTER_MACHINE}'"
    ),
)
def filtered_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_summary(_gold(spark, sf_dir), FILTER_START, FILTER_END, FILTER_MACHINE)


@register("gold_ordered", with_models(f"select * from {GOLD} order by production_date, part_id"))
def gold_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.summary_ordered(_gold(spark, sf_dir))


@register(
    "filtered_defects_by_cause",
    with_models(
        f"select * from {GOLD} where defect_root_cause = '{R.CAUSE_DIMENSION}' and defect_flag"
    ),
)
def filtered_defects_by_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = reports.filter_summary(_gold(spark, sf_dir), root_cause=R.CAUSE_DIMENSION)
    return gold.filter("defect_flag")


@register(
    "date_bounds",
    with_models(
        f"select min(production_date) as min_production_date, "
        f"max(production_date) as max_production_date from {GOLD}"
    ),
)
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.date_bounds(_gold(spark, sf_dir))


@register(
    "filter_options",
    with_models(
        f"""select * from (
    select distinct 'machine_id' as filter_name, machine_id as option_value from {GOLD}
    where machine_id is not null
    union all
    select distinct 'defect_root_cause', defect_root_cause from {GOLD}
    where defect_root_cause is not null)
order by filter_name, option_value"""
    ),
)
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_options(_gold(spark, sf_dir))


@register(
    "headline_metrics",
    with_models(
        f"""select
    count(*) as total_parts,
    count(*) filter (where defect_flag) as defect_parts,
    case when count(*) > 0 then (count(*) filter (where defect_flag)) / count(*) else 0e0 end as defect_rate,
    coalesce(avg(composite_quality_score), 0e0) as avg_quality_score
from {GOLD}"""
    ),
)
def headline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.headline_metrics(_gold(spark, sf_dir))


@register(
    "daily_defect_trend",
    with_models(
        f"""select production_date,
    avg(cast(defect_flag as integer)) as defect_rate,
    count(part_id) as parts,
    avg(cast(defect_flag as integer)) * 100e0 as defect_rate_pct
from {GOLD}
where production_date is not null
group by production_date
order by production_date"""
    ),
)
def daily_defect_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_defect_trend(_gold(spark, sf_dir))


@register(
    "failing_dimensions",
    with_models(
        f"""select dimension_name, count(distinct part_id) as failing_parts
from (
    select part_id, unnest(string_split(failing_dimension_names, '{R.LIST_SEPARATOR}')) as dimension_name
    from {GOLD}
    where coalesce(failing_dimension_names, '') <> '')
group by dimension_name
order by failing_parts desc, dimension_name"""
    ),
)
def failing_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.failing_dimensions(_gold(spark, sf_dir))


def _correlation_sql(where: str = "true") -> str:
    cols = R.CORRELATION_COLUMNS
    casts = ", ".join(
        f"cast(cast({c} as integer) as double) as {c}" if c == "defect_flag" else f"cast({c} as double) as {c}"
        for c in cols
    )
    aggs = []
    for a, b in reports.correlation_pairs(cols):
        aggs.append(
            f"round(covar_pop({a}, {b}) / nullif(stddev_pop(case when {b} is not null then {a} end)"
            f" * stddev_pop(case when {a} is not null then {b} end), 0), {R.CORRELATION_DIGITS}) as r__{a}__{b}"
        )
    source = f"(select * from {GOLD} where {where})"
    cells = []
    for a, b in reports.correlation_pairs(cols):
        for x, y in sorted({(a, b), (b, a)}):
            cells.append(
                f"select '{x}' as row_variable, '{y}' as column_variable, r__{a}__{b} as correlation from corr_stats"
            )
    extra = (
        f"corr_input as (select {casts} from {source}),\n"
        f"corr_stats as (select {', '.join(aggs)} from corr_input)"
    )
    return with_models("\nunion all\n".join(cells), extra)


@register("correlation_matrix", _correlation_sql())
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.correlation_matrix(_gold(spark, sf_dir))


# The dashboard filters first and reports on what is left.
_FILTERED = f"production_date between date '{FILTER_START}' and date '{FILTER_END}' and machine_id = '{FILTER_MACHINE}'"


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_summary(_gold(spark, sf_dir), FILTER_START, FILTER_END, FILTER_MACHINE)


@register(
    "filtered_headline_metrics",
    with_models(
        f"""select count(*) as total_parts, count(*) filter (where defect_flag) as defect_parts,
    (count(*) filter (where defect_flag)) / count(*) as defect_rate, avg(composite_quality_score) as avg_quality_score
from {GOLD} where {_FILTERED}"""
    ),
)
def filtered_headline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.headline_metrics(_filtered(spark, sf_dir))


@register(
    "filtered_defect_trend",
    with_models(
        f"""select production_date, avg(cast(defect_flag as integer)) as defect_rate, count(*) as parts,
    avg(cast(defect_flag as integer)) * 100e0 as defect_rate_pct
from {GOLD} where {_FILTERED} group by production_date order by production_date"""
    ),
)
def filtered_defect_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_defect_trend(_filtered(spark, sf_dir))


@register(
    "filtered_failing_dimensions",
    with_models(
        f"""select item as dimension_name, count(*) as failing_parts
from bad_item join {GOLD} using (part_id) where kind = 'dimension' and {_FILTERED}
group by item order by failing_parts desc, item"""
    ),
)
def filtered_failing_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.failing_dimensions(_filtered(spark, sf_dir))


@register("filtered_correlation_matrix", _correlation_sql(_FILTERED))
def filtered_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.correlation_matrix(_filtered(spark, sf_dir))


@register("part_options", with_models(f"select part_id from {GOLD} order by part_id"))
def part_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.part_options(_gold(spark, sf_dir))


_SELECTED = (
    f"(select coalesce(min(part_id) filter (where defect_flag), min(part_id)) from {GOLD})"
)


@register("part_trace_summary", with_models(f"select * from {GOLD} where part_id in {_SELECTED}"))
def part_trace_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = from_testdata(spark, sf_dir)
    return reports.part_trace(layers.gold, layers.bronze)["summary"]


@register(
    "part_trace_cmm",
    with_models(f"select * from bronze_cmm_inspection where part_id in {_SELECTED} order by dimension_name"),
)
def part_trace_cmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = from_testdata(spark, sf_dir)
    return reports.part_trace(layers.gold, layers.bronze)["cmm"]


@register(
    "part_trace_torque",
    with_models(f"select * from bronze_torque_audit where part_id in {_SELECTED} order by joint_id"),
)
def part_trace_torque(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = from_testdata(spark, sf_dir)
    return reports.part_trace(layers.gold, layers.bronze)["torque"]


@register(
    "part_trace_process",
    with_models(f"select * from bronze_process_parameters where part_id in {_SELECTED}"),
)
def part_trace_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = from_testdata(spark, sf_dir)
    return reports.part_trace(layers.gold, layers.bronze)["process"]


@register(
    "part_trace_cert",
    with_models(
        "select * from bronze_supplier_material_certs where batch_id in "
        f"(select batch_id from {GOLD} where part_id in {_SELECTED})"
    ),
)
def part_trace_cert(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = from_testdata(spark, sf_dir)
    return reports.part_trace(layers.gold, layers.bronze)["cert"]


def _fields_sql() -> str:
    from partwise.operators.mart import GOLD_COLUMNS

    fields = [c for c in GOLD_COLUMNS if c != "part_id"]
    selects = [
        f"select part_id, {i} as position, '{c}' as field, cast({c} as varchar) as value from trace_row"
        for i, c in enumerate(fields)
    ]
    return with_models(
        "\nunion all\n".join(selects),
        f"trace_row as (select * from {GOLD} where part_id in {_SELECTED})",
    )


@register("part_trace_fields", _fields_sql())
def part_trace_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = from_testdata(spark, sf_dir)
    return reports.summary_fields(reports.part_trace(layers.gold, layers.bronze)["summary"])
