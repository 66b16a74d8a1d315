"""DuckDB SQL for the correctness oracle.

The oracle does not follow the model's steps. It puts every inspection into one
long table of events (part, kind, item, bad, ratio), every certificate fault
into a table of fired rules (part, priority, reason), every defect into a table
of causes (part, priority, cause) and every deduction into a table of penalties
(part, points). Silver and Gold columns are then lookups and sums over those
tables: the reason or cause is the one of least priority, the score what the
penalties leave. Filtered counts use sums of 0/1 and doubles have an exponent.
"""

from __future__ import annotations

from partwise.functions import rules as R
from partwise.sources.fixtures import FIXTURE_SQL
from partwise.sources.schemas import SOURCE_SCHEMAS, UPPERCASED

_DUCK_TYPES = {
    "timestamp_ntz": "timestamp",
    "date": "date",
    "string": "varchar",
    "double": "double",
    "boolean": "boolean",
}


def _bronze_sql(source: str) -> str:
    cols = []
    for name, kind in SOURCE_SCHEMAS[source]:
        expr = f"cast({name} as {_DUCK_TYPES[kind]})"
        if name in UPPERCASED.get(source, ()):
            expr = f"upper({expr})"
        cols.append(f"{expr} as {name}")
    return f"select {', '.join(cols)} from raw_{source}"


def _outcome_sql(kind: str, names: tuple[str, ...], digits: int) -> str:
    seen, failed, any_name, worst, listed = names
    return f"""select part_id, first_day as production_date, seen as {seen}, bad as {failed}, bad > 0 as {any_name},
        round(worst, {digits}) as {worst}, bad_items as {listed}
    from outcome where kind = '{kind}'"""


_CMM_NAMES = (
    "inspected_dimension_count", "failed_dimension_count", "any_dimension_out_of_tolerance",
    "max_dimension_tolerance_utilization", "failing_dimension_names",
)
_TORQUE_NAMES = ("audited_joint_count", "failed_joint_count", "any_torque_failure", "max_torque_error_pct", "failing_joint_ids")


def _model_tables(where: dict[str, str] | None = None) -> dict[str, str]:
    """CTE name -> SELECT, in order of use; ``where`` leaves rows out of raw sources."""
    tables = {f"raw_{name}": sql for name, sql in FIXTURE_SQL.items()}
    for name, kept in (where or {}).items():
        tables[f"raw_{name}"] = f"select * from ({FIXTURE_SQL[name]}) where {kept}"
    tables |= {f"bronze_{name}": _bronze_sql(name) for name in SOURCE_SCHEMAS}
    tables["silver_part_population"] = """select part_id, production_date, process_ts, part_model, line_id, shift, machine_id,
        batch_id, spindle_speed, feed_rate, coolant_temp, cycle_time
    from bronze_process_parameters where not (part_id is null or batch_id is null)"""
    # Every inspection of a known item of a known part.
    tables["event"] = f"""select part_id, 'dimension' as kind, dimension_name as item, pass_fail is not distinct from '{R.FAIL}' as bad, production_date,
        abs(measured_value - nominal) / nullif(tolerance, 0) as ratio from bronze_cmm_inspection where part_id || dimension_name is not null
    union all
    select part_id, 'joint', joint_id, pass_fail is not distinct from '{R.FAIL}', production_date,
        abs(actual_torque - target_torque) / nullif(target_torque, 0) from bronze_torque_audit where part_id || joint_id is not null"""
    tables["bad_item"] = "select distinct part_id, kind, item from event where bad"
    tables["bad_list"] = f"select part_id, kind, string_agg(item, '{R.LIST_SEPARATOR}' order by item) as bad_items from bad_item group by all"
    tables["tally"] = "select part_id, kind, min(production_date) as first_day, count(*) as seen, cast(sum(cast(bad as integer)) as bigint) as bad, max(ratio) as worst from event group by all"
    tables["outcome"] = "select * from tally left join bad_list using (part_id, kind)"
    tables["silver_cmm_quality"] = _outcome_sql("dimension", _CMM_NAMES, R.UTILIZATION_DIGITS)
    tables["silver_torque_quality"] = _outcome_sql("joint", _TORQUE_NAMES, R.TORQUE_ERROR_DIGITS)
    # Certificate rules that fire: (measured, limit) pairs compared one way, by priority.
    tables["reading"] = f"""select batch_id, unnest([
        {{'priority': 2, 'reason': '{R.HARDNESS_LOW}', 'short': hardness_min_spec - hardness}},
        {{'priority': 3, 'reason': '{R.HARDNESS_HIGH}', 'short': hardness - hardness_max_spec}},
        {{'priority': 4, 'reason': '{R.TENSILE_LOW}', 'short': tensile_min_spec - tensile_strength}},
        {{'priority': 5, 'reason': '{R.TENSILE_HIGH}', 'short': tensile_strength - tensile_max_spec}}]) as rule
    from bronze_supplier_material_certs"""
    tables["fired"] = f"""select part_id, rule.priority as priority, rule.reason as reason from silver_part_population join reading using (batch_id) where rule.short > 0
    union all
    select part_id, 1, '{R.MISSING_CERT}' from silver_part_population anti join bronze_supplier_material_certs using (batch_id)
    union all
    select part_id, 9, '{R.IN_SPEC}' from silver_part_population"""
    tables["material"] = "select part_id, arg_min(reason, priority) as material_failure_reason, min(priority) < 9 as any_material_deviation from fired group by part_id"
    tables["silver_material_quality"] = """select p.part_id, p.production_date, p.batch_id, c.supplier_id, c.hardness, c.tensile_strength,
        c.cert_date, m.any_material_deviation, m.material_failure_reason
    from silver_part_population p join material m using (part_id) left join bronze_supplier_material_certs c using (batch_id)"""
    # What is wrong with a part, by priority.
    tables["cause"] = f"""select part_id, if(kind = 'dimension', 1, 2) as priority, if(kind = 'dimension', '{R.CAUSE_DIMENSION}', '{R.CAUSE_TORQUE}') as cause from outcome where bad > 0
    union all
    select part_id, 3, '{R.CAUSE_MATERIAL}' from material where any_material_deviation
    union all
    select part_id, 4, '{R.CAUSE_UNKNOWN}' from (select part_id, kind from silver_part_population, (values ('dimension'), ('joint')) k(kind) except select part_id, kind from outcome)
    union all
    select part_id, 9, '{R.CAUSE_NONE}' from silver_part_population"""
    tables["silver_part_quality_flags"] = """select part_id, any_value(production_date) as production_date,
        bool_or(priority = 1) as any_dimension_out_of_tolerance, bool_or(priority = 2) as any_torque_failure,
        bool_or(priority = 3) as any_material_deviation, min(priority) < 9 as defect_flag, arg_min(cause, priority) as defect_root_cause
    from silver_part_population join cause using (part_id) group by part_id"""
    tables["penalty"] = f"""select part_id, bad * if(kind = 'dimension', {R.PENALTY_PER_FAILED_DIMENSION}, {R.PENALTY_PER_FAILED_JOINT}) as points from outcome
    union all
    select part_id, {R.PENALTY_MATERIAL_DEVIATION} from material where any_material_deviation
    union all
    select part_id, {R.PENALTY_COOLANT_RISK} from silver_part_population where coolant_temp > {R.COOLANT_RISK_ABOVE}e0
    union all
    select part_id, {R.PENALTY_FEED_RISK} from silver_part_population where feed_rate > {R.FEED_RISK_ABOVE}e0"""
    tables["score"] = f"select part_id, {R.SCORE_START} - sum(points) as left_over from penalty group by part_id"
    zero = lambda c: f"coalesce({c}, 0) as {c}"
    tables["mart_part_quality_summary"] = f"""select p.part_id, p.production_date, p.process_ts, p.part_model, p.line_id, p.shift, p.machine_id, p.batch_id,
        q.supplier_id, p.spindle_speed, p.feed_rate, p.coolant_temp, p.cycle_time,
        {zero("inspected_dimension_count")}, {zero("failed_dimension_count")}, f.any_dimension_out_of_tolerance,
        max_dimension_tolerance_utilization, coalesce(failing_dimension_names, '') as failing_dimension_names,
        {zero("audited_joint_count")}, {zero("failed_joint_count")}, f.any_torque_failure, max_torque_error_pct,
        coalesce(failing_joint_ids, '') as failing_joint_ids, q.hardness, q.tensile_strength, q.cert_date,
        f.any_material_deviation, q.material_failure_reason, f.defect_flag, f.defect_root_cause,
        cast(greatest({R.SCORE_MIN}, least({R.SCORE_MAX}, coalesce(left_over, {R.SCORE_START}))) as integer) as composite_quality_score
    from silver_part_population p join silver_part_quality_flags f using (part_id) join silver_material_quality q using (part_id)
    left join (select * exclude (production_date, any_dimension_out_of_tolerance) from silver_cmm_quality) using (part_id)
    left join (select * exclude (production_date, any_torque_failure) from silver_torque_quality) using (part_id)
    left join score using (part_id)"""
    return tables


def model_ctes(where: dict[str, str] | None = None) -> str:
    """The tables above as one WITH list (no WITH keyword)."""
    return ",\n".join(f"{name} as ({sql}\n)" for name, sql in _model_tables(where).items())


def with_models(select_sql: str, extra_ctes: str = "", where: dict[str, str] | None = None) -> str:
    """``select_sql`` over the model CTEs, optionally after more CTEs of its own."""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"with {model_ctes(where)}{extra}\n{select_sql}"


def table(model: str, where: dict[str, str] | None = None) -> str:
    return with_models(f"select * from {model}", where=where)
