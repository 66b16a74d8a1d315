"""Data-quality and verdict queries (registered on import), with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partwise.functions import rules as R
from partwise.operators import checks as C
from partwise.operators import verdicts as V
from partwise.plans.catalog import register
from partwise.plans.layers import from_testdata, materialize, typed_sources
from partwise.plans.oracle import with_models
from partwise.session import shared_dir
from partwise.sources.fixtures import raw_sources


def _num(v: float) -> str:
    return f"cast({float(v)!r} as double)"


def _in_list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _check_sql(pos: int, check: C.Check) -> str:
    head = (
        f"select {pos} as position, '{check.model}' as model, '{check.column}' as column_name, "
        f"'{check.kind}' as test_name, '{check.check_id}' as check_id"
    )
    col = check.column
    if check.kind == C.NOT_NULL:
        n = f"cast(count(*) filter (where {col} is null) as bigint)"
        return f"{head}, {n} as failures, {n} as failing_rows from {check.model}"
    if check.kind == C.BETWEEN:
        cond = f"{col} is null or {col} < {_num(check.min_value)} or {col} > {_num(check.max_value)}"
        n = f"cast(count(*) filter (where {cond}) as bigint)"
        return f"{head}, {n} as failures, {n} as failing_rows from {check.model}"
    if check.kind == C.ACCEPTED:
        bad = f"{col} not in ({_in_list(check.values)})"
        return (
            f"{head}, cast(count(distinct case when {bad} then {col} end) as bigint) as failures, "
            f"cast(count(*) filter (where {bad}) as bigint) as failing_rows from {check.model}"
        )
    if check.kind == C.UNIQUE:
        return (
            f"{head}, cast(count(*) as bigint) as failures, cast(coalesce(sum(n), 0) as bigint) as failing_rows "
            f"from (select {col}, count(*) as n from {check.model} where {col} is not null "
            f"group by {col} having count(*) > 1)"
        )
    if check.kind == C.RELATIONSHIPS:
        n = "cast(count(*) as bigint)"
        return (
            f"{head}, {n} as failures, {n} as failing_rows from {check.model} c "
            f"where c.{col} is not null and not exists "
            f"(select 1 from {check.to_model} p where p.{check.to_field} = c.{col})"
        )
    raise ValueError(check.kind)


def checks_sql(kinds: tuple[str, ...] | None = None) -> str:
    selects = [
        _check_sql(pos, check)
        for pos, check in enumerate(C.CHECKS, start=1)
        if kinds is None or check.kind in kinds
    ]
    body = "\nunion all\n".join(f"({s})" for s in selects)
    return with_models(
        "select position, model, column_name, test_name, check_id, failures, failing_rows, "
        f"case when failures > 0 then 'fail' else 'pass' end as status from (\n{body}\n) order by position"
    )


def _check_query(name: str, kinds: tuple[str, ...] | None) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return C.run_checks(from_testdata(spark, sf_dir).tables(), kinds=kinds)

    register(name, checks_sql(kinds))(build)


_check_query("dq_not_null", (C.NOT_NULL,))
_check_query("dq_unique", (C.UNIQUE,))
_check_query("dq_accepted_values", (C.ACCEPTED,))
_check_query("dq_relationships", (C.RELATIONSHIPS,))
_check_query("dq_measurement_between", (C.BETWEEN,))


@register("dq_suite", checks_sql(None))
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on written tables, as the daily job runs them: no Silver or Gold table is computed twice."""
    typed = typed_sources(raw_sources(spark, sf_dir))
    return C.run_checks(materialize(spark, typed, shared_dir(spark, "partwise-model")).tables())



# ---------------------------------------------------------------- verdicts
_CMM_VERDICT_SQL = f"""select part_id, dimension_name, measured_value, lower_spec_limit, upper_spec_limit,
    nominal - tolerance as expected_lower_limit,
    nominal + tolerance as expected_upper_limit,
    coalesce(abs(lower_spec_limit - (nominal - tolerance)) <= {_num(V.LIMIT_EPSILON)}, false)
      and coalesce(abs(upper_spec_limit - (nominal + tolerance)) <= {_num(V.LIMIT_EPSILON)}, false) as limits_consistent,
    pass_fail as declared_pass_fail,
    case when measured_value between lower_spec_limit and upper_spec_limit then 'PASS' else 'FAIL' end
        as recomputed_pass_fail,
    pass_fail is not distinct from
        (case when measured_value between lower_spec_limit and upper_spec_limit then 'PASS' else 'FAIL' end)
        as verdict_consistent
from bronze_cmm_inspection"""

_TORQUE_OK = (
    "actual_torque between torque_lower_limit and torque_upper_limit "
    "and angle between angle_lower_limit and angle_upper_limit"
)
_TORQUE_VERDICT_SQL = f"""select part_id, joint_id, actual_torque, angle, torque_lower_limit, torque_upper_limit,
    target_torque * {_num(R.TORQUE_LOWER_FACTOR)} as expected_torque_lower_limit,
    target_torque * {_num(R.TORQUE_UPPER_FACTOR)} as expected_torque_upper_limit,
    coalesce(abs(torque_lower_limit - target_torque * {_num(R.TORQUE_LOWER_FACTOR)}) <= {_num(V.LIMIT_EPSILON)}, false)
      and coalesce(abs(torque_upper_limit - target_torque * {_num(R.TORQUE_UPPER_FACTOR)}) <= {_num(V.LIMIT_EPSILON)}, false)
      and coalesce(abs((angle_upper_limit - angle_lower_limit) - {_num(2 * R.ANGLE_HALF_WIDTH)}) <= {_num(V.LIMIT_EPSILON)}, false)
      as limits_consistent,
    pass_fail as declared_pass_fail,
    case when {_TORQUE_OK} then 'PASS' else 'FAIL' end as recomputed_pass_fail,
    pass_fail is not distinct from (case when {_TORQUE_OK} then 'PASS' else 'FAIL' end) as verdict_consistent
from bronze_torque_audit"""

_MAT_DEV = (
    "(coalesce(hardness < hardness_min_spec or hardness > hardness_max_spec, false) "
    "or coalesce(tensile_strength < tensile_min_spec or tensile_strength > tensile_max_spec, false))"
)
_MATERIAL_VERDICT_SQL = f"""select batch_id, supplier_id, hardness, tensile_strength,
    material_deviation as declared_deviation,
    {_MAT_DEV} as recomputed_deviation,
    material_deviation is not distinct from {_MAT_DEV} as verdict_consistent
from bronze_supplier_material_certs"""


def _verdict_word(flag: str) -> str:
    return f"case when {flag} then 'FAIL' when not {flag} then 'PASS' end"


_AUDIT_SQL = f"""select 'cmm_inspection' as source, part_id as record_id, dimension_name as item_id,
    declared_pass_fail as declared_verdict, recomputed_pass_fail as recomputed_verdict
from ({_CMM_VERDICT_SQL}) where not verdict_consistent
union all
select 'torque_audit', part_id, joint_id, declared_pass_fail, recomputed_pass_fail
from ({_TORQUE_VERDICT_SQL}) where not verdict_consistent
union all
select 'supplier_material_certs', batch_id, cast(null as varchar),
    {_verdict_word('declared_deviation')}, {_verdict_word('recomputed_deviation')}
from ({_MATERIAL_VERDICT_SQL}) where not verdict_consistent"""


def _bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return from_testdata(spark, sf_dir).bronze


@register("verdict_cmm", with_models(_CMM_VERDICT_SQL))
def verdict_cmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.cmm_verdicts(_bronze(spark, sf_dir)["cmm_inspection"])


@register("verdict_torque", with_models(_TORQUE_VERDICT_SQL))
def verdict_torque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.torque_verdicts(_bronze(spark, sf_dir)["torque_audit"])


@register("verdict_material", with_models(_MATERIAL_VERDICT_SQL))
def verdict_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.material_verdicts(_bronze(spark, sf_dir)["supplier_material_certs"])


@register("verdict_audit", with_models(_AUDIT_SQL))
def verdict_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return V.verdict_audit(b["cmm_inspection"], b["torque_audit"], b["supplier_material_certs"])
