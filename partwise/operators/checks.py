"""Declarative data-quality checks over the model's tables.

Five kinds, each counting what its test query returns:

* ``not_null``: rows where the column is NULL;
* ``unique``: non-NULL values occurring more than once (``failing_rows``
  counts the rows carrying them);
* ``accepted_values``: distinct non-NULL values outside the list
  (``failing_rows`` counts their rows); NULL is not reported;
* ``relationships``: child rows whose non-NULL key has no parent row;
* ``measurement_between``: rows that are NULL, below min or above max (both
  ends valid).

Execution: every table is read once. Its rows are counted by key with the sums of
their violations beside, and by bad value, before anything is shuffled: a key
holding a third of a table costs one row per map task. The counts of all tables
stand side by side per key, and every check is a sum over keys. Without key checks
(``unique``, ``relationships``) a table's sums are all there is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.operators.joins import union_all

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED = "accepted_values"
RELATIONSHIPS = "relationships"
BETWEEN = "measurement_between"
KINDS = (NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS, BETWEEN)
ROW_KINDS = (NOT_NULL, BETWEEN)

RESULT_SCHEMA = (
    "position int, model string, column_name string, test_name string, check_id string, "
    "failures bigint, failing_rows bigint, status string"
)


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    to_model: str | None = None
    to_field: str | None = None

    @property
    def check_id(self) -> str:
        target = f"__{self.to_model}.{self.to_field}" if self.kind == RELATIONSHIPS else ""
        return f"{self.kind}__{self.model}__{self.column}{target}"


# FIXED VALUES: the declared checks, one per line, in declaration order:
# (model, column, test, arguments). Arguments are the accepted values, the
# (min, max) range, or the (parent model, parent column) of a relationship.
DECLARED_CHECKS: tuple[tuple[str, str, str, tuple], ...] = (
    ("bronze_process_parameters", "part_id", "not_null", ()),
    ("bronze_process_parameters", "part_id", "unique", ()),
    ("bronze_process_parameters", "production_date", "not_null", ()),
    ("bronze_process_parameters", "machine_id", "not_null", ()),
    ("bronze_process_parameters", "batch_id", "not_null", ()),
    ("bronze_process_parameters", "batch_id", "relationships", ("bronze_supplier_material_certs", "batch_id")),
    ("bronze_process_parameters", "spindle_speed", "not_null", ()),
    ("bronze_process_parameters", "spindle_speed", "measurement_between", (8000, 14000)),
    ("bronze_process_parameters", "feed_rate", "not_null", ()),
    ("bronze_process_parameters", "feed_rate", "measurement_between", (300, 1000)),
    ("bronze_process_parameters", "coolant_temp", "not_null", ()),
    ("bronze_process_parameters", "coolant_temp", "measurement_between", (18, 45)),
    ("bronze_process_parameters", "cycle_time", "not_null", ()),
    ("bronze_process_parameters", "cycle_time", "measurement_between", (45, 180)),
    ("bronze_cmm_inspection", "part_id", "not_null", ()),
    ("bronze_cmm_inspection", "part_id", "relationships", ("bronze_process_parameters", "part_id")),
    ("bronze_cmm_inspection", "dimension_name", "not_null", ()),
    ("bronze_cmm_inspection", "measured_value", "not_null", ()),
    ("bronze_cmm_inspection", "measured_value", "measurement_between", (0, 200)),
    ("bronze_cmm_inspection", "nominal", "not_null", ()),
    ("bronze_cmm_inspection", "nominal", "measurement_between", (0, 200)),
    ("bronze_cmm_inspection", "tolerance", "not_null", ()),
    ("bronze_cmm_inspection", "tolerance", "measurement_between", (0.001, 1)),
    ("bronze_cmm_inspection", "pass_fail", "not_null", ()),
    ("bronze_cmm_inspection", "pass_fail", "accepted_values", ("PASS", "FAIL")),
    ("bronze_torque_audit", "part_id", "not_null", ()),
    ("bronze_torque_audit", "part_id", "relationships", ("bronze_process_parameters", "part_id")),
    ("bronze_torque_audit", "joint_id", "not_null", ()),
    ("bronze_torque_audit", "target_torque", "not_null", ()),
    ("bronze_torque_audit", "target_torque", "measurement_between", (20, 100)),
    ("bronze_torque_audit", "actual_torque", "not_null", ()),
    ("bronze_torque_audit", "actual_torque", "measurement_between", (20, 100)),
    ("bronze_torque_audit", "angle", "not_null", ()),
    ("bronze_torque_audit", "angle", "measurement_between", (25, 95)),
    ("bronze_torque_audit", "pass_fail", "not_null", ()),
    ("bronze_torque_audit", "pass_fail", "accepted_values", ("PASS", "FAIL")),
    ("bronze_supplier_material_certs", "batch_id", "not_null", ()),
    ("bronze_supplier_material_certs", "batch_id", "unique", ()),
    ("bronze_supplier_material_certs", "supplier_id", "not_null", ()),
    ("bronze_supplier_material_certs", "hardness", "not_null", ()),
    ("bronze_supplier_material_certs", "hardness", "measurement_between", (120, 280)),
    ("bronze_supplier_material_certs", "tensile_strength", "not_null", ()),
    ("bronze_supplier_material_certs", "tensile_strength", "measurement_between", (450, 900)),
    ("bronze_supplier_material_certs", "cert_date", "not_null", ()),
    ("silver_part_population", "part_id", "not_null", ()),
    ("silver_part_population", "part_id", "unique", ()),
    ("silver_part_population", "production_date", "not_null", ()),
    ("silver_part_population", "batch_id", "not_null", ()),
    ("silver_part_population", "spindle_speed", "measurement_between", (8000, 14000)),
    ("silver_part_population", "feed_rate", "measurement_between", (300, 1000)),
    ("silver_part_population", "coolant_temp", "measurement_between", (18, 45)),
    ("silver_part_population", "cycle_time", "measurement_between", (45, 180)),
    ("silver_cmm_quality", "part_id", "not_null", ()),
    ("silver_cmm_quality", "part_id", "unique", ()),
    ("silver_cmm_quality", "part_id", "relationships", ("silver_part_population", "part_id")),
    ("silver_cmm_quality", "inspected_dimension_count", "measurement_between", (1, 20)),
    ("silver_cmm_quality", "failed_dimension_count", "measurement_between", (0, 20)),
    ("silver_torque_quality", "part_id", "not_null", ()),
    ("silver_torque_quality", "part_id", "unique", ()),
    ("silver_torque_quality", "part_id", "relationships", ("silver_part_population", "part_id")),
    ("silver_torque_quality", "audited_joint_count", "measurement_between", (1, 20)),
    ("silver_torque_quality", "failed_joint_count", "measurement_between", (0, 20)),
    ("silver_material_quality", "part_id", "not_null", ()),
    ("silver_material_quality", "part_id", "unique", ()),
    ("silver_material_quality", "part_id", "relationships", ("silver_part_population", "part_id")),
    ("silver_material_quality", "batch_id", "not_null", ()),
    ("silver_material_quality", "hardness", "measurement_between", (120, 280)),
    ("silver_material_quality", "tensile_strength", "measurement_between", (450, 900)),
    ("silver_part_quality_flags", "part_id", "not_null", ()),
    ("silver_part_quality_flags", "part_id", "unique", ()),
    ("silver_part_quality_flags", "part_id", "relationships", ("silver_part_population", "part_id")),
    ("silver_part_quality_flags", "defect_flag", "not_null", ()),
    ("silver_part_quality_flags", "defect_root_cause", "not_null", ()),
    ("silver_part_quality_flags", "defect_root_cause", "accepted_values",
     ("dimension", "torque", "material", "unknown", "none")),
    ("mart_part_quality_summary", "part_id", "not_null", ()),
    ("mart_part_quality_summary", "part_id", "unique", ()),
    ("mart_part_quality_summary", "production_date", "not_null", ()),
    ("mart_part_quality_summary", "machine_id", "not_null", ()),
    ("mart_part_quality_summary", "batch_id", "not_null", ()),
    ("mart_part_quality_summary", "spindle_speed", "measurement_between", (8000, 14000)),
    ("mart_part_quality_summary", "feed_rate", "measurement_between", (300, 1000)),
    ("mart_part_quality_summary", "coolant_temp", "measurement_between", (18, 45)),
    ("mart_part_quality_summary", "cycle_time", "measurement_between", (45, 180)),
    ("mart_part_quality_summary", "hardness", "measurement_between", (120, 280)),
    ("mart_part_quality_summary", "tensile_strength", "measurement_between", (450, 900)),
    ("mart_part_quality_summary", "defect_flag", "not_null", ()),
    ("mart_part_quality_summary", "defect_root_cause", "not_null", ()),
    ("mart_part_quality_summary", "defect_root_cause", "accepted_values",
     ("dimension", "torque", "material", "unknown", "none")),
    ("mart_part_quality_summary", "composite_quality_score", "not_null", ()),
    ("mart_part_quality_summary", "composite_quality_score", "measurement_between", (0, 100)),
)


def _check(model: str, column: str, kind: str, args: tuple) -> Check:
    if kind == BETWEEN:
        return Check(model, column, kind, min_value=float(args[0]), max_value=float(args[1]))
    if kind == ACCEPTED:
        return Check(model, column, kind, values=tuple(args))
    if kind == RELATIONSHIPS:
        return Check(model, column, kind, to_model=args[0], to_field=args[1])
    return Check(model, column, kind)


CHECKS: tuple[Check, ...] = tuple(_check(*row) for row in DECLARED_CHECKS)


def _q(name: str) -> str:
    return f"`{name}`"


def _literal(value: str | float) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"cast({float(value)!r} as double)"


def violation(check: Check) -> str:
    """SQL predicate of a row-level check (true = the row violates it)."""
    c = _q(check.column)
    if check.kind == NOT_NULL:
        return f"{c} is null"
    if check.kind == BETWEEN:
        return f"{c} is null or {c} < {_literal(check.min_value)} or {c} > {_literal(check.max_value)}"
    if check.kind == ACCEPTED:
        return f"coalesce({c} not in ({', '.join(_literal(v) for v in check.values)}), false)"
    raise ValueError(f"not a row-level check: {check.kind}")


def _result(pos: int, check: Check, failures: str, failing_rows: str) -> str:
    """named_struct of one result row; ``failures``/``failing_rows`` are SQL."""
    return (
        f"named_struct('position', {pos}, 'model', {_literal(check.model)}, "
        f"'column_name', {_literal(check.column)}, 'test_name', {_literal(check.kind)}, "
        f"'check_id', {_literal(check.check_id)}, "
        f"'failures', cast({failures} as bigint), 'failing_rows', cast({failing_rows} as bigint), "
        f"'status', case when {failures} > 0 then 'fail' else 'pass' end)"
    )


def _explode_results(df: DataFrame, cells: list[str]) -> DataFrame:
    return df.selectExpr(f"inline(array({', '.join(cells)}))")


def _table_pass(table: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """All row-level checks of one table in a single pass.

    Rows are counted by their bad values of the accepted_values columns (NULL
    for good ones), so the second, tiny aggregate has the distinct bad values
    as well; a distinct count over the rows would make Spark expand them all.
    """
    accepted = [(pos, check) for pos, check in numbered if check.kind == ACCEPTED]
    counted = [(pos, check) for pos, check in numbered if check.kind != ACCEPTED]
    bad = [f"case when {violation(check)} then {_q(check.column)} end as v{pos}" for pos, check in accepted]
    flags = [f"cast({violation(check)} as int) as f{pos}" for pos, check in counted]
    groups = table.selectExpr(*bad, *flags, "1 as one").groupBy(*[f"v{pos}" for pos, _ in accepted]).agg(
        F.count("one").alias("n"), *[F.sum(f"f{pos}").alias(f"r{pos}") for pos, _ in counted]
    )
    totals = groups.selectExpr(
        *[f"coalesce(sum(r{pos}), 0) as r{pos}" for pos, _ in counted],
        *[f"count(distinct v{pos}) as k{pos}" for pos, _ in accepted],
        *[f"coalesce(sum(n) filter (where v{pos} is not null), 0) as n{pos}" for pos, _ in accepted],
    )
    cells = [_result(pos, check, f"r{pos}", f"r{pos}") for pos, check in counted]
    cells += [_result(pos, check, f"k{pos}", f"n{pos}") for pos, check in accepted]
    return _explode_results(totals, cells)


def _keys(numbered: list[tuple[int, Check]]) -> tuple[dict[tuple[str, str], int], dict[tuple[str, str], str]]:
    """Tag and domain of every key column; a key and what it refers to share a domain."""
    tags: dict[tuple[str, str], int] = {}
    domain: dict[tuple[str, str], str] = {}
    for _, check in numbered:
        own = (check.model, check.column)
        tags.setdefault(own, len(tags))
        domain[own] = domain.get(own, check.column)
        if check.kind == RELATIONSHIPS:
            other = (check.to_model, check.to_field)
            tags.setdefault(other, len(tags))
            domain[own] = domain[other] = domain.get(other, check.to_field)
    return tags, domain


#: Domains of a table without keys, and of the violations of row checks (by position).
_NO_KEY, _ROWS = "#none", "#rows"


def _struct(domain: str, key: str, tag: str, n: str) -> str:
    return f"named_struct('domain', {domain}, 'key', {key}, 'tag', {tag}, 'n', {n})"


def _counted(table: DataFrame, keys: list[tuple[str, str, int]], sums: list[tuple[int, Check]], bad: list[tuple[int, Check]]) -> DataFrame:
    """(domain, key, tag, n) of one table, in one pass over it.

    ``keys`` are (column, domain, tag). The rows are counted by key, with the
    violations of row checks summed beside the first key (or all rows, without one);
    sums that are not 0 become counts of their own, by the check's position. A bad
    value of an accepted_values check is a key of the check's own domain.
    """
    cells = [f"named_struct('domain', '{domain}', 'key', cast({_q(column)} as string), 'tag', {tag})" for column, domain, tag in keys]
    if not cells:
        cells.append(f"named_struct('domain', '{_NO_KEY}', 'key', cast(null as string), 'tag', -1)")
    cells += [f"case when {violation(check)} then named_struct('domain', '#bad{pos}', 'key', cast({_q(check.column)} as string), 'tag', -1) end" for pos, check in bad]
    flags = [f"cast({violation(check)} as int) as f{pos}" for pos, check in sums]
    if len(cells) == 1:
        rows = table.selectExpr(f"{cells[0]} as cell", "0 as place", *flags)
    else:
        rows = table.selectExpr(f"posexplode(array({', '.join(cells)})) as (place, cell)", *flags).filter("cell is not null")
    totals = [F.expr(f"sum(f{pos})" if len(cells) == 1 else f"sum(if(place = 0, f{pos}, 0))").alias(f"r{pos}") for pos, _ in sums]
    found = rows.groupBy("cell.domain", "cell.key", "cell.tag").agg(F.count(F.lit(1)).alias("n"), *totals)
    out = [_struct("domain", "key", "tag", "n")] + [f"case when r{pos} > 0 then {_struct(repr(_ROWS), repr(str(pos)), '-1', f'r{pos}')} end" for pos, _ in sums]
    return found.selectExpr(f"inline(array_compact(array({', '.join(out)})))")


def _one_pass(tables: dict[str, DataFrame], numbered: list[tuple[int, Check]]) -> DataFrame:
    """All given checks, each table read once."""
    tags, domain = _keys([(i, c) for i, c in numbered if c.kind in (UNIQUE, RELATIONSHIPS)])
    frames = []
    for m in dict.fromkeys([c.model for _, c in numbered] + [model for model, _ in tags]):
        keys = [(column, domain[model, column], tag) for (model, column), tag in tags.items() if model == m]
        of = lambda *kinds: [(i, c) for i, c in numbered if c.model == m and c.kind in kinds]  # noqa: B023, E731
        frames.append(_counted(tables[m], keys, of(*ROW_KINDS), of(ACCEPTED)))
    by_key = union_all(frames).groupBy("domain", "key").agg(*[F.expr(f"sum(n) filter (where tag = {tag})").alias(f"n{tag}") for tag in tags.values()], F.sum("n").alias("n"))
    # What each key adds to a check: (position, failures, failing rows).
    adds = lambda pos, hit, failures, rows: f"case when {hit} then named_struct('position', {pos}, 'failures', cast({failures} as bigint), 'failing_rows', cast({rows} as bigint)) end"
    cells = [adds("cast(key as int)", f"domain = '{_ROWS}'", "n", "n")]
    for pos, check in numbered:
        n = f"n{tags.get((check.model, check.column))}"
        if check.kind == ACCEPTED:
            cells.append(adds(pos, f"domain = '#bad{pos}'", "1", "n"))
        elif check.kind == UNIQUE:
            cells.append(adds(pos, f"key is not null and {n} > 1", "1", n))
        elif check.kind == RELATIONSHIPS:
            cells.append(adds(pos, f"key is not null and {n} is not null and n{tags[check.to_model, check.to_field]} is null", n, n))
    found = by_key.selectExpr(f"inline(array_compact(array({', '.join(cells)})))").groupBy("position").agg(F.sum("failures").alias("failures"), F.sum("failing_rows").alias("failing_rows"))
    found = found.selectExpr("position", *[f"cast(null as string) as {c}" for c in ("model", "column_name", "test_name", "check_id")], "failures", "failing_rows")
    # One row of each check, so that those that nothing violates are there.
    spark = by_key.sparkSession
    listed = spark.createDataFrame([(i, c.model, c.column, c.kind, c.check_id, 0, 0) for i, c in numbered], RESULT_SCHEMA.rsplit(", status", 1)[0])
    names = [F.max(c).alias(c) for c in ("model", "column_name", "test_name", "check_id")]
    return listed.unionByName(found).groupBy("position").agg(*names, F.sum("failures").alias("failures"), F.sum("failing_rows").alias("failing_rows")).withColumn(
        "status", F.when(F.col("failures") > 0, "fail").otherwise("pass")
    )


def run_checks(
    tables: dict[str, DataFrame],
    checks: tuple[Check, ...] = CHECKS,
    kinds: tuple[str, ...] | None = None,
) -> DataFrame:
    """One result row per check: position, model, column_name, test_name,
    check_id, failures, failing_rows, status ('pass' when failures = 0)."""
    numbered = [(i, c) for i, c in enumerate(checks, start=1) if kinds is None or c.kind in kinds]
    if not numbered:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], RESULT_SCHEMA)
    if any(c.kind in (UNIQUE, RELATIONSHIPS) for _, c in numbered):
        return _one_pass(tables, numbered).orderBy("position")
    models = dict.fromkeys(c.model for _, c in numbered)
    return union_all([_table_pass(tables[m], [(i, c) for i, c in numbered if c.model == m]) for m in models]).orderBy("position")


class DataQualityError(RuntimeError):
    pass


def assert_unique_keys(tables: dict[str, DataFrame]) -> None:
    """Gate before Gold: one process row per part, one certificate per batch.

    Duplicate keys would multiply rows through the part-grain joins, so the
    build stops instead. Runs two partially aggregated key counts.
    """
    keys = (
        Check("bronze_process_parameters", "part_id", UNIQUE),
        Check("bronze_supplier_material_certs", "batch_id", UNIQUE),
    )
    result = run_checks(tables, keys).filter("failures > 0").collect()
    if result:
        detail = ", ".join(f"{r.model}.{r.column_name}: {r.failures} duplicated keys" for r in result)
        raise DataQualityError(f"duplicate keys: {detail}")
