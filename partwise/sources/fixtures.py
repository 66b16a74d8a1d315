"""Four source extracts derived from the benchmark tables.

The test tables hold no manufacturing data, so each source is derived from a
whole benchmark table by a fixed rule (see FIXTURES.md):

* process_parameters: one row per ``orders`` row;
* cmm_inspection: one row per ``lineitem`` row (a dimension per line);
* torque_audit: one row per ``lineitem`` row (a joint per line);
* supplier_material_certs: one row per ``part`` row.

Every twentieth customer's orders carry a batch key that no part has, which
leaves their parts without a certificate; no row of any table is left out. The
frames look like raw extract files: dates as ISO text, CMM pass/fail in lower
case, so the typed Bronze projection does real work.

Each rule is one SELECT template rendered for Spark SQL and for DuckDB (the
oracle); only type names and the table reference differ. Doubles are written
with an exponent because ``0.05`` is a decimal in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partwise.operators.joins import estimated_bytes
from partwise.session import size_tasks

# (source table, SELECT template). ``{src}`` is the table, ``{string}`` and
# ``{timestamp}`` the engine's names for text and zone-less timestamps.
FIXTURES: dict[str, tuple[str, str]] = {
    "process_parameters": (
        "orders",
        """
    select
        cast(o_orderdate as {timestamp}) as process_ts,
        cast(cast(o_orderdate as date) as {string}) as production_date,
        'PART-' || cast(o_orderkey as {string}) as part_id,
        o_orderpriority as part_model,
        'LINE-' || o_orderstatus as line_id,
        case when o_orderkey % 2 = 0 then 'A' else 'B' end as shift,
        'CNC-0' || cast(o_custkey % 8 + 1 as {string}) as machine_id,
        case when o_custkey % 20 = 0 then 'LOST-' else 'MAT-' end || cast(o_custkey as {string}) as batch_id,
        8000e0 + o_orderkey % 6001 as spindle_speed,
        560e0 + o_orderkey % 180 as feed_rate,
        24e0 + (o_orderkey % 121) / 10e0 as coolant_temp,
        80e0 + (o_custkey % 300) / 10e0 as cycle_time
    from {src}""",
    ),
    "cmm_inspection": (
        "lineitem",
        """
    select
        cast(l_shipdate as {timestamp}) as inspection_ts,
        cast(cast(l_shipdate as date) as {string}) as production_date,
        'PART-' || cast(l_orderkey as {string}) as part_id,
        'DIM-' || cast(l_linenumber as {string}) as dimension_name,
        10e0 * l_linenumber + (l_quantity - 25e0) / 490e0 as measured_value,
        10e0 * l_linenumber as nominal,
        case when l_linenumber = 7 then 0e0 else 5e-2 end as tolerance,
        10e0 * l_linenumber - 5e-2 as lower_spec_limit,
        10e0 * l_linenumber + 5e-2 as upper_spec_limit,
        case when abs(l_quantity - 25e0) <= 24e0 then 'pass' else 'fail' end as pass_fail
    from {src}""",
    ),
    "torque_audit": (
        "lineitem",
        """
    select
        cast(l_shipdate as {timestamp}) as audit_ts,
        cast(cast(l_shipdate as date) as {string}) as production_date,
        'PART-' || cast(l_orderkey as {string}) as part_id,
        'J-0' || cast(l_linenumber as {string}) as joint_id,
        65e0 as target_torque,
        65e0 * (1e0 + (l_tax - 4e-2)) as actual_torque,
        70e0 + (l_quantity - 25e0) / 5e0 as angle,
        65e0 * 95e-2 as torque_lower_limit,
        65e0 * 105e-2 as torque_upper_limit,
        62e0 as angle_lower_limit,
        78e0 as angle_upper_limit,
        case when l_tax < 5e-3 and l_discount < 5e-3 then 'FAIL' else 'PASS' end as pass_fail
    from {src}""",
    ),
    "supplier_material_certs": (
        "part",
        """
    select
        'MAT-' || cast(p_partkey as {string}) as batch_id,
        'SUP-' || p_brand as supplier_id,
        178e0 + p_size * 105e-2 as hardness,
        570e0 + p_partkey % 197 as tensile_strength,
        '2026-06-01' as cert_date,
        180e0 as hardness_min_spec,
        230e0 as hardness_max_spec,
        580e0 as tensile_min_spec,
        760e0 as tensile_max_spec,
        not (178e0 + p_size * 105e-2 between 180e0 and 230e0)
            or not (570e0 + p_partkey % 197 between 580e0 and 760e0) as material_deviation
    from {src}""",
    ),
}

_SPARK_TYPES = {"string": "string", "timestamp": "timestamp_ntz"}
_DUCKDB_TYPES = {"string": "varchar", "timestamp": "timestamp"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    table, template = FIXTURES[source]
    text = template.format(src="{src}", **_SPARK_TYPES)
    return spark.sql(text, src=read_table(spark, sf_dir, table))


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    size_tasks(spark, sum(estimated_bytes(read_table(spark, sf_dir, table)) or 0 for table, _ in FIXTURES.values()))
    return {source: raw_source(spark, sf_dir, source) for source in FIXTURES}


# The same derivation for DuckDB, where the tables are registered views.
FIXTURE_SQL = {
    source: template.format(src=table, **_DUCKDB_TYPES) for source, (table, template) in FIXTURES.items()
}
