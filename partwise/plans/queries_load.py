"""Load queries (registered on import): land the derived extracts as Bronze
files in a fresh folder under the shared checkpoint directory, once or several
times, and read the lake back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.operators.joins import union_all
from partwise.plans.catalog import register
from partwise.plans.layers import build_layers, materialize
from partwise.plans.oracle import table, with_models
from partwise.session import shared_dir
from partwise.sources import bronze as B
from partwise.sources import fixtures, sinks
from partwise.sources.schemas import BRONZE_MODEL, SOURCES

FIRST_DAY, SECOND_DAY = "2026-06-10", "2026-06-11"

# Rows of the second load. Its measurement rows have production days all over
# the range of the first load (late rows), and all certificates share one
# cert_date, so the loads overlap in every date they carry.
_SECOND = {
    "process_parameters": "spindle_speed % 3 = 0",
    "cmm_inspection": "nominal = 20",
    "torque_audit": "joint_id = 'J-02'",
    "supplier_material_certs": "tensile_strength % 4 = 0",
}
# Drift used by the drifted-load query: early days store spindle_speed as a
# whole-number bigint, late days carry an extra column; neither changes Gold.
DRIFT_INT_BEFORE = "1995-01-01"
DRIFT_EXTRA_FROM = "1997-01-01"


def _second(source: str) -> Column:
    return F.expr(_SECOND[source])


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Root of a lake after two loads, and the manifests of both."""
    root = shared_dir(spark, "partwise-bronze")
    raw = fixtures.raw_sources(spark, sf_dir)
    first = sinks.load_sources(spark, {s: df.filter(~_second(s)) for s, df in raw.items()}, root, FIRST_DAY)
    second = sinks.load_sources(spark, {s: df.filter(_second(s)) for s, df in raw.items()}, root, SECOND_DAY)
    return root, first.unionByName(second)


def _lake_rows(spark: SparkSession, root: str) -> DataFrame:
    """(source, production_date, rows) as the lake has them; certificates by cert_date."""
    parts = []
    for source, df in B.read_all(spark, root).items():
        day = "cert_date" if source == "supplier_material_certs" else "production_date"
        parts.append(df.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(source).alias("source"), "day", "rows"))
    return union_all(parts)


def _rows_sql(where: dict[str, str]) -> str:
    parts = []
    for source in SOURCES:
        day = "cert_date" if source == "supplier_material_certs" else "production_date"
        parts.append(f"select '{source}' as source, {day} as day, count(*) as rows from {BRONZE_MODEL[source]} where {where[source]} group by 2")
    return with_models("\nunion all\n".join(parts))


def _manifest_sql() -> str:
    parts = [
        f"select '{source}' as source, date '{day}' as load_day, count(*) as rows, 'bronze/{source}/load_day={day}' as relative_path "
        f"from raw_{source} where {'not ' if day == FIRST_DAY else ''}({_SECOND[source]})"
        for day in (FIRST_DAY, SECOND_DAY)
        for source in SOURCES
    ]
    return with_models("\nunion all\n".join(parts))


@register("bronze_load_manifest", _manifest_sql())
def bronze_load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of two loads."""
    return _two_loads(spark, sf_dir)[1]


@register("bronze_overlapping_loads", _rows_sql({s: "true" for s in SOURCES}))
def bronze_overlapping_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by their own day after two loads that share certificate dates and bring late rows."""
    return _lake_rows(spark, _two_loads(spark, sf_dir)[0])


@register("bronze_rerun_day", _rows_sql({s: f"not ({_SECOND[s]})" for s in SOURCES}))
def bronze_rerun_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after both days were loaded whole and then each again: day one with its own part, day two with an empty extract."""
    root = shared_dir(spark, "partwise-bronze")
    raw = fixtures.raw_sources(spark, sf_dir)
    sinks.load_sources(spark, raw, root, FIRST_DAY)
    sinks.load_sources(spark, raw, root, SECOND_DAY)
    sinks.load_sources(spark, {s: df.filter(~_second(s)) for s, df in raw.items()}, root, FIRST_DAY)
    sinks.load_sources(spark, {s: df.filter(F.lit(False)) for s, df in raw.items()}, root, SECOND_DAY)
    return _lake_rows(spark, root)


@register("bronze_rerun_second_day", _rows_sql({s: "true" for s in SOURCES}))
def bronze_rerun_second_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after day two was emptied by a rerun and then loaded a third time."""
    root, _ = _two_loads(spark, sf_dir)
    raw = fixtures.raw_sources(spark, sf_dir)
    sinks.load_sources(spark, {s: df.filter(F.lit(False)) for s, df in raw.items()}, root, SECOND_DAY)
    sinks.load_sources(spark, {s: df.filter(_second(s)) for s, df in raw.items()}, root, SECOND_DAY)
    return _lake_rows(spark, root)


@register("gold_from_bronze_files", table("mart_part_quality_summary"))
def gold_from_bronze_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over the lake that two loads left."""
    return build_layers(B.read_all(spark, _two_loads(spark, sf_dir)[0])).gold


@register("gold_from_drifted_bronze", table("mart_part_quality_summary"))
def gold_from_drifted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold where the process log lies in both layouts, its dated folders with other types and columns."""
    root = shared_dir(spark, "partwise-bronze")
    raw = fixtures.raw_sources(spark, sf_dir)
    process = raw.pop("process_parameters")
    early = F.col("production_date") < F.lit(DRIFT_INT_BEFORE)
    late = F.col("production_date") >= F.lit(DRIFT_EXTRA_FROM)
    folder = B.source_path(root, "process_parameters")
    process.filter(early).withColumn("spindle_speed", F.col("spindle_speed").cast("bigint")).write.parquet(f"{folder}/1994-12-31")
    process.filter(late).withColumn("operator_note", F.lit("night shift")).write.parquet(f"{folder}/1997-01-01")
    sinks.load_sources(spark, {**raw, "process_parameters": process.filter(~early & ~late)}, root, FIRST_DAY)
    return build_layers(B.read_all(spark, root)).gold


@register("gold_round_trip", table("mart_part_quality_summary"))
def gold_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold read back after every layer was written to its folder and read from there."""
    typed = {s: B.typed(df, s) for s, df in fixtures.raw_sources(spark, sf_dir).items()}
    return materialize(spark, typed, shared_dir(spark, "partwise-model")).gold


@register("flags_round_trip", table("silver_part_quality_flags"))
def flags_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags table read back after every layer was written."""
    typed = {s: B.typed(df, s) for s, df in fixtures.raw_sources(spark, sf_dir).items()}
    return materialize(spark, typed, shared_dir(spark, "partwise-model")).flags
