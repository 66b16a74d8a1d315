"""Lake queries (registered on import): the daily job, rollups merged from the
states of loads, published builds, and tables by name in the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.plans import incremental
from partwise.plans import layers as L
from partwise.plans.catalog import register
from partwise.plans.daily import run_daily
from partwise.plans.oracle import table, with_models
from partwise.plans.queries_checks import checks_sql
from partwise.plans.reports import default_trace_part
from partwise.session import shared_dir
from partwise.sources import bronze as B
from partwise.sources import fixtures

DAYS = ("2026-06-10", "2026-06-11", "2026-06-12")
GOLD = "mart_part_quality_summary"
_MEASURED = ("cmm_inspection", "torque_audit")

# Measurements by the last digit of their production day, so that most parts have
# rows in several of the three loads.
_LOADS = (
    "substr(production_date, 10, 1) in ('0', '1', '2')",
    "substr(production_date, 10, 1) in ('3', '4', '5', '6')",
    "substr(production_date, 10, 1) in ('7', '8', '9')",
)
# The third load is delivered again without these parts.
_GONE = "part_id like '%5'"
_LEFT = {source: f"not ({_LOADS[2]} and {_GONE})" for source in _MEASURED}


def _three_loads(spark: SparkSession, sf_dir: str) -> str:
    """Root of a lake of three loads: the second came with all verdicts turned round and was run again, the third was
    delivered again without some parts."""
    root, raw = shared_dir(spark, "partwise-lake"), fixtures.raw_sources(spark, sf_dir)
    measured = {s: raw[s] for s in _MEASURED}
    load = lambda n: {s: df.filter(_LOADS[n]) for s, df in measured.items()}
    turned = F.when(F.lower("pass_fail") == "pass", "fail").otherwise("pass")
    others = {s: df for s, df in raw.items() if s not in _MEASURED}
    incremental.land(spark, {**others, **load(0)}, root, DAYS[0])
    incremental.land(spark, {s: df.withColumn("pass_fail", turned) for s, df in load(1).items()}, root, DAYS[1])
    incremental.land(spark, load(2), root, DAYS[2])
    incremental.land(spark, load(1), root, DAYS[1])
    incremental.land(spark, {s: df.filter(f"not ({_GONE})") for s, df in load(2).items()}, root, DAYS[2])
    return root


@register("gold_from_state", table(GOLD, _LEFT))
def gold_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over three loads, one run again and one delivered again, its rollups merged from the states of the loads."""
    root = _three_loads(spark, sf_dir)
    return L.build_layers(B.read_all(spark, root), rolled=incremental.rollups(spark, root)).gold


@register("cmm_rollup_from_state", table("silver_cmm_quality", _LEFT))
def cmm_rollup_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.rollups(spark, _three_loads(spark, sf_dir))["silver_cmm_quality"]


@register("torque_rollup_from_state", table("silver_torque_quality", _LEFT))
def torque_rollup_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.rollups(spark, _three_loads(spark, sf_dir))["silver_torque_quality"]


def _daily(spark: SparkSession, sf_dir: str):
    """Two days of the daily job; the second brings measurements of the first day's parts too."""
    root, raw = shared_dir(spark, "partwise-lake"), fixtures.raw_sources(spark, sf_dir)
    late = F.expr(_LOADS[2])
    first = {s: df.filter(~late) if s in _MEASURED else df for s, df in raw.items()}
    run_daily(spark, first, root, DAYS[0])
    return run_daily(spark, {s: raw[s].filter(late) for s in _MEASURED}, root, DAYS[1])


@register("daily_job_checks", checks_sql(None))
def daily_job_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 90 checks after two runs of the daily job: land, gate, rebuild, check."""
    return _daily(spark, sf_dir).checks


@register("daily_job_gold", table(GOLD))
def daily_job_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after two runs of the daily job."""
    return _daily(spark, sf_dir).layers.gold


def _typed(spark: SparkSession, sf_dir: str, kept: str = "true") -> dict[str, DataFrame]:
    raw = fixtures.raw_sources(spark, sf_dir)
    return {s: B.typed(df.filter(kept) if s in _MEASURED else df, s) for s, df in raw.items()}


def _built_twice(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a model that was built without the third load's measurements, then with them."""
    out_dir = shared_dir(spark, "partwise-model")
    L.materialize(spark, _typed(spark, sf_dir, f"not ({_LOADS[2]})"), out_dir)
    L.materialize(spark, _typed(spark, sf_dir), out_dir)
    return out_dir


@register("gold_published", table(GOLD))
def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the last of two builds, found through the commit log."""
    return L.published(spark, _built_twice(spark, sf_dir))[GOLD]


@register("gold_of_earlier_build", table(GOLD, {s: f"not ({_LOADS[2]})" for s in _MEASURED}))
def gold_of_earlier_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as of the first of two builds, which stays readable."""
    out_dir = _built_twice(spark, sf_dir)
    model = L.Store(spark, out_dir)
    return L.published(spark, out_dir, model.at(model.numbers()[0]))[GOLD]


@register("gold_published_in_order", with_models(f"select * from {GOLD} order by production_date, part_id"))
def gold_published_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published Gold in presentation order, from its files' order alone."""
    out_dir = shared_dir(spark, "partwise-model")
    L.materialize(spark, _typed(spark, sf_dir), out_dir)
    return L.published_in_order(spark, out_dir)


@register(
    "gold_parts_of_a_batch",
    with_models(
        f"select * from {GOLD} where batch_id = (select batch_id from {GOLD} where part_id = "
        f"(select coalesce(min(part_id) filter (where defect_flag), min(part_id)) from {GOLD}))"
    ),
)
def gold_parts_of_a_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows of the parts made of the default part's batch: lookups by part and by batch in written Gold."""
    out_dir = shared_dir(spark, "partwise-model")
    gold = L.materialize(spark, _typed(spark, sf_dir), out_dir).gold
    part = default_trace_part(gold).first()
    batch = gold.filter(F.col("part_id") == (part["part_id"] if part else None)).select("batch_id").first()
    return gold.filter(F.col("batch_id") == F.lit(batch["batch_id"] if batch else None))


@register("gold_by_catalog_name", with_models(f"select defect_root_cause, count(*) as parts, min(composite_quality_score) as least_score, max(production_date) as last_day from {GOLD} group by 1"))
def gold_by_catalog_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL on Gold by its name in the catalog, after its table was saved twice."""
    location = shared_dir(spark, "partwise-tables")
    L.save_tables(spark, L.build_layers(_typed(spark, sf_dir, f"not ({_LOADS[2]})")), location)
    L.save_tables(spark, L.build_layers(_typed(spark, sf_dir)), location)
    return spark.sql("select defect_root_cause, count(*) as parts, min(composite_quality_score) as least_score, max(production_date) as last_day from gold.mart_part_quality_summary group by 1")


@register("silver_by_view_name", with_models("select f.defect_flag, c.any_dimension_out_of_tolerance, count(*) as parts from silver_part_quality_flags f join silver_cmm_quality c using (part_id) group by 1, 2"))
def silver_by_view_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL on Silver by the names of its views."""
    L.register_views(L.build_layers(_typed(spark, sf_dir)))
    return spark.sql("select f.defect_flag, c.any_dimension_out_of_tolerance, count(*) as parts from silver_part_quality_flags f join silver_cmm_quality c using (part_id) group by 1, 2")
