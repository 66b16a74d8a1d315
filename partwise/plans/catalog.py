"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every query reads the benchmark tables of ``sf_dir`` in full, derives the four
sources from them and runs the model; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partwise.plans import layers as L
from partwise.plans import oracle as O
from partwise.sources.schemas import BRONZE_MODEL

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load() -> None:
    # Report, check and verdict queries register themselves on import.
    from partwise.plans import queries_checks, queries_lake, queries_load, queries_reports  # noqa: F401


def _model_query(model: str, pick: Callable[[L.Layers], DataFrame]) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pick(L.from_testdata(spark, sf_dir))

    register(model_alias(model), O.table(model))(build)


def model_alias(model: str) -> str:
    return {
        "bronze_process_parameters": "bronze_process",
        "bronze_cmm_inspection": "bronze_cmm",
        "bronze_torque_audit": "bronze_torque",
        "bronze_supplier_material_certs": "bronze_certs",
        "silver_part_population": "part_population",
        "silver_cmm_quality": "cmm_rollup",
        "silver_torque_quality": "torque_rollup",
        "silver_material_quality": "material_quality",
        "silver_part_quality_flags": "quality_flags",
        "mart_part_quality_summary": "part_quality_summary",
    }[model]


for _source, _model in BRONZE_MODEL.items():
    _model_query(_model, lambda layers, s=_source: layers.bronze[s])
_model_query("silver_part_population", lambda layers: layers.population)
_model_query("silver_cmm_quality", lambda layers: layers.cmm_quality)
_model_query("silver_torque_quality", lambda layers: layers.torque_quality)
_model_query("silver_material_quality", lambda layers: layers.material_quality)
_model_query("silver_part_quality_flags", lambda layers: layers.flags)
_model_query("mart_part_quality_summary", lambda layers: layers.gold)
