"""The daily job: land a day's extracts, rebuild the model, run the checks."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from partwise.operators import checks
from partwise.plans import incremental
from partwise.plans.layers import Layers, materialize
from partwise.session import lake_root
from partwise.sources import bronze
from partwise.sources.schemas import BRONZE_MODEL


@dataclass
class DailyRun:
    manifest: DataFrame  # (source, load_day, rows, relative_path)
    layers: Layers  # Silver and Gold read from their written tables
    checks: DataFrame  # one row per declared check


def run_daily(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    root: str | None,
    load_day: dt.date | str,
    model_dir: str | None = None,
    gate_keys: bool = True,
) -> DailyRun:
    """Land ``frames`` as the load of ``load_day`` (a rerun of the day replaces
    it), stop on duplicate part or batch keys, rebuild Silver and Gold over all
    loads and run the 90 checks on the written tables.

    The rebuild aggregates the day's own measurements only: the rollups are
    merged from the states of the loads. What it reads of other days are the
    process log and certificates, one row a part and batch; the checks, which
    are declared on Bronze too, read it once.
    """
    root = lake_root(spark, root)
    manifest = incremental.land(spark, frames, root, load_day)
    typed = bronze.read_all(spark, root)
    if gate_keys:
        checks.assert_unique_keys({BRONZE_MODEL[s]: df for s, df in typed.items()})
    layers = materialize(spark, typed, model_dir or f"{root}/model", rolled=incremental.rollups(spark, root))
    return DailyRun(manifest=manifest, layers=layers, checks=checks.run_checks(layers.tables()))
