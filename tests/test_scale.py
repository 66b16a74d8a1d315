"""Plan properties that matter at scale: hot keys are split or pre-aggregated."""

from __future__ import annotations

import contextlib
import os

from partwise.operators import checks as C
from partwise.operators.material import with_material
from partwise.sources import sinks

HOT_SHARE = 3  # one key holds a third of the rows


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _population(spark, n=30000):
    return spark.range(n).selectExpr(
        "concat('P', id) as part_id",
        "date'2026-06-11' as production_date",
        f"case when id % {HOT_SHARE} = 0 then 'HOT' else concat('B', id % 500) end as batch_id",
    )


def _certs(spark):
    ids = spark.range(500).selectExpr("concat('B', id) as batch_id").union(
        spark.createDataFrame([("HOT",)], "batch_id string")
    )
    return ids.selectExpr(
        "batch_id", "'S' as supplier_id", "200.0 as hardness", "600.0 as tensile_strength",
        "date'2026-06-01' as cert_date", "180.0 as hardness_min_spec", "230.0 as hardness_max_spec",
        "580.0 as tensile_min_spec", "760.0 as tensile_max_spec",
    )


def test_hot_batch_is_split_when_certificates_are_not_broadcast(spark):
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        },
    ):
        out = with_material(_population(spark), _certs(spark), broadcast_limit=0)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30000 and all(r["supplier_id"] == "S" for r in rows)
    assert "SortMergeJoin(skew=true)" in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_checks_aggregate_before_their_shuffles(spark):
    child = _population(spark).select("batch_id")
    parent = _certs(spark).select("batch_id")
    spec = (C.Check("c", "batch_id", C.RELATIONSHIPS, to_model="p", to_field="batch_id"), C.Check("p", "batch_id", C.UNIQUE))
    df = C.run_checks({"c": child, "p": parent}, spec)
    assert _plan(df).count("partial_count") >= 2 and "Join" not in _plan(df)
    assert [r["failures"] for r in df.collect()] == [0, 0]


def test_large_load_is_written_by_several_tasks(spark, scratch):
    from conftest import RAW_DDL, process_row

    frame = spark.createDataFrame([process_row(f"P{i:05d}") for i in range(3000)], RAW_DDL["process_parameters"]).repartition(8)
    with conf(spark, **{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        folder = sinks.write_bronze(frame, "process_parameters", scratch, "2026-06-11")
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    assert len(files) > 1
    ranges = [spark.read.parquet(f"{folder}/{f}").selectExpr("min(part_id)", "max(part_id)").first() for f in files]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_one_scan_and_one_exchange_per_rollup(spark):
    from partwise.plans.layers import from_testdata

    layers = from_testdata(spark, "/root/testdata/sf0.001")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rollup, gold = _plan(layers.cmm_quality), _plan(layers.gold)
    assert rollup.count("FileScan") == 1 and rollup.count("Exchange hashpartitioning") == 1
    assert gold.count("FileScan") == 4


def test_reports_read_gold_once(spark):
    from partwise.plans import reports
    from partwise.plans.layers import from_testdata

    gold = from_testdata(spark, "/root/testdata/sf0.001").gold
    scans = _plan(gold).count("FileScan")
    assert _plan(reports.correlation_matrix(gold)).count("FileScan") <= scans
    assert _plan(reports.filter_options(gold)).count("FileScan") <= scans


def test_broadcast_limit_knows_units(spark):
    from partwise.operators.joins import broadcast_limit

    df = spark.range(1)
    for text, want in (("10MB", 10 << 20), ("1m", 1 << 20), ("512k", 512 << 10), ("-1", 0), ("4096", 4096)):
        with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": text}):
            assert broadcast_limit(df) == want


def test_no_machine_local_folder_on_a_cluster():
    from unittest import mock

    import pytest

    from partwise.session import shared_base

    cluster = mock.MagicMock()
    cluster.conf.get.return_value = None
    context = cluster.sparkContext._jsc.sc.return_value
    context.isLocal.return_value = False
    context.getCheckpointDir.return_value.isDefined.return_value = False
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_base(cluster)


def test_gold_over_bucketed_silver_needs_no_part_shuffle(spark, scratch):
    from conftest import cert_row, cmm_row, frames, process_row, torque_row

    from partwise.operators import mart
    from partwise.plans.layers import build_layers, materialize, typed_sources

    parts = [f"P{i:03d}" for i in range(40)]
    typed = typed_sources(
        frames(
            spark,
            process=[process_row(p, batch="B1" if i % 2 else "B2") for i, p in enumerate(parts)],
            cmm=[cmm_row(p, verdict="FAIL" if i % 7 == 0 else "PASS") for i, p in enumerate(parts)],
            torque=[torque_row(p) for p in parts[:-3]],
            certs=[cert_row("B1"), cert_row("B2", hardness=240.0)],
        )
    )
    stored = materialize(spark, typed, scratch, buckets=4)
    lazy = build_layers(typed)
    assert sorted(map(tuple, stored.gold.collect())) == sorted(map(tuple, lazy.gold.collect()))
    with conf(
        spark,
        **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
    ):
        gold = mart.scored_parts(
            stored.population, stored.cmm_quality, stored.torque_quality, typed["supplier_material_certs"], 0
        )
        plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part_id" not in plan
    assert plan.count("SortMergeJoin") == 3
