"""Tasks stay the same size as the input grows, nothing is computed twice, and independent writes run together."""

from __future__ import annotations

import threading

from conftest import SF_SMALL, cert_row, cmm_row, layers_of, process_row, torque_row
from test_scale import conf

from partwise.operators import checks as C
from partwise.plans import incremental, queries_checks
from partwise.plans import layers as L
from partwise.sources import fixtures, sinks

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCAN, SHUFFLE = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_shuffles_grow_with_the_input(spark, monkeypatch):
    with conf(spark, **{INITIAL: "4", SCAN: "128m", SHUFFLE: "64m"}):
        monkeypatch.setattr(fixtures, "estimated_bytes", lambda df: 1 << 30)
        assert set(fixtures.raw_sources(spark, SF_SMALL)) == set(fixtures.FIXTURES)
        assert int(spark.conf.get(INITIAL)) == 1024  # four tables of 1 GB, 4 MB a partition
        assert int(spark.conf.get(SCAN)) <= 16 << 20 and int(spark.conf.get(SHUFFLE)) <= 16 << 20
        spark.conf.set(SHUFFLE, "1m")  # a session that asks for smaller tasks keeps them
        monkeypatch.setattr(fixtures, "estimated_bytes", lambda df: 10)
        fixtures.raw_sources(spark, SF_SMALL)
        assert spark.conf.get(SHUFFLE) == "1m" and spark.conf.get(INITIAL) == spark.conf.get("spark.sql.shuffle.partitions")


def test_key_checks_start_from_many_partitions(spark, monkeypatch):
    with conf(spark, **{INITIAL: "4", SCAN: "128m", SHUFFLE: "64m"}):
        monkeypatch.setattr(fixtures, "estimated_bytes", lambda df: 50 << 20)
        for kind in (C.UNIQUE, C.RELATIONSHIPS):
            checks = C.run_checks(queries_checks.from_testdata(spark, SF_SMALL).tables(), kinds=(kind,))
            assert "hashpartitioning(domain#" in (plan := checks._jdf.queryExecution().executedPlan().toString()) and ", 50)" in plan


def _small(spark):
    return layers_of(
        spark,
        process=[process_row("P1"), process_row("P1"), process_row("P2", batch="none"), process_row(None)],
        cmm=[cmm_row("P1", verdict="FAIL"), cmm_row("P2"), cmm_row(None)],
        torque=[torque_row("P1"), torque_row("P2", verdict="FAIL")],
        certs=[cert_row(), cert_row("B2")],
    )


def test_saved_gold_is_made_of_saved_silver(spark, scratch, monkeypatch):
    layers, read = _small(spark), []
    want = {n: sorted(map(str, df.collect())) for n, df in layers.tables().items() if not n.startswith("bronze")}
    scored = L.mart.scored_parts
    monkeypatch.setattr(L.mart, "scored_parts", lambda *a: read.extend(f for df in a[:3] for f in df.inputFiles()) or scored(*a))
    names = L.save_tables(spark, layers, scratch)
    assert read and all(scratch in f for f in read)
    assert {n.split(".")[1]: sorted(map(str, spark.table(n).collect())) for n in names} == want


def test_sources_and_states_are_written_together(spark, scratch, monkeypatch):
    meet = threading.Barrier(2, timeout=20)
    write, partial = sinks._write, incremental.partial
    monkeypatch.setattr(sinks, "_write", lambda *a: meet.wait() is None or write(*a))
    monkeypatch.setattr(incremental, "partial", lambda *a: meet.wait() is None or partial(*a))
    raw = {s: df.limit(3) for s, df in fixtures.raw_sources(spark, SF_SMALL).items() if s in ("cmm_inspection", "torque_audit")}
    assert {r.source: r.rows for r in incremental.land(spark, raw, scratch, "2026-06-11").collect()} == dict.fromkeys(raw, 3)
