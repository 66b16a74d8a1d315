"""Rollups merged from the states of loads: equal to the full rebuild, and only the day's measurements are read."""

from __future__ import annotations

import random

from conftest import RAW_DDL, cmm_row, process_row, torque_row

from partwise.operators import rollups
from partwise.operators.state import measures, merged, partial
from partwise.plans import incremental
from partwise.sources import bronze as B
from partwise.sources import sinks

SOURCES = ("cmm_inspection", "torque_audit")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def _rows(rng, n):
    verdict = lambda: rng.choice(["PASS", "FAIL", "fail", None, "x"])
    part = lambda: rng.choice(["P1", "P2", "P3", None, *[f"Q{i}" for i in range(9)]])
    cmm = [cmm_row(part(), rng.choice(["bore", "face", "é", None]), rng.choice([50.0, 50.02, 51.0]), rng.choice([0.03, 0.0]), verdict()) for _ in range(n)]
    torque = [torque_row(part()) for _ in range(n)]
    return cmm, torque


def _frames(spark, rows):
    return {s: spark.createDataFrame(r, RAW_DDL[s]) for s, r in zip(SOURCES, rows)}


def _same(spark, root):
    found = incremental.rollups(spark, root)
    full = {"silver_cmm_quality": rollups.cmm_rollup, "silver_torque_quality": rollups.torque_rollup}
    for source, measure in measures().items():
        want = full[measure.model](B.read_bronze(spark, root, source))
        assert found[measure.model].schema.names == want.schema.names
        assert sorted(map(repr, found[measure.model].collect())) == sorted(map(repr, want.collect()))


def test_loads_reruns_and_redeliveries(spark, scratch):
    rng = random.Random(1)
    loads = [_rows(rng, 40) for _ in range(3)]
    for day, rows in zip(("2026-06-10", "2026-06-11", "2026-06-12"), loads):
        incremental.land(spark, _frames(spark, rows), scratch, day)
    _same(spark, scratch)
    incremental.land(spark, _frames(spark, _rows(rng, 30)), scratch, "2026-06-11")  # run again
    incremental.land(spark, _frames(spark, [[r for r in rows if r[2] != "P1"] for rows in loads[2]]), scratch, "2026-06-12")  # without a part
    _same(spark, scratch)
    incremental.land(spark, _frames(spark, ([], [])), scratch, "2026-06-10")
    _same(spark, scratch)


def test_loads_without_state_and_foreign_files_count(spark, scratch):
    rng = random.Random(2)
    incremental.land(spark, _frames(spark, _rows(rng, 20)), scratch, "2026-06-10")
    sinks.load_sources(spark, _frames(spark, _rows(rng, 20)), scratch, "2026-06-11")  # no state
    sinks.load_sources(spark, _frames(spark, _rows(rng, 20)), scratch, "2026-06-10")  # its state is of the version before
    B.declared(_frames(spark, _rows(rng, 20))["cmm_inspection"], "cmm_inspection").write.parquet(f"{scratch}/bronze/cmm_inspection/2026-06-01")
    _same(spark, scratch)


def test_only_states_are_read(spark, scratch):
    rng = random.Random(3)
    for day in ("2026-06-10", "2026-06-11"):
        incremental.land(spark, _frames(spark, _rows(rng, 20)), scratch, day)
    for df in incremental.rollups(spark, scratch).values():
        plan = _plan(df)
        assert f"{scratch}/state/" in plan and f"{scratch}/bronze/" not in plan


def test_state_of_parts_is_state_of_all(spark):
    """Any split of the rows merges to the same rollup."""
    rng = random.Random(4)
    cmm, _ = _rows(rng, 200)
    df = B.typed(spark.createDataFrame(cmm, RAW_DDL["cmm_inspection"]), "cmm_inspection")
    measure = measures()["cmm_inspection"]
    whole = sorted(map(repr, rollups.cmm_rollup(df).collect()))
    for parts in (1, 2, 7):
        split = None
        for n in range(parts):
            one = partial(df.filter(f"pmod(hash(part_id, measured_value, pass_fail), {parts}) = {n}"), measure)
            split = one if split is None else split.unionByName(one)
        assert sorted(map(repr, merged(split, measure).collect())) == whole


def test_the_daily_job_reads_no_other_days_measurements(spark, scratch, monkeypatch):
    from conftest import cert_row

    from partwise.plans import daily

    plans = []
    real = daily.materialize

    def watched(session, typed, out_dir, rolled=None, **more):
        plans.extend(_plan(df) for df in rolled.values())
        return real(session, typed, out_dir, rolled=rolled, **more)

    monkeypatch.setattr(daily, "materialize", watched)
    for day, part in (("2026-06-10", "A"), ("2026-06-11", "B")):
        frames = {
            "process_parameters": [process_row(part, day=day)],
            "cmm_inspection": [cmm_row(part, verdict="FAIL" if part == "B" else "PASS")],
            "torque_audit": [torque_row("A"), torque_row(part)],
            "supplier_material_certs": [cert_row()] if part == "A" else [],
        }
        run = daily.run_daily(spark, {s: spark.createDataFrame(r, RAW_DDL[s]) for s, r in frames.items()}, scratch, day)
    assert len(plans) == 4 and not any("/bronze/" in p for p in plans)
    got = {r.part_id: (r.audited_joint_count, r.defect_root_cause) for r in run.layers.gold.collect()}
    assert got == {"A": (3, "none"), "B": (1, "dimension")}
