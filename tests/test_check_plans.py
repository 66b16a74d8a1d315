"""The declared checks read each table once, with the same rows as table by table and key by key."""

from __future__ import annotations

from conftest import cert_row, cmm_row, layers_of, process_row, torque_row

from partwise.operators import checks as C


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _layers(spark):
    return layers_of(
        spark,
        process=[process_row("P1"), process_row("P1", batch="none"), process_row(None), process_row("P2", batch=None, coolant=99.0), process_row("P3", feed=None)],
        cmm=[cmm_row("P1"), cmm_row("P9", verdict="odd"), cmm_row("P9", verdict="odder"), cmm_row(None, verdict="odd"), cmm_row("P2", measured=-1.0)],
        torque=[torque_row("P1"), torque_row("P1", "J2", angle=1.0), torque_row("P7", verdict=None)],
        certs=[cert_row(), cert_row(), cert_row(None), cert_row("B2", hardness=1.0)],
    )


def test_suite_is_the_union_of_its_kinds(spark):
    tables = _layers(spark).tables()
    whole = {r.position: tuple(r) for r in C.run_checks(tables).collect()}
    assert sorted(whole) == list(range(1, 91))
    apart = {}
    for kind in C.KINDS:
        apart |= {r.position: tuple(r) for r in C.run_checks(tables, kinds=(kind,)).collect()}
    assert whole == apart
    failed = {r[4]: (r[5], r[6]) for r in whole.values() if r[5]}
    assert failed["unique__bronze_process_parameters__part_id"] == (1, 2)
    assert failed["unique__bronze_supplier_material_certs__batch_id"] == (1, 2)
    assert failed["accepted_values__bronze_cmm_inspection__pass_fail"] == (2, 3)
    assert failed["relationships__bronze_cmm_inspection__part_id__bronze_process_parameters.part_id"] == (2, 2)
    assert failed["relationships__bronze_process_parameters__batch_id__bronze_supplier_material_certs.batch_id"] == (1, 1)
    assert failed["not_null__bronze_cmm_inspection__part_id"] == (1, 1)
    assert failed["measurement_between__bronze_process_parameters__feed_rate"] == (1, 1)


def test_suite_over_empty_tables(spark):
    tables = {n: df.limit(0) for n, df in _layers(spark).tables().items()}
    rows = C.run_checks(tables).collect()
    assert len(rows) == 90 and all((r.failures, r.failing_rows, r.status) == (0, 0, "pass") for r in rows)


def test_ten_scans(spark, scratch):
    from partwise.plans.layers import materialize
    from partwise.plans.layers import typed_sources as typed
    from partwise.sources.fixtures import raw_sources

    stored = materialize(spark, typed(raw_sources(spark, "/root/testdata/sf0.001")), scratch)
    plan = _plan(C.run_checks(stored.tables()))
    assert plan.count("FileScan parquet") == 10
    # Counts are taken before the rows of a table are shuffled.
    assert plan.count("partial_count") >= 10
