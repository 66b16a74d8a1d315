"""Publishing: failed writes leave the old rows, commits change all entries at once, versions expire; ordered and keyed reads of Gold."""

from __future__ import annotations

import os

import pytest
from conftest import RAW_DDL, cert_row, cmm_row, frames, layers_of, process_row, torque_row

from partwise.plans import layers as L
from partwise.sources import bronze as B
from partwise.sources import sinks
from partwise.sources.publish import Snapshot, Store

GOLD = "mart_part_quality_summary"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _process(spark, parts, day="2026-06-10"):
    return spark.createDataFrame([process_row(p, day=day) for p in parts], RAW_DDL["process_parameters"])


def _parts(df):
    return sorted(r["part_id"] for r in df.collect())


def _failing(df, column):
    """``df``, whose last rows fail to compute when they are written."""
    return df.withColumn(column, df[column]).selectExpr(*[f"if(part_id = 'Z9', cast(raise_error('cut off') as string), {c}) as {c}" if c == column else c for c in df.columns])


def test_failed_load_leaves_the_old_day(spark, scratch):
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["A", "B"])}, scratch, "2026-06-10")
    certs = spark.createDataFrame([cert_row()], RAW_DDL["supplier_material_certs"])
    sinks.load_sources(spark, {"supplier_material_certs": certs}, scratch, "2026-06-10")
    broken = _failing(_process(spark, ["C", "D", "Z9"]).repartition(3), "shift")
    with pytest.raises(Exception, match="cut off"):
        # The certificates are written whole before the process log fails; neither becomes current.
        sinks.load_sources(spark, {"supplier_material_certs": certs.filter("false"), "process_parameters": broken}, scratch, "2026-06-10")
    assert _parts(B.read_bronze(spark, scratch, "process_parameters")) == ["A", "B"]
    assert B.read_bronze(spark, scratch, "supplier_material_certs").count() == 1
    lake = B.store(spark, scratch)
    left = lake.orphans()
    assert len(left) >= 1 and all("version=" in f for f in left)
    lake.remove(left)
    assert lake.orphans() == [] and _parts(B.read_bronze(spark, scratch, "process_parameters")) == ["A", "B"]
    with pytest.raises(ValueError):
        lake.remove([lake.current().entries[B.load_entry("process_parameters", "2026-06-10")]["path"]])


def test_first_load_that_fails_is_not_there(spark, scratch):
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["A"])}, scratch, "2026-06-09")
    with pytest.raises(Exception, match="cut off"):
        sinks.load_sources(spark, {"process_parameters": _failing(_process(spark, ["Z9"]), "shift")}, scratch, "2026-06-10")
    assert _parts(B.read_bronze(spark, scratch, "process_parameters")) == ["A"]


def test_manifest_comes_from_the_commit_and_stays(spark, scratch):
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["A", "B"]).repartition(4)}, scratch, "2026-06-10")
    sinks.load_sources(spark, {"process_parameters": _process(spark, [])}, scratch, "2026-06-11")
    again = spark.newSession()
    df = sinks.manifest(again, scratch)
    assert "Scan parquet" not in _plan(df) and "FileScan" not in _plan(df)
    assert [(str(r.load_day), r.rows) for r in df.collect()] == [("2026-06-10", 2), ("2026-06-11", 0)]


def test_days_landed_without_a_commit_log_are_read(spark, scratch):
    B.declared(_process(spark, ["old"]), "process_parameters").write.parquet(f"{scratch}/bronze/process_parameters/load_day=2026-06-08")
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["new"])}, scratch, "2026-06-10")
    assert _parts(B.read_bronze(spark, scratch, "process_parameters")) == ["new", "old"]
    sinks.load_sources(spark, {"process_parameters": _process(spark, ["again"])}, scratch, "2026-06-08")
    assert _parts(B.read_bronze(spark, scratch, "process_parameters")) == ["again", "new"]


def test_versions_are_listed_kept_and_expire(spark, scratch):
    store = Store(spark, scratch)
    folders = []
    for n in range(4):
        folders.append(store.fresh("a/b"))
        spark.range(n + 1).write.parquet(f"{scratch}/{folders[-1]}")
        store.commit({"a/b": {"path": folders[-1]}, "c": None if n == 3 else {"path": "c/version=x"}})
    assert store.numbers() == [1, 2, 3, 4] and set(store.current().entries) == {"a/b"}
    assert spark.read.parquet(store.path("a/b", store.at(2))).count() == 2
    assert store.expire(keep=2) == sorted(folders[:2])
    assert store.numbers() == [3, 4] and not os.path.exists(f"{scratch}/{folders[0]}") and os.path.exists(f"{scratch}/{folders[2]}")
    with pytest.raises(KeyError):
        store.at(1)
    assert spark.read.parquet(store.path("a/b")).count() == 4


def test_two_writers_and_a_cut_off_commit(spark, scratch, monkeypatch):
    store, other = Store(spark, scratch), Store(spark, scratch)
    real, seen = Store._create, []

    def create(self, snapshot: Snapshot):
        if not seen:  # another writer commits in between
            seen.append(snapshot.number)
            other.commit({"y": {"path": "y/version=1"}})
        return real(self, snapshot)

    monkeypatch.setattr(Store, "_create", create)
    done = store.commit({"x": {"path": "x/version=1"}})
    assert seen == [1] and done.number == 2 and set(store.current().entries) == {"x", "y"}
    with open(f"{scratch}/_commits/{3:012d}.json", "w") as f:
        f.write('{"number": 3, "ent')
    assert store.current().number == 2
    assert store.commit({"z": {"path": "z/version=1"}}).number == 4
    assert set(store.current().entries) == {"x", "y", "z"}


def _typed(spark, parts, verdict="PASS"):
    return L.typed_sources(
        frames(
            spark,
            process=[process_row(p, day=f"2026-06-{10 + i % 9:02d}" if i else None, batch=f"B{i % 7}") for i, p in enumerate(parts)],
            cmm=[cmm_row(p, verdict=verdict) for p in parts],
            torque=[torque_row(p) for p in parts],
            certs=[cert_row(f"B{i}") for i in range(7)],
        )
    )


def test_readers_see_one_build(spark, scratch, monkeypatch):
    """A rebuild that fails after Silver is written, and one that goes through."""
    L.materialize(spark, _typed(spark, ["P1", "P2"]), scratch)
    assert {n: df.count() for n, df in L.published(spark, scratch).items()}[GOLD] == 2

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(L.mart, "part_quality_summary", fails)
        with pytest.raises(RuntimeError, match="lost"):
            L.materialize(spark, _typed(spark, ["P1", "P2", "P3"]), scratch)
    held = L.published(spark, scratch)
    assert {held[n].count() for n in ("silver_part_population", "silver_cmm_quality", GOLD)} == {2}
    before = Store(spark, scratch).current()
    L.materialize(spark, _typed(spark, ["P1", "P2", "P3"], "FAIL"), scratch)
    now = L.published(spark, scratch)
    assert len(now) == 6 and {df.count() for df in now.values()} == {3}
    assert L.published(spark, scratch, before)[GOLD].count() == 2  # the build before stays
    L.materialize(spark, _typed(spark, ["P1"]), scratch)
    assert Store(spark, scratch).numbers()[0] > before.number


def test_saved_tables_are_switched(spark, scratch, monkeypatch):
    make = lambda *parts: layers_of(spark, process=[process_row(p) for p in parts], cmm=[cmm_row(p) for p in parts], torque=[], certs=[cert_row()])
    L.save_tables(spark, make("P1"), scratch)
    L.save_tables(spark, make("P1", "P2"), scratch)
    assert spark.table("gold.mart_part_quality_summary").count() == 2 and spark.sql("select * from silver.silver_cmm_quality").count() == 2
    broken = make("P1", "P2", "Z9")
    broken.gold = _failing(broken.gold, "shift")
    with pytest.raises(Exception, match="cut off"):
        L.save_tables(spark, broken, scratch)
    assert spark.table("silver.silver_cmm_quality").count() == 2 and spark.table(f"gold.{GOLD}").count() == 2


def test_bucketed_tables_are_rebuilt(spark, scratch):
    for parts in (["P1"], ["P1", "P2", "P3"], ["P2"]):
        stored = L.materialize(spark, _typed(spark, parts), scratch, buckets=3, keep=1)
        assert _parts(stored.gold) == parts and _parts(spark.table("silver.silver_cmm_quality")) == parts
        spec = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended silver.silver_cmm_quality").collect()}
        assert spec["Num Buckets"] == "3"
    versions = [t.name for t in spark.catalog.listTables("silver") if t.name.startswith("silver_cmm_quality__")]
    assert len(versions) == 1


def test_ordered_read_has_no_exchange(spark, scratch, monkeypatch):
    parts = [f"P{(i * 37) % 101:03d}" for i in range(101)]
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        L.materialize(spark, _typed(spark, parts), scratch)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    files = Store(spark, scratch).current().entries[f"gold/{GOLD}"]["files"]
    df = L.published_in_order(spark, scratch)
    assert len(files) > 1 and "Exchange" not in _plan(df) and "Sort" not in _plan(df)
    rows = [(r.production_date is None, r.production_date, r.part_id) for r in df.collect()]
    assert len(rows) == 101 and rows == sorted(rows, key=lambda r: (r[0], str(r[1]), r[2])) and rows[-1][0]
    monkeypatch.setattr(L, "ORDERED_FILES", 1)
    L.materialize(spark, _typed(spark, parts), scratch)
    again = [(r.production_date is None, r.production_date, r.part_id) for r in L.published_in_order(spark, scratch).collect()]
    assert again == rows


def scanned(df) -> int:
    """Rows that the file scans of ``df`` gave, after its row groups were chosen."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_lookups_skip_row_groups(spark, scratch):
    """Every file holds parts of all names, so only the filters tell which one has a part."""
    parts = [f"P{(i * 7919) % 4001:05d}" for i in range(4000)]
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        gold = L.materialize(spark, _typed(spark, parts), scratch).gold
        plain = f"{scratch}/plain"
        gold.repartitionByRange(*L.GOLD_ORDER).sortWithinPartitions(*L.GOLD_ORDER).write.parquet(plain)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    with_filter, without = scanned(gold.filter("part_id = 'P01234'")), scanned(spark.read.parquet(plain).filter("part_id = 'P01234'"))
    assert 0 < with_filter <= 1100 and without > 2 * with_filter
    assert scanned(gold.filter("part_id = 'P01234x'")) == 0


def test_root_from_argument_configuration_and_default(spark, scratch):
    from partwise.session import DEFAULT_ROOT, ROOT_CONF, lake_root

    assert lake_root(spark) == DEFAULT_ROOT and lake_root(spark, "/x/") == "/x"
    spark.conf.set(ROOT_CONF, scratch)
    try:
        assert lake_root(spark) == scratch and lake_root(spark, "/x") == "/x"
        sinks.load_sources(spark, {"process_parameters": _process(spark, ["A"])}, None, "2026-06-10")
        assert _parts(B.read_bronze(spark, None, "process_parameters")) == ["A"]
        assert sinks.manifest(spark, None).count() == 1
    finally:
        spark.conf.unset(ROOT_CONF)
    assert os.path.isdir(f"{scratch}/bronze/process_parameters")
