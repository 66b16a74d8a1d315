"""The Bronze -> Silver -> Gold model as lazy DataFrames.

``build_layers`` wires the operators together; nothing runs until an action.
``materialize`` writes Silver and Gold (full refresh, one folder per model,
folder = layer) and returns layers that read the written tables, which also
cuts the lineage before reports and checks reuse them. All tables of a build
become current in one commit (:mod:`partwise.sources.publish`): until then, and
if the build fails, ``published`` reads those of the build before.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partwise.operators import mart, material, rollups
from partwise.operators.joins import union_all
from partwise.sources import bronze as B
from partwise.sources import fixtures
from partwise.sources.publish import Snapshot, Store
from partwise.sources.schemas import BRONZE_MODEL, SOURCES

SILVER_MODELS = (
    "silver_part_population",
    "silver_cmm_quality",
    "silver_torque_quality",
    "silver_material_quality",
    "silver_part_quality_flags",
)
GOLD_MODELS = ("mart_part_quality_summary",)
# Part-grain Silver tables that Gold joins on part_id.
BUCKETED_MODELS = ("silver_part_population", "silver_cmm_quality", "silver_torque_quality")


@dataclass
class Layers:
    bronze: dict[str, DataFrame]
    population: DataFrame
    cmm_quality: DataFrame
    torque_quality: DataFrame
    material_quality: DataFrame
    scored: DataFrame
    #: ``scored`` over given population and rollups, where it is made of this model's own.
    rescored: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] | None = None
    flags: DataFrame = field(init=False)
    gold: DataFrame = field(init=False)

    def __post_init__(self) -> None:
        self.flags = mart.quality_flags(self.scored)
        self.gold = self._made = mart.part_quality_summary(self.scored)

    def gold_over(self, population: DataFrame, cmm_quality: DataFrame, torque_quality: DataFrame) -> DataFrame:
        """Gold over written tables of the same rows, so that nothing is computed again; one put in its place stays."""
        if self.rescored is None or self.gold is not self._made:
            return self.gold
        return mart.part_quality_summary(self.rescored(population, cmm_quality, torque_quality))

    def tables(self) -> dict[str, DataFrame]:
        """Every model by its layer name."""
        out = {BRONZE_MODEL[s]: self.bronze[s] for s in SOURCES}
        out.update(
            {
                "silver_part_population": self.population,
                "silver_cmm_quality": self.cmm_quality,
                "silver_torque_quality": self.torque_quality,
                "silver_material_quality": self.material_quality,
                "silver_part_quality_flags": self.flags,
                "mart_part_quality_summary": self.gold,
            }
        )
        return out


def build_layers(typed_sources: dict[str, DataFrame], broadcast_limit: int | None = None, rolled: dict[str, DataFrame] | None = None) -> Layers:
    """The model over typed sources; ``rolled`` are measurement rollups that are at hand, by model name."""
    process = typed_sources["process_parameters"]
    certs = typed_sources["supplier_material_certs"]
    population = rollups.part_population(process)
    rolled = rolled or {}
    cmm_q = rolled.get("silver_cmm_quality", rollups.cmm_rollup(typed_sources["cmm_inspection"]))
    torque_q = rolled.get("silver_torque_quality", rollups.torque_rollup(typed_sources["torque_audit"]))
    return Layers(
        bronze=dict(typed_sources),
        population=population,
        cmm_quality=cmm_q,
        torque_quality=torque_q,
        material_quality=material.material_quality(population, certs, broadcast_limit),
        scored=mart.scored_parts(population, cmm_q, torque_q, certs, broadcast_limit),
        rescored=lambda *written: mart.scored_parts(*written, certs, broadcast_limit),
    )


def typed_sources(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: B.typed(df, name) for name, df in raw.items()}


def from_testdata(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers over the four sources derived from the benchmark tables."""
    return build_layers(typed_sources(fixtures.raw_sources(spark, sf_dir)))


def from_bronze(spark: SparkSession, root: str) -> Layers:
    """Layers over a Bronze folder tree of daily extracts."""
    return build_layers(B.read_all(spark, root))


#: Gold's order, in files and for presentation: by day and part, NULLs last.
GOLD_ORDER = ("production_date", "part_id")
#: Lookups by part or batch skip Gold files and row groups that the filters rule out; their min and max say little there, as
#: every day has parts and batches of all names.
GOLD_OPTIONS = {
    "parquet.bloom.filter.enabled#part_id": "true",
    "parquet.bloom.filter.enabled#batch_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
#: Most files whose order is noted with Gold, and that an ordered read unites.
ORDERED_FILES = 512


def entry_of(model: str) -> str:
    return f"{layer_of(model)}/{model}"


def _point(spark: SparkSession, name: str, path: str, buckets: int | None, columns: str) -> None:
    """Make a catalog table read ``path``: its location is switched; one of another shape is made anew."""
    clustered = f"clustered by (part_id) sorted by (part_id) into {buckets} buckets" if buckets else ""
    shape = {"partwise.shape": f"{columns} {clustered}".strip()}
    if spark.catalog.tableExists(name):
        held = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {name}").collect()}
        if held.get("partwise.shape") == shape["partwise.shape"]:
            spark.sql(f"alter table {name} set location '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"drop table {name}")
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in shape.items())
    spark.sql(f"create table {name} ({columns}) using parquet {clustered} tblproperties ({properties}) location '{path}'")


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _write_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Bucketed files in ``path``, as the catalog table of that name."""
    df.write.format("parquet").option("path", path).bucketBy(buckets, "part_id").sortBy("part_id").saveAsTable(table)
    return df.sparkSession.table(table)


def _version(name: str, folder: str) -> str:
    """The catalog table of one version of a bucketed model."""
    return f"{layer_of(name)}.{name}__{folder.rsplit('=', 1)[-1]}"


def _file_order(df: DataFrame) -> list[dict] | None:
    """Names of Gold's files in the order of their rows; None if there are too many, or their ranges meet."""
    key = F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")) for c in GOLD_ORDER])
    ranges = df.groupBy(F.input_file_name().alias("file")).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    found = ranges.orderBy("first", "last").limit(ORDERED_FILES + 1).withColumn("before", F.lag("last").over(Window.orderBy("first", "last")))
    rows = found.select("file", (F.col("before") <= F.col("first")).alias("apart")).collect()
    if len(rows) > ORDERED_FILES or not all(r["apart"] in (None, True) for r in rows):
        return None
    return [r["file"].rsplit("/", 1)[1] for r in rows]


def _written(
    write: Callable[..., DataFrame],
    silver: tuple[DataFrame, DataFrame, DataFrame],
    material_over: Callable[[DataFrame], DataFrame],
    gold_over: Callable[[DataFrame, DataFrame, DataFrame], DataFrame],
    flags_of: Callable[[DataFrame], DataFrame] = mart.quality_flags,
) -> tuple[DataFrame, ...]:
    """Silver, Gold and flags, each computed once: Gold from written Silver tables, the flags from written Gold."""
    # The first three read disjoint sources, and the next two written tables: jobs
    # are submitted together so small stages share the executors instead of queueing.
    with ThreadPoolExecutor(max_workers=3) as pool:
        population, cmm_q, torque_q = pool.map(write, BUCKETED_MODELS, silver)
        material_q = pool.submit(write, "silver_material_quality", material_over(population))
        gold = write(GOLD_MODELS[0], gold_over(population, cmm_q, torque_q), GOLD_OPTIONS)
        flags = write("silver_part_quality_flags", flags_of(gold))
        return population, cmm_q, torque_q, material_q.result(), gold, flags


def materialize(
    spark: SparkSession,
    typed: dict[str, DataFrame],
    out_dir: str,
    broadcast_limit: int | None = None,
    buckets: int | None = None,
    rolled: dict[str, DataFrame] | None = None,
    keep: int = 2,
) -> Layers:
    """Build and write Silver and Gold (full refresh) in dependency order, and publish them at once.

    Each Silver table is computed once and written; Gold is built from the
    written Silver tables and the flags from written Gold, so no layer is
    recomputed and every layer boundary cuts the lineage (a lost executor
    recomputes from the last written layer, not from the sources). Gold is
    sorted by (production_date, part_id) over all its files so date filters
    skip files, and has bloom filters for lookups of parts and batches.

    Every table goes to a fresh folder; one commit makes all of them current,
    and ``keep`` builds stay readable. ``rolled`` are measurement rollups that are
    at hand (by model name), as :func:`partwise.plans.incremental.rollups` makes them.

    With ``buckets`` the part-grain Silver tables are catalog tables as well
    (database ``silver``), bucketed and sorted by ``part_id`` into that many
    buckets; Gold's joins then read them without any shuffle.
    """
    model = Store(spark, out_dir)
    folders: dict[str, str] = {}
    columns: dict[str, str] = {}
    if buckets:
        spark.sql("create database if not exists silver")

    def write(name: str, df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
        folders[name] = model.fresh(entry_of(name))
        path = f"{model.base}/{folders[name]}"
        if buckets and name in BUCKETED_MODELS:
            columns[name] = _columns(df)
            return _write_bucketed(df, _version(name, path), path, buckets)
        df.write.options(**(options or {})).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    certs = typed["supplier_material_certs"]
    rolled = rolled or {}
    order = [F.asc_nulls_last(c) for c in GOLD_ORDER]
    population, cmm_q, torque_q, material_q, gold, flags = _written(
        write,
        (
            rollups.part_population(typed["process_parameters"]),
            rolled.get("silver_cmm_quality", rollups.cmm_rollup(typed["cmm_inspection"])),
            rolled.get("silver_torque_quality", rollups.torque_rollup(typed["torque_audit"])),
        ),
        lambda parts: material.material_quality(parts, certs, broadcast_limit),
        lambda *written: mart.part_quality_summary(mart.scored_parts(*written, certs, broadcast_limit))
        # Files hold ranges of days, so date filters skip files and row groups.
        .repartitionByRange(*order)
        .sortWithinPartitions(*order),
    )
    records: dict[str, dict] = {entry_of(name): {"path": folder} for name, folder in folders.items()}
    if (files := _file_order(gold)) is not None:
        records[entry_of("mart_part_quality_summary")]["files"] = files
    model.commit(records)
    gone = model.expire(keep)
    if buckets:
        for name in BUCKETED_MODELS:
            _point(spark, f"{layer_of(name)}.{name}", f"{model.base}/{folders[name]}", buckets, columns[name])
            for folder in gone:
                if folder.startswith(f"{entry_of(name)}/"):
                    spark.sql(f"drop table if exists {_version(name, folder)}")
    stored = Layers(
        bronze=dict(typed),
        population=population,
        cmm_quality=cmm_q,
        torque_quality=torque_q,
        material_quality=material_q,
        scored=gold,
    )
    stored.flags = flags
    return stored


def published(spark: SparkSession, out_dir: str, snapshot: Snapshot | None = None) -> dict[str, DataFrame]:
    """The Silver and Gold tables of the last whole build, or as of a commit, by model name."""
    model = Store(spark, out_dir)
    now = snapshot or model.current()
    return {entry.rsplit("/", 1)[1]: spark.read.parquet(f"{model.base}/{r['path']}") for entry, r in now.entries.items()}


def published_in_order(spark: SparkSession, out_dir: str) -> DataFrame:
    """Published Gold by production_date and part_id, NULLs last.

    The files' ranges are apart and their order is noted with them, so they are
    read one after the other, without an exchange; where it is not noted (over
    ORDERED_FILES files), by a sort.
    """
    model = Store(spark, out_dir)
    record = model.current().entries[entry_of("mart_part_quality_summary")]
    path = f"{model.base}/{record['path']}"
    whole = spark.read.parquet(path)
    if "files" not in record:
        return whole.orderBy(*[F.asc_nulls_last(c) for c in GOLD_ORDER])
    # One file's scan has its parts in order; a union keeps the order of its sides.
    return union_all([spark.read.schema(whole.schema).parquet(f"{path}/{name}") for name in record["files"]]) if record["files"] else whole


def register_views(layers: Layers, prefix: str = "") -> list[str]:
    """Temp views named after the models (Bronze views over the sources,
    Silver and Gold over whatever the layers hold), for SQL access such as
    ``spark.sql("select * from mart_part_quality_summary")``."""
    names = []
    for name, df in layers.tables().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def save_tables(spark: SparkSession, layers: Layers, location: str, keep: int = 2) -> list[str]:
    """Silver and Gold as catalog tables in one database per layer
    (``silver.silver_cmm_quality``, ``gold.mart_part_quality_summary``), stored
    as Parquet under ``location`` (full refresh).

    Tables are switched to fresh folders when all are written; a build that fails
    leaves them as they were.
    """
    model, records = Store(spark, location), {}
    names = SILVER_MODELS + GOLD_MODELS

    def write(name: str, df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
        folder = model.fresh(entry_of(name))
        df.write.options(**(options or {})).parquet(f"{model.base}/{folder}")
        records[entry_of(name)] = {"path": folder}
        return spark.read.schema(df.schema).parquet(f"{model.base}/{folder}")

    tables, own = layers.tables(), layers.gold is layers._made
    _written(
        write,
        (layers.population, layers.cmm_quality, layers.torque_quality),
        lambda _: layers.material_quality,
        layers.gold_over,
        mart.quality_flags if own and layers.rescored else lambda _: layers.flags,
    )
    model.commit(records)
    for name in names:
        spark.sql(f"create database if not exists {layer_of(name)}")
        _point(spark, f"{layer_of(name)}.{name}", f"{model.base}/{records[entry_of(name)]['path']}", None, _columns(tables[name]))
    model.expire(keep)
    return [f"{layer_of(name)}.{name}" for name in names]


def layer_of(model: str) -> str:
    """Schema (folder) of a model: its name's layer prefix; Gold marts go to gold."""
    if model.startswith("bronze_"):
        return "bronze"
    if model.startswith("silver_"):
        return "silver"
    return "gold"
