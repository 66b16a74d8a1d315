"""Bronze: typed relations over Parquet extracts.

Two folder layouts are read, also side by side under one root:

* ``<root>/bronze/<source>/load_day=<YYYY-MM-DD>/version=<id>/part-*.parquet`` as
  published by :mod:`partwise.sources.sinks`; the commit log names the version of
  each day. Known columns have their declared types, so the files are read with
  the declared schema and no footer is looked at.
* ``<root>/bronze/<source>/<YYYY-MM-DD>/<file>.parquet``, extracts of other
  writers. These may drift: columns appear, vanish or change type between days.

Columns are matched by name, missing ones become NULL, extra ones are dropped,
and every column is cast to the declared type. The types that each dated folder
holds are kept in a ledger beside the lake (:mod:`partwise.sources.ledger`), so
a folder's footers are read once. Folders whose known columns have the same
types are one Spark scan with that schema (split by Spark, only the used columns
read), and the scans are cast and united.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from partwise.session import lake_root
from partwise.sources.ledger import Ledger, dated_files
from partwise.sources.publish import Snapshot, Store
from partwise.sources.schemas import SOURCE_SCHEMAS, UPPERCASED, ddl

LOAD_DAY = "load_day"
_TIMESTAMP_TYPES = ("timestamp_ntz", "timestamp")


def _typed_expr(name: str, kind: str, current: T.DataType | None, upper: bool) -> str:
    if current is None:
        expr = f"cast(null as {kind})"
    elif kind in _TIMESTAMP_TYPES and isinstance(current, (T.LongType, T.IntegerType)):
        # INT64 TIMESTAMP(NANOS) read as epoch nanoseconds (nanosAsLong); the
        # session zone is UTC, so the wall-clock value is kept.
        expr = f"cast(timestamp_micros((`{name}` - pmod(`{name}`, 1000)) div 1000) as {kind})"
    elif kind == "date" and isinstance(current, T.LongType):
        # The same where a writer stored a day as a nanosecond timestamp.
        expr = f"cast(timestamp_micros((`{name}` - pmod(`{name}`, 1000)) div 1000) as date)"
    else:
        expr = f"cast(`{name}` as {kind})"
    if upper:
        expr = f"upper({expr})"
    return f"{expr} as `{name}`"


def _projection(df: DataFrame, source: str, upper: tuple[str, ...]) -> list[str]:
    current = {f.name: f.dataType for f in df.schema.fields}
    return [_typed_expr(name, kind, current.get(name), name in upper) for name, kind in SOURCE_SCHEMAS[source]]


def typed(df: DataFrame, source: str) -> DataFrame:
    """Project a raw extract onto the declared Bronze schema of ``source``.

    Columns match by name; missing ones become typed NULLs, extra ones are
    dropped. Built as one ``selectExpr`` so the plan is analysed once.
    """
    return df.selectExpr(*_projection(df, source, UPPERCASED.get(source, ())))


def declared(df: DataFrame, source: str) -> DataFrame:
    """A raw extract with its known columns in their declared types; extra columns and values stay as they are."""
    known = {name for name, _ in SOURCE_SCHEMAS[source]}
    return df.selectExpr(*_projection(df, source, ()), *[f"`{c}`" for c in df.columns if c not in known])


def store(spark: SparkSession, root: str | None = None) -> Store:
    """The lake's commit log; ``root`` from the session's configuration if it is not given."""
    return Store(spark, lake_root(spark, root))


def source_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/bronze/{source}"


def load_entry(source: str, day: str) -> str:
    return f"bronze/{source}/{LOAD_DAY}={day}"


def read_dated(spark: SparkSession, root: str, source: str, merge_schema: bool = True) -> DataFrame | None:
    """Extracts of other writers; None if there are none."""
    files = dated_files(spark, source_path(root, source))
    if not files:
        return None
    known = {name for name, _ in SOURCE_SCHEMAS[source]}
    if not merge_schema:
        # The files' own types, one of them read; columns it lacks are asked for as well.
        paths = sorted({f.pattern for f in files})
        own = spark.read.parquet(*paths).schema
        held = {f.name for f in own.fields}
        more = [f for f in T.StructType.fromDDL(ddl(source)).fields if f.name not in held]
        return typed(spark.read.schema(T.StructType([*own.fields, *more])).parquet(*paths), source)
    groups: list[tuple[list[str], dict[str, T.DataType]]] = []
    for paths, types in Ledger(spark, f"{root}/_schemas/{source}").types(files, known):
        for held, merged in groups:
            if all(merged[name] == kind for name, kind in types.items() if name in merged):
                held.extend(paths)
                merged.update(types)
                break
        else:
            groups.append((list(paths), dict(types)))
    frames = []
    for paths, types in groups:
        # A folder without any known column is read for its rows.
        schema = T.StructType([T.StructField(n, k) for n, k in types.items()] or [T.StructField("_", T.StringType())])
        frames.append(typed(spark.read.schema(schema).parquet(*paths), source))
    return reduce(DataFrame.unionByName, frames)


def load_folders(spark: SparkSession, root: str, source: str, snapshot: Snapshot | None = None) -> dict[str, str]:
    """The current folder of every load day of ``source``; days landed before there was a commit log are their own folder."""
    lake = Store(spark, root)
    entries = (snapshot or lake.current()).entries
    prefix = load_entry(source, "")
    out = {e.removeprefix(prefix): f"{lake.base}/{r['path']}" for e, r in entries.items() if e.startswith(prefix)}
    for name in lake._children(f"bronze/{source}"):
        day = name.removeprefix(f"{LOAD_DAY}=")
        if name != day and day not in out and any(f.endswith(".parquet") for f in lake._children(f"bronze/{source}/{name}")):
            out[day] = f"{source_path(root, source)}/{name}"
    return dict(sorted(out.items()))


def read_bronze(spark: SparkSession, root: str | None, source: str, merge_schema: bool = True, snapshot: Snapshot | None = None) -> DataFrame:
    """Typed Bronze relation of ``source`` over all loads under ``root``, in either layout; as of a commit, if one is given.

    ``merge_schema`` concerns dated folders of other writers only: where those
    never drift it can be turned off, and one footer is read instead of the ledger.
    """
    root = lake_root(spark, root)
    folders = list(load_folders(spark, root, source, snapshot).values())
    dated = read_dated(spark, root, source, merge_schema)
    if not folders:
        if dated is None:
            raise FileNotFoundError(f"no extracts of {source} under {root}")
        return dated
    out = typed(spark.read.schema(ddl(source)).parquet(*folders), source)
    return out if dated is None else out.unionByName(dated)


def read_all(spark: SparkSession, root: str | None = None, merge_schema: bool = True) -> dict[str, DataFrame]:
    """All four sources, as of one commit."""
    snapshot = store(spark, root).current()
    return {source: read_bronze(spark, root, source, merge_schema, snapshot) for source in SOURCE_SCHEMAS}
