"""A ledger of the types that dated folders of other writers hold.

Extracts of other writers may change type from day to day, and Spark cannot merge
such files. The ledger notes, for each dated folder, its files and the types of
the known columns. A folder that is noted, with the same files, is never opened
again to find its types. New folders are learned together, by one job that merges
all their footers (Spark's own, spread over tasks). Where Spark cannot merge them,
folders whose first file has the same types are one job; where that fails too,
because files inside a folder differ, the list is halved until each part merges.

The notes are commits of a store of their own beside the lake, so readers at the
same time don't disturb each other.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from partwise.sources.publish import Store

DATED = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
_ERRORS = (AnalysisException, PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class File:
    path: str
    size: int
    modified: int

    @property
    def folder(self) -> str:
        return self.path.rsplit("/", 2)[-2]

    @property
    def pattern(self) -> str:
        return f"{self.path.rsplit('/', 1)[0]}/*.parquet"


def dated_files(spark: SparkSession, base: str) -> list[File]:
    """Parquet files in the dated folders under ``base``."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{DATED}/*.parquet")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [File(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.globStatus(pattern) or []]
    return sorted(found, key=lambda f: f.path)


def _cannot_merge(exc: Exception) -> bool:
    return "CANNOT_MERGE_SCHEMAS" in str(exc)


def merged(spark: SparkSession, paths: list[str], files: dict[str, list[str]]) -> list[tuple[list[str], T.StructType]]:
    """``paths`` in lists that Spark can merge, and their schemas: a list that it cannot is halved, a folder (of ``files``) at its files."""
    try:
        return [(paths, spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
    except _ERRORS as exc:
        if not _cannot_merge(exc):
            raise
        if len(paths) == 1:
            paths = files.get(paths[0], paths)
        if len(paths) == 1:
            raise
    half = len(paths) // 2
    return [*merged(spark, paths[:half], files), *merged(spark, paths[half:], files)]


def _first_types(spark: SparkSession, file: File, known: set[str]) -> str:
    """A file's own declaration of its known columns, from its footer."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file.path), spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        fields = reader.getFooter().getFileMetaData().getSchema().getFields()
        return "; ".join(sorted(str(fields.get(i)) for i in range(fields.size()) if fields.get(i).getName() in known))
    finally:
        reader.close()


@cache
def _kind(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {name}").fields[0].dataType


class Ledger:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.store = spark, Store(spark, base)

    def types(self, files: list[File], known: set[str]) -> Iterator[tuple[list[str], dict[str, T.DataType]]]:
        """(paths, types of the known columns) that cover all ``files``; folders not noted yet, or with other files, are learned."""
        folders = defaultdict(list)
        for f in files:
            folders[f.folder].append(f)
        sign = {name: hashlib.sha256(repr([(f.path.rsplit("/", 1)[1], f.size, f.modified) for f in held]).encode()).hexdigest() for name, held in folders.items()}
        noted = self.store.current().entries
        new = {name: held for name, held in folders.items() if noted.get(name, {}).get("sign") != sign[name]}
        if new:
            learned = {name: {"sign": sign[name], "parts": parts} for name, parts in self._learn(new, known).items()}
            gone = {name: None for name in noted if name not in folders}
            self.store.commit({**gone, **learned})
            self.store.expire()
            noted = {**noted, **learned}
        for name, held in folders.items():
            base = held[0].path.rsplit("/", 1)[0]
            for part in noted[name]["parts"]:
                yield [f"{base}/{n}" for n in part["names"]], {c: _kind(kind) for c, kind in part["types"].items()}

    def _learn(self, new: dict[str, list[File]], known: set[str]) -> dict[str, list[dict]]:
        files = {held[0].pattern: [f.path for f in held] for held in new.values()}
        try:
            found = [(list(files), self.spark.read.option("mergeSchema", "true").parquet(*files).schema)]
        except _ERRORS as exc:
            if not _cannot_merge(exc):
                raise
            alike = defaultdict(list)
            for held in new.values():
                alike[_first_types(self.spark, held[0], known)].append(held[0].pattern)
            found = [part for paths in alike.values() for part in merged(self.spark, paths, files)]
        out = defaultdict(list)
        for paths, schema in found:
            types = {f.name: f.dataType.simpleString() for f in schema.fields if f.name in known}
            for path in paths:
                folder, name = path.rsplit("/", 2)[-2:]
                out[folder].append({"names": [name], "types": types})
        return out
