"""Publishing folders atomically: fresh folders, and a log of commits that names the current ones.

A store is a folder with entries (``gold/mart_part_quality_summary``,
``bronze/cmm_inspection/load_day=2026-06-11``). Writing never touches what is
there: data goes to a fresh folder ``<entry>/version=<id>``, and a commit file
``_commits/<number>.json`` then names the folder of every entry. Readers take the
newest commit, so a job that fails midway leaves the old rows in place, and all
entries of one commit change at once. Old versions stay readable until ``expire``.

A commit file is created exclusively (the file system's create without overwrite,
atomic on HDFS): of two writers that saw the same commit one gets the number, the
other reads the new state and tries the next. A file cut short by a lost writer
does not parse and counts as absent. On stores without atomic create, let one
job at a time publish.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

COMMITS = "_commits"
VERSION = "version="


@dataclass(frozen=True)
class Snapshot:
    """One commit: its number (0: none yet) and the record of every entry, ``path`` in it relative to the store."""

    number: int = 0
    entries: dict[str, dict] = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # ------------------------------------------------------------ file system
    def _path(self, relative: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{relative}" if relative else self.base)

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _children(self, relative: str) -> list[str]:
        fs, path = self._fs(), self._path(relative)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _read(self, number: int) -> Snapshot | None:
        jvm = self.spark.sparkContext._jvm
        stream = self._fs().open(self._path(f"{COMMITS}/{number:012d}.json"))
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            held = json.loads(text)
        except ValueError:
            return None
        return Snapshot(held["number"], held["entries"])

    def _create(self, snapshot: Snapshot) -> bool:
        """Write a commit file; False if its number is taken."""
        body = json.dumps({"number": snapshot.number, "entries": snapshot.entries}, sort_keys=True)
        fs, path = self._fs(), self._path(f"{COMMITS}/{snapshot.number:012d}.json")
        try:
            stream = fs.create(path, False)
        except Py4JJavaError:
            if fs.exists(path):
                return False
            raise
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        return True

    # ---------------------------------------------------------------- reading
    def numbers(self) -> list[int]:
        """Numbers of the commit files, oldest first."""
        names = [n for n in self._children(COMMITS) if n.endswith(".json") and not n.startswith((".", "_"))]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def current(self) -> Snapshot:
        for number in reversed(self.numbers()):
            if (found := self._read(number)) is not None:
                return found
        return Snapshot()

    def at(self, number: int) -> Snapshot:
        """The state as of a commit that has not expired."""
        found = self._read(number) if number in self.numbers() else None
        if found is None:
            raise KeyError(f"no commit {number} in {self.base}")
        return found

    def path(self, entry: str, snapshot: Snapshot | None = None) -> str:
        """The folder that holds an entry now, or as of a snapshot."""
        return f"{self.base}/{(snapshot or self.current()).entries[entry]['path']}"

    # ---------------------------------------------------------------- writing
    def fresh(self, entry: str) -> str:
        """A new folder for an entry, relative to the store; nobody reads it before a commit names it."""
        return f"{entry.rstrip('/')}/{VERSION}{uuid.uuid4().hex[:12]}"

    def commit(self, changes: dict[str, dict | None]) -> Snapshot:
        """Make the given records current, all at once; None takes an entry out. Other writers' entries stay."""
        while True:
            now, numbers = self.current(), self.numbers()
            entries = {k: v for k, v in {**now.entries, **changes}.items() if v is not None}
            done = Snapshot(max([now.number, *numbers]) + 1, entries)
            if self._create(done):
                return done

    # --------------------------------------------------------------- clean-up
    def _folders(self, snapshots: list[Snapshot]) -> set[str]:
        return {record["path"] for s in snapshots for record in s.entries.values() if "path" in record}

    def expire(self, keep: int = 1) -> list[str]:
        """Remove all commits but the last ``keep`` and the folders that only they name; returns those folders."""
        numbers = self.numbers()
        known = {n: self._read(n) for n in numbers}
        whole = [n for n in numbers if known[n] is not None]
        kept = set(whole[-max(1, keep) :])
        old = [n for n in numbers if n not in kept and n < max(kept, default=0)]
        gone = self._folders([known[n] for n in old if known[n] is not None]) - self._folders([known[n] for n in kept])
        fs = self._fs()
        for n in old:  # first the commits, so that no reader finds one without its folders
            fs.delete(self._path(f"{COMMITS}/{n:012d}.json"), False)
        for folder in sorted(gone):
            fs.delete(self._path(folder), True)
        return sorted(gone)

    def orphans(self) -> list[str]:
        """Folders of known entries that no commit names: left by failed jobs, or about to be committed."""
        snapshots = [s for n in self.numbers() if (s := self._read(n)) is not None]
        named = self._folders(snapshots)
        entries = {e for s in snapshots for e in s.entries}
        held = {f"{e}/{name}" for e in entries for name in self._children(e) if name.startswith(VERSION)}
        return sorted(held - named)

    def remove(self, folders: list[str]) -> None:
        """Delete folders found by ``orphans``; only while no job is writing to the store."""
        named = self._folders([s for n in self.numbers() if (s := self._read(n)) is not None])
        for folder in folders:
            if folder in named or VERSION not in folder:
                raise ValueError(f"{folder} is not an orphan")
            self._fs().delete(self._path(folder), True)
