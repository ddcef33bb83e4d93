"""Versioned publishing of several tables at once.

Every publish writes new folders and, last of all, one manifest that names
the folders of every table. Readers take the newest manifest and stay with
the folders it names, so they see all tables of one load or none of it: a load
that fails half-way leaves nothing but folders that no manifest names. A
manifest appears by a rename that fails if its number is taken, so of two
writers that started from one version the slower is told to begin again.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class PublishConflict(RuntimeError):
    """Another writer published the version that this one was about to."""


@dataclass(frozen=True)
class Snapshot:
    """One published version: table name -> folders, pinned for its reader."""

    spark: SparkSession
    version: int
    published: float
    tables: dict[str, dict]

    def table(self, name: str, parts: list | None = None) -> DataFrame:
        """The table; with ``parts`` only the folders of these parts are listed
        and read (a table that was published by part)."""
        t = self.tables[name]
        folders = t["folders"] if parts is None else {p: t["folders"].get(str(p), []) for p in parts}
        paths = sorted({f for fs in folders.values() for f in fs})
        if not paths:
            return self.spark.createDataFrame([], t["schema"])
        return self.spark.read.schema(t["schema"]).parquet(*paths)

    def parts(self, name: str) -> list[str]:
        return sorted(self.tables[name]["folders"])

    def age_seconds(self, now: float | None = None) -> float:
        """How old the data is that this reader sees."""
        return (time.time() if now is None else now) - self.published


class SnapshotStore:
    """Tables under ``base`` on any Hadoop file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._manifests = f"{self.base}/manifests"

    def versions(self) -> list[int]:
        if not self._fs.exists(self._path(self._manifests)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self._manifests))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _read(self, version: int) -> dict:
        rows = self.spark.read.text(f"{self._manifests}/{version:012d}.json", wholetext=True).collect()  # one manifest
        return json.loads(rows[0][0])

    def at(self, version: int) -> Snapshot:
        m = self._read(version)
        return Snapshot(self.spark, m["version"], m["published"], m["tables"])

    def latest(self) -> Snapshot | None:
        v = self.versions()
        return self.at(v[-1]) if v else None

    def fresh(self, max_age_seconds: float) -> Snapshot | None:
        """The newest snapshot, or None if it is older than that (time to load again)."""
        s = self.latest()
        return s if s is not None and s.age_seconds() <= max_age_seconds else None

    def new_folder(self, name: str) -> str:
        return f"{self.base}/data/{name}-{uuid.uuid4().hex}"

    def write_parts(self, df: DataFrame, name: str, part: str) -> dict[str, list[str]]:
        """Write ``df`` in folders by its column ``part``: part value -> folders."""
        folder = self.new_folder(name)
        df.write.partitionBy(part).parquet(folder)
        got = [s.getPath().getName() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory()]
        return {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in got if "=" in n}

    def publish(self, tables: dict[str, DataFrame] | None = None, folders: dict[str, tuple[dict, str]] | None = None,
                onto: Snapshot | None = None) -> Snapshot:
        """Publish a version: ``tables`` are written whole; ``folders`` (name ->
        (part -> folders already written, schema)) are named as they are;
        tables of ``onto`` that are in neither stay. Raises before any reader
        sees a change if a write fails, and PublishConflict if ``onto`` is no
        longer the newest version."""
        named = dict(onto.tables) if onto is not None else {}
        for name, df in (tables or {}).items():
            folder = self.new_folder(name)
            df.write.parquet(folder)
            named[name] = {"folders": {"": [folder]}, "schema": ddl(df)}
        for name, (parts, schema) in (folders or {}).items():
            named[name] = {"folders": parts, "schema": schema}
        version = (onto.version if onto is not None else 0) + 1
        body = json.dumps({"version": version, "published": time.time(), "tables": named})
        self._swap(version, body)
        return self.at(version)

    def _swap(self, version: int, body: str) -> None:
        final, tmp = self._path(f"{self._manifests}/{version:012d}.json"), self._path(f"{self._manifests}/.{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(self._path(self._manifests))
        out = self._fs.create(tmp, False)
        try:
            out.write(bytearray(body.encode("utf-8")))
        finally:
            out.close()
        newest = self.versions()
        if (newest and newest[-1] >= version) or self._fs.exists(final) or not self._fs.rename(tmp, final):
            self._fs.delete(tmp, False)
            raise PublishConflict(f"version {version} of {self.base} was published by another writer")

    def vacuum(self, keep: int = 2, grace_seconds: float = 86_400) -> int:
        """Remove manifests beyond the newest ``keep`` and the folders that no
        kept one names, if they are older than ``grace_seconds`` (a running
        load or reader may need younger ones). Returns the folders removed."""
        versions = self.versions()
        kept = [self.at(v) for v in versions[-keep:]]
        used = {f[len(self.base) + 6:].split("/")[0] for s in kept for t in s.tables.values() for fs in t["folders"].values() for f in fs}
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"{self._manifests}/{v:012d}.json"), False)
        removed, data = 0, self._path(f"{self.base}/data")
        for s in self._fs.listStatus(data) if self._fs.exists(data) else []:
            old = time.time() - s.getModificationTime() / 1000 >= grace_seconds
            if s.getPath().getName() not in used and old:
                removed += bool(self._fs.delete(s.getPath(), True))
        return removed


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
