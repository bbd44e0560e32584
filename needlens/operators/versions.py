"""Versioned table of keyed results (K1, K3).

A table is a folder.  ``data/<commit>`` holds the rows of one commit, dealt by key into
``buckets`` folders; ``versions/<number>.json`` names the commits that make up a
version.  A commit writes its data first and then its manifest, to a temporary name
that is renamed to the next number; a rename to a taken number fails and is tried
again on top of the newer version.  So a reader sees the whole of one version or the
whole of the next, and data of a commit that never got its manifest is never read.

``put`` appends.  ``purge`` and ``compact`` write a new commit and a version that holds
it alone; a reader of the older version keeps its files until ``vacuum``.  The rename
must be atomic and must not overwrite, as on HDFS and local folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from needlens.operators.results import delete_keys, get_fresh, latest, purge_expired

SCHEMA = "cache_key string, value string, written_at timestamp, expires timestamp, seq long"
BUCKETS = 16
TRIES = 20


class VersionTaken(RuntimeError):
    """Another writer made this version."""


@dataclass(frozen=True)
class Version:
    number: int
    commits: tuple[str, ...]


class ResultTable:
    def __init__(self, spark: SparkSession, path: str, schema: str = SCHEMA, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.buckets = spark, path.rstrip("/"), schema, buckets
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._at("versions"))

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    # --- versions ---

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("versions"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """A version's manifest; the newest one by default (0: the empty table)."""
        number = max(self.versions(), default=0) if number is None else number
        if not number:
            return Version(0, ())
        stream = self._fs.open(self._at(f"versions/{number:012d}.json"))
        try:
            body = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return Version(number, tuple(body["commits"]))

    def _publish(self, base: Version, commits: tuple[str, ...]) -> Version:
        new = Version(base.number + 1, commits)
        temporary = self._at(f"versions/.{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(json.dumps({"commits": list(commits)}).encode())
        out.close()
        target = self._at(f"versions/{new.number:012d}.json")
        if self._fs.exists(target) or not self._fs.rename(temporary, target):
            self._fs.delete(temporary, False)
            raise VersionTaken(str(new.number))
        return new

    def _write(self, rows: DataFrame) -> str:
        commit = uuid.uuid4().hex
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("cache_key"), F.lit(self.buckets)).cast("int"))
        rows.repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{commit}")
        return commit

    # --- reading and writing ---

    def read(self, version: Version | int | None = None) -> DataFrame:
        """All rows of one version.  Hold the ``Version`` to read the same one twice."""
        held = version if isinstance(version, Version) else self.version(version)
        names = [c.split()[0] for c in self.schema.split(", ")]
        if not held.commits:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema + ", bucket int")
        out = None
        for commit in held.commits:  # a folder with partitions each
            part = reader.parquet(f"{self.path}/data/{commit}").select(*names)
            out = part if out is None else out.unionByName(part)
        return out

    def put(self, rows: DataFrame) -> Version:
        """K1: append rows (the columns of the schema)."""
        commit = self._write(rows.select(*[c.split()[0] for c in self.schema.split(", ")]))
        for _ in range(TRIES):
            base = self.version()
            try:
                return self._publish(base, (*base.commits, commit))
            except VersionTaken:
                continue
        raise RuntimeError(f"{self.path}: the version was taken {TRIES} times")

    def _replace(self, change) -> Version:
        for _ in range(TRIES):
            base = self.version()
            commit = self._write(change(self.read(base)))
            try:
                return self._publish(base, (commit,))
            except VersionTaken:  # rows have been put meanwhile: change the newer version
                self._fs.delete(self._at(f"data/{commit}"), True)
        raise RuntimeError(f"{self.path}: the version was taken {TRIES} times")

    def purge(self, now: Column, keys: DataFrame | None = None) -> Version:
        """K3: a version without the rows expired at ``now`` and without ``keys``."""
        def change(rows):
            rows = purge_expired(rows, now)
            return rows if keys is None else delete_keys(rows, keys)
        return self._replace(change)

    def compact(self) -> Version:
        """A version that holds the last write of each key alone."""
        return self._replace(latest)

    def fresh(self, now: Column, version: Version | int | None = None) -> DataFrame:
        """K2 on one version."""
        return get_fresh(self.read(version), now)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the last ``keep`` versions and the data that no kept version
        names; returns the commits deleted.  No writer may be at work."""
        numbers = self.versions()
        kept = {c for n in numbers[-keep:] for c in self.version(n).commits}
        for n in numbers[:-keep]:
            self._fs.delete(self._at(f"versions/{n:012d}.json"), False)
        gone = []
        if self._fs.exists(self._at("data")):
            for s in self._fs.listStatus(self._at("data")):
                name = s.getPath().getName()
                if name not in kept:
                    self._fs.delete(s.getPath(), True)
                    gone.append(name)
        return sorted(gone)
