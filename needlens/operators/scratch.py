"""Stage tables of one computation, deleted as soon as nothing reads them.

A table is written as Parquet below the shared checkpoint folder and read back:
that cuts the lineage and survives lost executors.  ``drop`` deletes tables that
have been consumed; ``close`` deletes all but the tables named.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from needlens.session import stage_dir


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{stage_dir(spark, name)}/{uuid.uuid4().hex}"
        self.tables: dict[int, tuple[DataFrame, str]] = {}
        path = self._path(self.base)
        path.getFileSystem(self._conf()).deleteOnExit(path)

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and read it back."""
        path = f"{self.base}/{label}-{len(self.tables)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            held = self.tables.get(id(t))
            if held and held[1]:
                path = self._path(held[1])
                path.getFileSystem(self._conf()).delete(path, True)
                self.tables[id(t)] = (t, "")

    def close(self, *but: DataFrame) -> None:
        """Delete everything except the tables ``but``."""
        kept = {id(t) for t in but}
        self.drop(*[t for k, (t, _) in self.tables.items() if k not in kept])
