"""Reader for the parquet tables a run works on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Tables whose rows carry heavy per-row work (whole texts, vectors).
HEAVY_ROWS = ("documents", "embeddings", "pages", "conversations", "benchmark")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the cluster has
    task slots (e.g. one file with one row group), so per-row work runs on
    every core.  A large input already has at least that many splits and is
    left alone: no extra shuffle at scale.  Results never depend on the
    partitioning (every tie-break uses an explicit order column)."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:  # the planned split count only; no data is read
        return df.repartition(slots)
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in HEAVY_ROWS else df
